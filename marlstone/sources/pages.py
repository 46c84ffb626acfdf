"""Pages of documents as a Python data source: page counts and text layers come from external
programs where these are installed; plain text files are cut at form feeds."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "path string, page int, pages int, text string, error string"


class PagesSource(DataSource):
    """spark.read.format("pages").option("paths", "a.pdf\\nb.txt"): a row per page; a file that can't
    be read is one row with its error. An unknown number of pages is an error, not one page."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagesReader(self.options)


class PagesReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        self.seconds = float(options.get("timeout", "60"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        if path is None:
            return
        try:
            texts = self.pages(path)
        except Exception as e:  # a row says what failed; the scan goes on
            yield (path, None, None, None, f"{type(e).__name__}: {e}"[:300])
            return
        for i, t in enumerate(texts, 1):
            yield (path, i, len(texts), t, None)

    def pages(self, path: str) -> list[str]:
        if not path.lower().endswith((".pdf", ".djvu")):
            with open(path, encoding="utf-8", errors="replace") as f:
                return f.read().split("\f")
        program = "pdftotext" if path.lower().endswith(".pdf") else "djvutxt"
        if not shutil.which(program):
            raise FileNotFoundError(f"{program} isn't installed")
        args = [program, "-layout", path, "-"] if program == "pdftotext" else [program, path]
        out = subprocess.run(args, capture_output=True, timeout=self.seconds, check=True).stdout.decode("utf-8", "replace")
        return out.removesuffix("\f").split("\f")
