"""Log files as they grow: a stream source that remembers bytes, not files.

An offset is, for each file, the end of its last whole line and its first bytes. A line that is still being written
waits. A file that got shorter, or begins otherwise than it did, is a new one and is read from its start.
The driver looks at sizes and at the last piece of files that have grown; executors read the ranges, long ones
in parts. Files that go away are forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileSelector, FileType
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .stores import store

HEAD, PIECE, PART = 64, 1 << 16, 64 << 20


@dataclass
class Range(InputPartition):
    """Lines of a file that begin in [begin, end); first: whether a line begins at begin."""

    file: str
    begin: int
    end: int
    first: bool


class TailReader(DataSourceStreamReader):
    def __init__(self, folder: str, suffix: str, part: int):
        self.folder, self.suffix, self.part = folder, suffix, part
        self.known: dict[str, dict] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        fs, path = store(self.folder)
        found = {}
        for info in sorted(fs.get_file_info(FileSelector(path, recursive=True, allow_not_found=True)), key=lambda i: i.path):
            if info.type != FileType.File or not info.path.endswith(self.suffix):
                continue
            with fs.open_input_file(info.path) as f:
                head = f.read_at(min(HEAD, info.size), 0).decode("latin-1")
                was = self.known.get(info.path)
                low = was["at"] if was and was["at"] <= info.size and head.startswith(was["head"]) else 0
                at, end = low, info.size
                while end > low:  # back to the last line end
                    begin = max(low, end - PIECE)
                    cut = f.read_at(end - begin, begin).rfind(b"\n")
                    if cut >= 0:
                        at = begin + cut + 1
                        break
                    end = begin
            if at:
                found[info.path] = {"at": at, "head": head[: min(HEAD, at)]}
        self.known = found
        return found

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for file, to in sorted(end.items()):
            was = start.get(file)
            begin = was["at"] if was and was["at"] <= to["at"] and to["head"].startswith(was["head"]) else 0
            out += [Range(file, b, min(b + self.part, to["at"]), b == begin) for b in range(begin, to["at"], self.part)]
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        fs, _ = store(self.folder)
        with fs.open_input_file(partition.file) as f:
            at, stop = partition.begin, f.size()
            buffer, base = b"", at
            if not partition.first:  # the line that began before belongs to the part before
                base = at = at - 1
            skip = not partition.first
            while at < partition.end:
                cut = buffer.find(b"\n", at - base)
                while cut < 0 and base + len(buffer) < stop:
                    buffer, base = buffer[at - base :], at
                    done = len(buffer)
                    buffer += f.read_at(min(PIECE, stop - base - done), base + done)
                    cut = buffer.find(b"\n", done)
                if cut < 0:
                    return
                line, next_ = buffer[at - base : cut], base + cut + 1
                if not skip:
                    yield (partition.file, at, line.decode("utf-8", "replace").removesuffix("\r"))
                skip, at = False, next_

    def commit(self, end: dict) -> None:
        pass


class Tail(DataSource):
    """spark.readStream.format("marlstone_tail").load(folder): file, offset, line. Options: suffix, of the files
    to read; part, the bytes one task reads at most."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_tail"

    def schema(self) -> str:
        return "file string, offset long, line string"

    def streamReader(self, schema) -> TailReader:  # noqa: N802
        return TailReader(self.options["path"], self.options.get("suffix", ""), int(self.options.get("part", PART)))
