"""Moving files: copy, read both again and compare, and only when every copy of every partition is right, delete.

Copies are a data source that is written to: a task copies the files of its rows and logs what became of
each in a file of a random name; the commit, which Spark calls once all tasks have succeeded, names the logs that
count and adds up their totals. A task that fails or runs twice leaves a log that no one reads, and copies that
the next run makes again. Deleting is a second job over the logs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .stores import put, sha256, size, store

LOG = "src string, dst string, bytes long, sha256 string, status string"
STATUSES = ("copied", "already", "missing", "mismatch")
MANIFEST = "_COMMITTED.json"
_CHUNK = 1 << 20


@dataclass
class Logged(WriterCommitMessage):
    """A task's log, and how many of its files ended in which status."""

    part: str
    counts: dict[str, int]


def copied(src: str, dst: str, known: str | None, made: set[str] | None = None) -> tuple[int | None, str | None, str]:
    """Copy a file and read both again. bytes, hash and status: copied; already (the source is gone, the copy is
    there and has the known hash, if one is known); missing; mismatch (the hashes of source, copy and plan differ;
    the copy is removed)."""
    n = size(src)
    if n is None:
        m = size(dst)
        if m is None:
            return None, None, "missing"
        found = sha256(dst)
        return m, found, "already" if known in (None, found) else "mismatch"
    (from_fs, from_), (to_fs, to) = store(src), store(dst)
    above = to.rpartition("/")[0]
    if made is None or above not in made:
        to_fs.create_dir(above, recursive=True)
        if made is not None:
            made.add(above)
    half = f"{to}.{uuid.uuid4().hex}.part"
    try:
        with from_fs.open_input_stream(from_) as f, to_fs.open_output_stream(half) as g:
            while piece := f.read(_CHUNK):
                g.write(piece)
        to_fs.move(half, to)
    except BaseException:
        if to_fs.get_file_info(half).is_file:
            to_fs.delete_file(half)
        raise
    ours, theirs = sha256(src), sha256(dst)
    if ours != theirs or known not in (None, ours):
        to_fs.delete_file(to)
        return n, ours, "mismatch"
    return n, ours, "copied"


class CopyWriter(DataSourceWriter):
    def __init__(self, log: str):
        self.log = log

    def write(self, iterator: Iterator) -> Logged:
        name, counts = f"{uuid.uuid4().hex}.jsonl", dict.fromkeys(STATUSES, 0)
        fs, path = store(f"{self.log}/{name}")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        made: set[str] = set()
        with fs.open_output_stream(path) as f:
            for r in iterator:
                n, found, status = copied(r["src"], r["dst"], r["sha256"], made)
                counts[status] += 1
                f.write((json.dumps({"src": r["src"], "dst": r["dst"], "bytes": n, "sha256": found, "status": status}) + "\n").encode())
        return Logged(name, counts)

    def commit(self, messages: list[Logged | None]) -> None:
        done = [m for m in messages if m is not None]
        totals = {s: sum(m.counts[s] for m in done) for s in STATUSES}
        put(f"{self.log}/{MANIFEST}", json.dumps({"parts": [m.part for m in done], "totals": totals}).encode())

    def abort(self, messages: list[Logged | None]) -> None:
        """Without a manifest no log counts, so nothing can be deleted; what was copied stays."""
        for m in messages:
            if m is not None:
                fs, path = store(f"{self.log}/{m.part}")
                fs.delete_file(path)


class Copies(DataSource):
    """df.write.format("marlstone_copies").option("log", folder): rows of src, dst and sha256 (or null)."""

    @classmethod
    def name(cls) -> str:
        return "marlstone_copies"

    def schema(self) -> str:
        return "src string, dst string, sha256 string"

    def writer(self, schema, overwrite: bool) -> CopyWriter:
        return CopyWriter(self.options["log"])


def copy(plan: DataFrame, log: str) -> DataFrame:
    """Copy the files of a plan (src, dst, sha256) and return its log: src, dst, bytes, sha256, status."""
    plan.sparkSession.dataSource.register(Copies)
    plan.select("src", "dst", F.col("sha256").cast("string")).write.format("marlstone_copies").option("log", log).mode("append").save()
    return logged(plan.sparkSession, log)


def logged(spark: SparkSession, log: str) -> DataFrame:
    """The log of a committed run; empty before its commit."""
    parts = _manifest(log)["parts"]  # one per task
    return spark.read.schema(LOG).json([f"{log}/{p}" for p in parts]) if parts else spark.createDataFrame([], LOG)


def _manifest(log: str) -> dict:
    if size(f"{log}/{MANIFEST}") is None:
        return {"parts": [], "totals": None}
    fs, path = store(f"{log}/{MANIFEST}")
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def delete_sources(spark: SparkSession, log: str) -> int:
    """Delete the sources that a committed run has copied, unless any of its files mismatched or is
    missing. How many were deleted. Runs again without harm."""
    totals = _manifest(log)["totals"]
    if totals is None or totals["mismatch"] or totals["missing"]:
        return 0

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = 0
            for src, bytes_ in zip(b.column("src").to_pylist(), b.column("bytes").to_pylist(), strict=True):
                if size(src) == bytes_:  # not one that has changed since
                    fs, path = store(src)
                    fs.delete_file(path)
                    n += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    gone = logged(spark, log).where("status = 'copied'").select("src", "bytes").mapInArrow(run, "n long")
    return gone.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
