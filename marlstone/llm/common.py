"""Shared pieces: durable intermediate tables, and words of Arrow text columns as numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

#: Whether shuffle files are removed when the command that made them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one of our own in local mode, and an
    error on a cluster, whose machines would not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="marlstone-")
    return _own_folder[app]


class _Cleaning:
    """While it is entered, by however many threads, shuffle files go with the command that made
    them. Other queries of the session meanwhile only lose files that nothing reads again."""

    def __init__(self):
        self.lock, self.depth, self.before = threading.Lock(), 0, None

    @contextlib.contextmanager
    def __call__(self, spark: SparkSession):
        with self.lock:
            self.depth += 1
            if self.depth == 1:
                self.before = spark.conf.get(_CLEANUP, None)
                spark.conf.set(_CLEANUP, "true")
        try:
            yield
        finally:
            with self.lock:
                self.depth -= 1
                if self.depth == 0:
                    if self.before is None:
                        spark.conf.unset(_CLEANUP)
                    else:
                        spark.conf.set(_CLEANUP, self.before)


_cleaning = _Cleaning()


def durable(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder (in folders by the column `by`, if given) and read
    it back: the lineage is cut and a lost executor costs a re-read, not a recomputation. The
    shuffle files behind the table go at once; discard() removes the table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marlstone/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with _cleaning(spark):
        w = df.write.option("compression", "zstd")
        (w.partitionBy(by) if by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._marlstone_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of durable() that nothing will read again."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._marlstone_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give memory that arrays have left back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """run, a function of a task's batches, with release() after the last."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def unused(name: str, taken) -> str:
    """name, or one like it that isn't taken."""
    while name in taken:
        name = f"_{name}"
    return name


def held(id_col, modulus: int, remainder: int):
    """Whether crc32(id as text) mod modulus is remainder; not so without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(df: DataFrame, label: str, id_col: str, per_class: int) -> DataFrame:
    """per_class different rows of each value of label (all, where it has fewer), chosen by a hash of the
    whole row: those below a bound set from the class counts, cut in hash order. Rows that repeat in
    every column count once, before they meet. A pass for the counts and, as a rule, one for the rows; a
    label whose rows repeat so much that too few lie below its bound gets others with a wider one. Null
    labels and ids take no part."""
    known = df.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[label]: r["_n"] for r in known.groupBy(label).agg(F.count("*").alias("_n")).collect()}  # a row per label
    if not counts:
        return known.limit(0)
    draw = F.xxhash64(*df.columns, F.lit(17)).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    kinds = StructType([df.select(label).schema[0], StructField("_bound", DoubleType())])
    bound = {k: min(1.0, (1.5 * per_class + 20) / n) for k, n in counts.items()}
    while True:
        bounds = df.sparkSession.createDataFrame(list(bound.items()), kinds)
        some = known.join(F.broadcast(bounds), label).withColumn("_draw", draw).where("_draw < _bound").select(*df.columns, "_draw").dropDuplicates()
        some = durable(some, "sample")
        nth = F.row_number().over(Window.partitionBy(label).orderBy("_draw", id_col))
        few = {k for k, b in bound.items() if b < 1.0}
        if few:
            found = {r[label]: r["_n"] for r in some.groupBy(label).agg(F.count("*").alias("_n")).collect()}
            few = {k for k in few if found.get(k, 0) < per_class}
        if not few:
            return some.withColumn("_nth", nth).where(F.col("_nth") <= per_class).select(*df.columns)
        discard(some)
        bound |= {k: min(1.0, 8 * bound[k]) for k in few}


def labelled_texts(labels: DataFrame, docs: DataFrame, label: str, id_col: str, per_class: int) -> DataFrame:
    """Rows of docs with their label, enough for labelled_sample(per_class): only the ids that a hash picks
    meet the texts, some 2 per_class a label, so that these needn't travel; more where too few of them have
    a text. Null labels and ids take no part."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(id_col, label).distinct()
    counts = {r[label]: r["_n"] for r in known.groupBy(label).agg(F.count("*").alias("_n")).collect()}  # a row per label
    draw = F.xxhash64(id_col, F.lit(23)).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    kinds = StructType([labels.select(label).schema[0], StructField("_bound", DoubleType())])
    bound = {k: min(1.0, (2 * per_class + 50) / n) for k, n in counts.items()}
    while True:
        bounds = labels.sparkSession.createDataFrame(list(bound.items()), kinds)
        some = durable(known.join(F.broadcast(bounds), label).where(draw < F.col("_bound")).select(id_col, label), "ids")
        out = docs.join(some, id_col)
        few = {k for k, b in bound.items() if b < 1.0}
        if few:
            found = {r[label]: r["_n"] for r in docs.select(id_col).join(some, id_col).distinct().groupBy(label).agg(F.count("*").alias("_n")).collect()}
            few = {k for k in few if found.get(k, 0) < 1.5 * per_class}
        if not few:
            return out
        discard(some)
        bound |= {k: min(1.0, 8 * bound[k]) for k in few}


# ---- words of an Arrow string column -------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random number for every byte at every place of a word up to NEAR; beyond, mix() makes them.
NEAR = 32
_PLACED = np.random.default_rng(20240607).integers(1, 1 << 63, (NEAR, 256), dtype=np.uint64)[:, _LOWER].ravel()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finish of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


class Words:
    """Words of the rows, what lies between bytes of gap ([^\\x20\\x09-\\x0D]+ unless given): row index, byte start and end of each, and a 64-bit
    hash of the word with A-Z lower-cased: the sum of a random number for each (place, byte), so no
    pattern of letters makes words collide. first[i] : first[i + 1] are the words of row i."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, gaps: np.ndarray = _SPACE):
        n = len(data)
        gap = gaps[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = after[-1] = True
            before[1:] = gap[:-1]
            after[:-1] = gap[1:]
            edges = offs[(offs > 0) & (offs < n)]
            before[edges] = True
            after[edges - 1] = True
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(after & ~gap) + 1
        place = np.arange(n, dtype=np.int64)
        lead = np.zeros(n, np.int64)
        lead[self.start] = self.start
        place -= np.maximum.accumulate(lead)
        value = _PLACED[np.minimum(place, NEAR - 1) * 256 + data]
        far = np.flatnonzero((place >= NEAR - 1) & ~gap)
        if len(far):
            value[far] = mix(mix(place[far].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + _LOWER[data[far]])
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value, out=sums[1:])
        self.hash = mix(sums[self.end] - sums[self.start])
        self.first = np.searchsorted(self.start, offs)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))


def blocks(col: pa.Array, most: int = 2 << 20):
    """(first row, last row, bytes, offsets) of runs of rows with about most bytes; a longer row
    is a run of its own."""
    data, offs = text_bytes(col)
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


# ---- compact arrays -------------------------------------------------------------------------

_zstd = pa.Codec("zstd", compression_level=1)


def squeeze(a: np.ndarray) -> bytes:
    """An array of unsigned integers as byte planes, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return len(planes.tobytes()).to_bytes(8, "little") + (_zstd.compress(planes, asbytes=True) if len(a) else b"")


def expand(b: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    if not n:
        return np.zeros(0, dtype)
    planes = np.frombuffer(_zstd.decompress(b[8:], n), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def deltas(sorted_keys: np.ndarray) -> bytes:
    return squeeze(np.diff(sorted_keys, prepend=np.uint64(0)))


def undelta(b: bytes) -> np.ndarray:
    return np.cumsum(expand(b, np.uint64), dtype=np.uint64)
