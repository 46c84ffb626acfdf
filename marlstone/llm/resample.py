"""Importance resampling towards a target distribution: documents weigh by how much likelier their hashed
n-grams are in the target than in the corpus, and a share of them is drawn by Gumbel keys.

A task lays the words of a run of documents out as ids and sorts the suffixes of that sequence, as far
as the longest n-gram goes. Neighbours in the suffix array agree in their first words (LCP); a run of
neighbours that agree in n words is one n-gram, however often it occurs. Each run is hashed once, from
the CRCs of its words, and its bucket goes back to the places it came from.

Defined results: null and empty texts, and texts without words, have no features and weight 0; rows
without an id take the key of an empty id; rows that repeat an id are rows of their own, of equal score
and id any first; n-grams never cross documents; texts of any length are taken in spans of SPAN bytes
that share their border words. An empty corpus gives no rows, an empty target equal odds. Words of a
span are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Words, blocks, durable, release, tidy

BUCKETS, LONGEST = 10_000, 3
#: Bytes of text in one suffix array; rows of a range of ranks.
SPAN, RANGE = 4 << 20, 1_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that are no part of a word: ASCII but for digits and letters.
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


# ---- CRC-32 of texts put together --------------------------------------------------------------


def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The byte table of CRC-32, and tables that move a CRC on by 0 to 63 bytes and by 64, 128, ... bytes.
    All are linear in the bits of the CRC."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)

    def table(cols: np.ndarray) -> np.ndarray:
        out = np.zeros((4, 256), np.uint32)
        for bit in range(32):
            has = (np.arange(256) >> (bit % 8)) & 1 == 1
            out[bit // 8, has] ^= cols[bit]
        return out

    cols, near = np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(64):
        near.append(table(cols))
        cols = step[cols & 255] ^ (cols >> 8)
    far = []
    for _ in range(26):
        far.append(table(cols))
        cols = _apply(far[-1], cols)
    return step, np.stack(near), np.stack(far)


def _apply(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]


_STEP, _NEAR, _FAR = _crc_tables()
_NEAR_FLAT = _NEAR.ravel()


def moved(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs moved on by n bytes: crc(a + b) is moved(crc(a), len(b)) ^ crc(b)."""
    at = (n & 63).astype(np.int64) * 1024
    out = _NEAR_FLAT[at + (c & 255)] ^ _NEAR_FLAT[at + 256 + ((c >> 8) & 255)] ^ _NEAR_FLAT[at + 512 + ((c >> 16) & 255)] ^ _NEAR_FLAT[at + 768 + (c >> 24)]
    if n.max(initial=0) > 63:
        for k in range(26):
            some = np.flatnonzero((n >> (6 + k)) & 1)
            if len(some):
                out[some] = _apply(_FAR[k], out[some])
    return out


def crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice of data: byte by byte over all slices at once, long ones alone."""
    size = end - start
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero(size <= 48)
    live = live[np.argsort(-size[live], kind="stable")]
    sizes = -size[live]
    for j in range(int(-sizes[0]) if len(sizes) else 0):
        some = live[: np.searchsorted(sizes, -j)]
        c = out[some]
        out[some] = _STEP[(c ^ data[start[some] + j]) & 255] ^ (c >> 8)
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > 48):
        out[i] = zlib.crc32(data[start[i] : end[i]])
    return out


# ---- suffix arrays -----------------------------------------------------------------------------


class Suffixes:
    """The n-grams of a run of texts. first[i] : first[i + 1] are the words of text i. grams[n - 1]: bucket
    of each run, run of each word that begins an n-gram (-1: none begins there), and occurrences of
    each run. The first `known` words are context: n-grams of them alone don't count."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, known: int = 0):
        data = _LOWER[data]
        words = Words(data, offs, _GAP)
        self.first = words.first
        n = len(words.start)
        _, sample, ids = np.unique(words.hash, return_index=True, return_inverse=True)
        crc = crcs(data, words.start[sample], words.end[sample])
        size = (words.end - words.start)[sample] + 1
        spaced = moved(np.full(len(crc), zlib.crc32(b" "), np.uint32), size - 1) ^ crc
        bits = max(1, int(len(crc)).bit_length())  # ids from 1; 0 is the end of a text
        key = (ids + 1).astype(np.int64)
        last = np.zeros(n + LONGEST, bool)
        ends = self.first[1:][np.diff(self.first) > 0]
        last[ends - 1] = True
        whole, going = key.copy(), np.ones(n, bool)
        for k in range(1, LONGEST):
            going = going & ~last[k - 1 : n + k - 1]
            nxt = np.zeros(n, np.int64)
            at = np.flatnonzero(going)
            nxt[at] = key[at + k]
            whole = (whole << bits) | nxt
        order = np.argsort(whole)
        ranked = whole[order]
        self.grams, code, run = [], None, None
        for k in range(LONGEST):
            head = ranked >> (bits * (LONGEST - 1 - k))  # the first k + 1 words of each suffix
            begins = np.ones(n, bool)
            begins[1:] = head[1:] != head[:-1]  # where the LCP is below k + 1
            at = np.flatnonzero(begins)
            whole_gram = (head[at] & ((1 << bits) - 1)) != 0 if k else np.ones(len(at), bool)
            mine = np.cumsum(begins) - 1
            place = order[at]
            if k == 0:
                code = crc[ids[place]]
            else:
                before = code[run[at]]
                code = np.zeros(len(at), np.uint32)
                ok = np.flatnonzero(whole_gram)
                tail = ids[place[ok] + k]
                code[ok] = moved(before[ok], size[tail]) ^ spaced[tail]
            run = mine
            times = np.diff(np.append(at, n))
            of = np.empty(n, np.int64)
            of[order] = np.where(whole_gram[mine], mine, -1)
            if known:
                of[: max(0, known - k)] = -1
                times = np.bincount(of[of >= 0], minlength=len(at))
            times = np.where(whole_gram, times, 0)
            self.grams.append((code % BUCKETS, of, times))


def spans(data: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """A text in spans of about most bytes, cut between words, each with the words before it (LONGEST - 1, if
    there are so many) in front and their number."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + most)
        if b < n:
            gaps = np.flatnonzero(_GAP[data[a:b]])
            if len(gaps):
                b = a + int(gaps[-1]) + 1
            else:
                while b < n and not _GAP[data[b : b + most]].any():
                    b = min(n, b + most)
                b = min(n, b + int(np.argmax(_GAP[data[b : b + most]]))) if b < n else n
        back, begins = 256, np.zeros(0, np.int64)
        while a:
            from_ = max(0, a - back)
            inside = ~_GAP[data[from_:a]]
            begins = np.flatnonzero(inside & ~np.concatenate([[from_ > 0 and not _GAP[data[from_ - 1]]], inside[:-1]])) + from_
            if len(begins) >= LONGEST - 1 or not from_:
                break
            back *= 4
        begins = begins[-(LONGEST - 1) :]
        yield data[begins[0] if len(begins) else a : b], len(begins)
        a = b


def runs(col: pa.Array) -> Iterator[tuple[int, int, Suffixes]]:
    """first row, last row (not included) and the suffixes of all runs of rows, a long text in spans."""
    for a, b, data, offs in blocks(col, SPAN):
        if b == a + 1 and len(data) > SPAN:
            for part, known in spans(data, SPAN):
                yield a, b, Suffixes(part, np.array([0, len(part)]), known)
        else:
            yield a, b, Suffixes(data, offs)


# ---- counts, weights ---------------------------------------------------------------------------


def bucket_counts(df: DataFrame, text_col: str) -> DataFrame:
    """bucket, n: features of all texts in each bucket. A task sends a row per bucket, not per n-gram."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, _, s in runs(b.column(0)):
                for bucket, _, times in s.grams:
                    total += np.bincount(bucket, times, BUCKETS).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    each = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), "bucket int, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """Of each bucket, floor(1000 ln) of its odds in the target against the corpus, all counts one up. From
    bucket_counts(), so BUCKETS rows each at most."""
    s, t = ({r["bucket"]: r["n"] for r in side.collect()} for side in (corpus, target))
    over, under = float(sum(s.values()) + BUCKETS), float(sum(t.values()) + BUCKETS)
    return [math.floor(1000 * math.log((t.get(b, 0) + 1) * over / ((s.get(b, 0) + 1) * under))) for b in range(BUCKETS)]


def weigh(df: DataFrame, text_col: str, gain: list[int], keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, and n_words, n_features and weight (the sum of its features' gains) of every row."""
    worth = np.array(gain, np.int64)

    def run(batches):
        for b in batches:
            text = b.column(b.num_columns - 1)
            out = np.zeros((3, len(text)), np.int64)
            for i, j, s in runs(text):
                n = len(s.grams[0][1])
                made, many, words = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
                for k, (bucket, of, _) in enumerate(s.grams):
                    has = of >= 0
                    value = worth[bucket]
                    made[1:][has] += value[of[has]]
                    many[1:] += has
                    if not k:
                        words[1:] = has
                for row, sums in enumerate((words, many, made)):
                    sums = np.cumsum(sums)
                    out[row, i:j] += sums[s.first[1:]] - sums[s.first[:-1]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, out)], names=[*keep, "n_words", "n_features", "weight"])
            release()

    kept = [f for name in keep for f in df.select(name).schema]
    schema = StructType([*kept, *(StructField(c, LongType()) for c in ("n_words", "n_features", "weight"))])
    return df.select(*keep, F.col(text_col).cast("string")).mapInArrow(tidy(run), schema)


# ---- drawing -----------------------------------------------------------------------------------


def gumbel(id_col: str, seed: int) -> F.Column:
    """floor(1000 g) of a Gumbel number made from the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, eligible, order: list, most: int, n: int) -> DataFrame:
    """rows, written out, with rank 1, 2, 3... in order among the eligible up to most, else null. Rows go into
    ranges of about RANGE rows; a range's rows before it are counted, never gathered."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE))
    sort = [F.when(eligible, 0).otherwise(1), *order, "_tie"]
    placed = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
    placed = durable(placed.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33)
    counts = sorted(placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect())  # a row per range
    before = np.cumsum([0, *(r["_n"] for r in counts)]).tolist()
    offsets = spark.createDataFrame([(r["_part"], b) for r, b in zip(counts, before, strict=False)], "_part long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.withColumn("rank", F.when(eligible & (rank <= most), rank)).select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = 5, least: int = 20, seed: int = 42) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row; rank is null unless the row is one of
    the floor(percent N / 100) highest scores among the N rows with at least `least` words."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    rows = weigh(docs, text_col, gain, (id_col,))
    rows = durable(rows.withColumn("score", F.col("weight") + gumbel(id_col, seed)), "weighed")
    long = F.col("n_words") >= least
    n, able = rows.agg(F.count("*"), F.count_if(long)).first()
    return ranked(rows, long, [F.desc("score"), F.asc_nulls_last(id_col)], percent * able // 100, n)
