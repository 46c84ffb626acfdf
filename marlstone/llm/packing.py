"""Harmonic packing of tokenised documents into sequences of CAPACITY tokens.

A document's ids are cut into pieces whose lengths are exact reciprocals of the capacity: as long
as tokens are left, the next piece takes floor(CAPACITY / j) of them for the smallest j that fits.
Once TAIL or fewer are left, they are one piece of the class of their own length. A class holds
pieces of one length and its bins exactly floor(CAPACITY / length) of them, so a bin is full but
for a remainder shorter than j. Each worker numbers its pieces within their classes; the counts of
the workers, one row per worker and class, turn those into numbers over all workers, and with them
into bin and place, without moving a document. At most one bin of each class stays part filled;
those (a constant number of pieces, however many documents) are put together by first fit
decreasing, class by class.

Defined results: null and empty text are one piece of one token (the end id); equal texts give
equal pieces under their own ids, repeated ids repeat; an empty table gives no piece.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import _LOWER, _SPACE, Words, blocks, durable, tidy

CAPACITY, TAIL, END_ID = 4096, 32, 2
#: Spellings that a worker keeps with their ids, at most; beyond that it starts anew.
CACHE_WORDS = 500_000


class Encoder:
    """Ids of whole texts by a tokenizers file that lower-cases, whose tokens never hold white space,
    and that cuts a run of letters from a mark after it: each spelling between blanks, without such
    a mark, is encoded once and its ids are reused. Spellings are known by 64-bit hashes."""

    def __init__(self, path: str):
        # A task has one core; threads of the tokenizer's own would each keep memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.ends = np.zeros(1, np.int64)

    def _encode(self, words: list[bytes], plain: np.ndarray) -> list[np.ndarray]:
        """Ids of each word. plain: words of letters only, which are one token run each and end
        where an id ends a word; so many of them go to the tokenizer as one text."""
        out: list = [None] * len(words)
        some = np.flatnonzero(plain)
        texts = [some[i : i + 2000] for i in range(0, len(some), 2000)]
        for part in texts:  # one by one: an encoding takes far more memory than its text
            ids = np.array(self.tok.encode_batch_fast([b" ".join(words[i] for i in part).decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the tokenizer doesn't end every word with an end-of-word id")
            for i, x in zip(part.tolist(), np.split(ids, ends[:-1]), strict=True):
                out[i] = x
        rest = np.flatnonzero(~plain)
        for lo in range(0, len(rest), 1024):
            part = rest[lo : lo + 1024].tolist()
            for i, e in zip(part, self.tok.encode_batch_fast([words[i].decode("utf-8", "replace") for i in part], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32)
        return out

    def _learn(self, words: list[bytes], plain: np.ndarray) -> np.ndarray:
        """Entry numbers of new words."""
        ids = self._encode(words, plain)
        first = len(self.ends) - 1
        ends = self.used + np.cumsum([len(x) for x in ids], dtype=np.int64)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(int(ends[-1]), len(self.flat)), np.uint32)])
        self.flat[self.used : ends[-1]] = np.concatenate(ids)
        self.used = int(ends[-1])
        self.ends = np.concatenate([self.ends, ends])
        return np.arange(first, first + len(words))

    def documents(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the rows, each with the end id after it, and the n + 1 bounds."""
        if len(self.keys) > CACHE_WORDS:
            self._clear()
        low = _LOWER[data]
        # A full stop or comma between a letter and a blank is a word of its own.
        letter = (low >= 97) & (low <= 122)
        latin = np.zeros(len(low), bool)
        latin[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] != 0x97) & (low[1:] != 0xB7)
        mark = (low == 46) | (low == 44)
        mark[1:] &= (letter | latin)[:-1]
        mark[:-1] &= _SPACE[low[1:]] | np.isin(np.arange(1, len(low)), offs)
        mark[offs[:-1][offs[:-1] < len(low)]] = False
        at = np.flatnonzero(mark)
        offs = offs + np.searchsorted(at, offs)
        low = np.insert(low, at, 32)
        w = Words(low, offs)
        uniq, one, inv = np.unique(w.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == uniq[inside]
        if not known.all():
            new = one[~known]
            head = (low == 0xC3) & np.append(low[1:] >= 0x80, False) & np.append((low[1:] != 0x97) & (low[1:] != 0xB7), False)
            tail = np.append(False, head[:-1])
            odd = np.concatenate([[0], np.cumsum(~(((low >= 97) & (low <= 122)) | head | tail))])
            start, end, raw = w.start[new], w.end[new], low.tobytes()
            entry = self._learn([raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], odd[end] == odd[start])
            self.keys = np.insert(self.keys, place[~known], uniq[~known])
            self.entry = np.insert(self.entry, place[~known], entry)
        of = self.entry[np.searchsorted(self.keys, uniq)][inv] if len(uniq) else np.zeros(0, np.int64)
        size = self.ends[of + 1] - self.ends[of]
        first = np.concatenate([[0], np.cumsum(size)])
        src = np.repeat(self.ends[of] - first[:-1], size) + np.arange(first[-1])
        bound = first[w.first] + np.arange(len(w.first))
        out = np.full(bound[-1], END_ID, np.uint32)
        keep = np.ones(len(out), bool)
        keep[bound[1:] - 1] = False
        out[keep] = self.flat[src]
        return out, bound


def cuts(n: int) -> list[int]:
    """Lengths of the pieces of n tokens."""
    out = [CAPACITY] * (n // CAPACITY)
    n %= CAPACITY
    while n > TAIL:
        j = -(-CAPACITY // n)
        out.append(CAPACITY // j)
        n -= CAPACITY // j
    return [*out, n] if n else out


def pieces(df: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document with the worker's number and their number within worker and length."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One encoder a task: kept in the worker, it would take memory from the stages after it.
        enc, worker = Encoder(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for a, _, data, offs in blocks(b.column("text"), 1 << 19):
                flat, bound = enc.documents(data, offs)
                rows = []
                for i in range(len(bound) - 1):
                    lo, hi = int(bound[i]), int(bound[i + 1])
                    start = 0
                    for n in cuts(hi - lo):
                        k = seen.get(n, 0)
                        seen[n] = k + 1
                        rows.append((ids[a + i], start, n, zlib.crc32(flat[lo + start : lo + start + n].data), hi - lo, worker, k))
                        start += n
                cols = list(zip(*rows, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "nth"])

    return source.mapInArrow(tidy(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker long, nth long")


def first_fit(left: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """Bins for left[length] pieces of each length: (length, first, count, bin, offset)."""
    out, room = [], []
    for n in sorted(left, reverse=True):
        first, todo = 0, left[n]
        for i in range(len(room)):
            k = min(todo, room[i] // n)
            if k:
                out.append((n, first, k, i, CAPACITY - room[i]))
                room[i] -= k * n
                first, todo = first + k, todo - k
        while todo:
            k = min(todo, CAPACITY // n)
            out.append((n, first, k, len(room), 0))
            room.append(CAPACITY - k * n)
            first, todo = first + k, todo - k
    return out


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    spark = df.sparkSession
    made = durable(pieces(df, tokenizer, id_col, text_col), "pieces")
    counts = made.groupBy("length", "worker").agg(F.count("*").alias("n"))
    # One row per length: at most TAIL + the reciprocals of the capacity above it.
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    bins, left = [], {}
    base = 0
    for n in sorted(total, reverse=True):
        full = total[n] // (CAPACITY // n)
        bins.append((n, base, full * (CAPACITY // n)))
        base += full
        if total[n] % (CAPACITY // n):
            left[n] = total[n] % (CAPACITY // n)
    runs = [(n, first, first + k, base + i, at) for n, first, k, i, at in first_fit(left)]
    earlier = counts.select("length", "worker", (F.sum("n").over(Window.partitionBy("length").orderBy("worker")) - F.col("n")).alias("before"))
    classes = spark.createDataFrame(bins, "length long, base long, whole long")
    rest = spark.createDataFrame(runs, "length long, first long, beyond long, bin long, at long")
    placed = (
        made.join(earlier, ["length", "worker"])
        .join(F.broadcast(classes), "length")
        .withColumn("g", F.col("before") + F.col("nth"))
        .withColumn("over", F.col("g") - F.col("whole"))
        .alias("p")
        .join(F.broadcast(rest).alias("r"), (F.col("p.length") == F.col("r.length")) & (F.col("over") >= F.col("first")) & (F.col("over") < F.col("beyond")), "left")
    )
    per = F.floor(F.lit(CAPACITY) / F.col("p.length"))
    return placed.select(
        "doc_id", "start", F.col("p.length").alias("length"), "ids_crc32", "doc_tokens",
        F.when(F.col("over") < 0, F.col("base") + F.floor(F.col("g") / per)).otherwise(F.col("bin")).cast("long").alias("sequence_id"),
        F.when(F.col("over") < 0, F.pmod(F.col("g"), per) * F.col("p.length")).otherwise(F.col("at") + (F.col("over") - F.col("first")) * F.col("p.length")).cast("long").alias("offset"),
    )
