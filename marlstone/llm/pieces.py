"""SentencePiece encoding and decoding over a relational lattice.

Text becomes units: a dummy blank goes before it, blanks become U+2581, and a unit runs from a run
of those to the next; line feeds stand alone (no piece holds one, nor a U+2581 after another
character, which read_model checks, so units are encoded independently). A Cutter cuts units further, into
parts, where no piece crosses. Every distinct part of at most LONGEST characters is a word of the lattice: its
substrings of bounded length are exploded and equi-joined to the piece table, the edges are grouped by word, and
a Spark higher-order aggregate folds them:

* unigram models: Viterbi, the segmentation with the highest sum of scores;
* BPE models: the merges of the model, at each step the adjacent pair whose piece has the best
  score, leftmost first. Viterbi over a BPE model's scores, which are merge ranks, doesn't give
  SentencePiece's segmentation; this does.

Characters without a piece are spelled as byte pieces. Ids go back to the texts on two ways: those
of the DICTIONARY most frequent parts as a broadcast, those of all others by a join of the parts of
each row. Parts of over LONGEST characters, which no mask of a long holds, are folded by the same
rules in the task that meets them.

Defined results: null or empty text has no pieces; equal texts have equal ids; decode() of
encode() is the text, but that U+2581 comes back as a blank; repeated ids are rows of their own.
"""

from __future__ import annotations

import contextlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from .common import blocks, discard, durable, lists, tidy, unused

BLANK = "▁"
#: Parts whose ids are broadcast, at most, and characters of a part in the lattice.
DICTIONARY, LONGEST = 300_000, 60
#: Stands for the id of a character without a piece; ids are smaller.
NO_PIECE = (1 << 20) - 1
#: Distinct parts that one task of the lattice folds, about.
FOLDED = 20_000
#: Bytes of texts that are cut at once, about, and kinds of characters of a Cutter, of which the last is all others.
BLOCK, KINDS = 2 << 20, 4000
_zstd = pa.Codec("zstd", compression_level=1)
UNIT = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")


@dataclass
class Model:
    pieces: dict[str, tuple[int, float]]
    kind: str  # "unigram" or "bpe"
    spelled: list[str]  # hexadecimal UTF-8 of every id
    bytes_at: int  # id of byte 0
    longest: int


def read_model(path: str, kind: str = "bpe") -> Model:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelled, longest = {}, [], 1
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            spelled.append(p[3:5].lower())
        elif sp.is_control(i) or sp.is_unknown(i):
            spelled.append("")
        else:
            if "\n" in p or BLANK in p.lstrip(BLANK):
                raise ValueError(f"units can't be cut apart: piece {p!r}")
            pieces[p] = (i, sp.get_score(i))
            spelled.append(p.encode().hex())
            longest = max(longest, len(p))
    return Model(pieces, kind, spelled, sp.piece_to_id("<0x00>"), longest)


def merges(unit: str, m: Model, log: list | None = None) -> list[str]:
    """The parts that a BPE model's merges leave of a unit, the best pair first, leftmost on ties; a
    heap of pairs over a chain of parts, so that a unit of n characters takes n log n steps. log: gets both
    parts of every merge."""
    parts, n, get = list(unit), len(unit), m.pieces.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-s[1], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (s := get(a + b))]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        if i >= 0 and j < n and (s := get(parts[i] + parts[j])):
            heapq.heappush(heap, (-s[1], i, parts[i], parts[j]))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if j >= n or parts[i] != a or parts[j] != b:  # one of the two has been merged meanwhile
            continue
        parts[i], parts[j], after[i] = a + b, "", after[j]
        if log is not None:
            log.append((a, b))
        if after[j] < n:
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    return [x for x in parts if x]


def turns(m: Model) -> dict[str, tuple[int, int, int, int]]:
    """Of every longer piece that a BPE model's merges can make: the length of its left part at the last merge, and
    its turn among all merges of a unit, as rank, offset and order. While a piece's characters meet only each other,
    as they must until it is made, they merge as they do alone: so the parts are the same in every unit, and a piece
    that doesn't come about alone never does. A piece with a worse score than its parts waits for its rank (offset
    and order 0). Any other is the best pair as soon as its later part is there, so its turn is right after that:
    rank and place (offset) of what set this off, and the order of what may follow there. That holds in units
    without tied() pieces."""
    rank = {p: r for r, (p, _) in enumerate(sorted(m.pieces.items(), key=lambda x: -x[1][1]))}
    out: dict[str, tuple[int, int, int, int]] = {}
    after: dict[int, list[tuple[int, int, str]]] = {}
    for p in sorted(m.pieces, key=len):
        log: list[tuple[str, str]] = []
        if len(p) == 1 or merges(p, m, log) != [p]:
            continue
        x, y = log[-1]
        last = max((out[part][1], at + out[part][2], out[part][3]) for part, at in ((x, 0), (y, len(x))) if part in out) if x in out or y in out else (-1, 0, 0)
        if rank[p] > last[0]:
            out[p] = (len(x), rank[p], 0, 0)
        else:  # the order is the number of steps since, for now
            out[p] = (len(x), last[0], last[1], last[2] + 1)
            after.setdefault(last[0], []).append((last[2] + 1, rank[p], p))
    for following in after.values():
        for k, (_, _, p) in enumerate(sorted(following)):
            out[p] = (*out[p][:3], k + 1)
    return out


def tied(m: Model) -> list[str]:
    """The longer pieces that share their score with another, less those that hold another one of these."""
    scores = Counter(s for p, (_, s) in m.pieces.items() if len(p) > 1)
    out: list[str] = []
    for p in sorted((p for p, (_, s) in m.pieces.items() if len(p) > 1 and scores[s] > 1), key=len):
        if len(out) <= 8 and not any(x in p for x in out):
            out.append(p)
    return out


def fold(unit: str, m: Model) -> list[int]:
    """Ids of one unit, by the rules of the lattice's fold."""
    if unit in m.pieces and m.kind == "bpe" and len(unit) == 1:
        return [m.pieces[unit][0]]
    if m.kind == "bpe":
        parts = merges(unit, m)
    else:
        n = len(unit)
        best = [0.0] + [-1e300] * n
        back = [0] * (n + 1)
        for e in range(1, n + 1):
            for s in range(max(0, e - m.longest), e):
                p = m.pieces.get(unit[s:e])
                worth = p[1] if p else (UNKNOWN if e - s == 1 else None)
                if worth is not None and best[s] + worth > best[e]:
                    best[e], back[e] = best[s] + worth, s
        cuts = [n]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        parts = [unit[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    out: list[int] = []
    for p in parts:
        got = m.pieces.get(p)
        out += [got[0]] if got else [m.bytes_at + x for x in p.encode()]
    return out


#: Score of a character without a piece in a unigram lattice.
UNKNOWN = -1e6


def units(text: str) -> list[str]:
    if not text:
        return []
    if "  " in text or text[0] == " " or BLANK in text:
        return UNIT.findall(BLANK + text.replace(" ", BLANK))
    return [u for u in (BLANK + text.replace(" ", " " + BLANK).replace("\n", " \n ")).split(" ") if u]


@dataclass
class Parts:
    """Parts of some texts: their bounds by text, and of each its place among the different ones (told, and their
    lengths)."""

    bounds: np.ndarray
    which: np.ndarray
    told: pa.StringArray
    size: np.ndarray

    @cached_property
    def words(self) -> list[str]:
        return self.told.to_numpy(zero_copy_only=False).tolist()

    def known(self, index: dict[str, int]) -> np.ndarray:
        """Of every word its place in index, or -1."""
        return np.fromiter((index.get(w, -1) for w in self.words), np.int64, len(self.told))

    def rare(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and place in words of the parts of at most LONGEST characters that aren't known, each once a text, as
        they come in it."""
        at = np.flatnonzero(((known < 0) & (self.size <= LONGEST))[self.which])
        text = np.searchsorted(self.bounds, at, "right") - 1
        once = np.sort(np.unique(text * len(self.told) + self.which[at], return_index=True)[1])
        return text[once], self.which[at[once]]


class Cutter:
    """Cuts texts into parts. For a BPE model two characters stay together if any piece holds them side by side:
    no merge crosses another cut, so parts have the ids that they have in their unit, and there are fewer and shorter
    ones than units. For a unigram model parts are units."""

    def __init__(self, m: Model):
        self.kind = np.zeros(0x110000, np.uint16)  # 0: never with others
        if m.kind == "bpe":
            pairs = {p[i : i + 2] for p in m.pieces for i in range(len(p) - 1)}
            for k, (c, _) in enumerate(Counter(c for p in pairs for c in p).most_common()):
                self.kind[ord(c)] = min(k + 1, KINDS)
            together = {(int(self.kind[ord(a)]), int(self.kind[ord(b)])) for a, b in pairs}
        else:
            self.kind[:] = 2
            self.kind[ord("\n")], self.kind[ord(BLANK)] = 0, 1
            together = {(1, 1), (1, 2), (2, 2)}
        self.kinds = int(self.kind.max()) + 1
        self.together = np.zeros(self.kinds * self.kinds, bool)
        for a, b in together:
            self.together[a * self.kinds + b] = True
        self.kind[ord(" ")] = self.kind[ord(BLANK)]  # blanks are replaced in the different parts alone
        low = self.kind[:256].astype(np.int64)
        self.apart = ~self.together[low[:, None] * self.kinds + low].ravel()  # of two characters below 256

    def cut(self, texts: list[str | None]) -> Parts:
        s = "".join([" " + t for t in texts if t])
        if BLANK in s:
            s = s.replace(BLANK, " ")
        raw, n = s.encode(), len(s)
        ends = np.cumsum([0] + [len(t) + 1 if t else 0 for t in texts])
        first = np.ones(n, bool)
        try:
            points = np.frombuffer(raw if len(raw) == n else s.encode("latin-1"), np.uint8)
            first[1:] = self.apart[points[:-1].astype(np.uint16) << np.uint16(8) | points[1:]]
        except UnicodeEncodeError:
            kind = self.kind[np.frombuffer(s.encode("utf-32-le"), np.uint32)].astype(np.int32)
            first[1:] = ~self.together[kind[:-1] * self.kinds + kind[1:]]
        first[ends[ends < n]] = True
        start = np.flatnonzero(first)
        at = start if len(raw) == n else np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[start]
        # Cut in place, in the bytes of all texts.
        every = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.append(at, len(raw)).astype(np.int32)), pa.py_buffer(raw))
        every = every.dictionary_encode()
        told = pc.replace_substring(every.dictionary, " ", BLANK)
        return Parts(np.searchsorted(start, ends), every.indices.to_numpy(), told, pc.utf8_length(told).to_numpy())


def _edges(words: DataFrame, table: DataFrame, m: Model) -> DataFrame:
    """Substrings of bounded length as edges; a lone character is an edge with or without a piece."""
    starts = words.select("*", F.explode(F.expr("sequence(0, length(word) - 1)")).alias("s"))
    spans = starts.select("*", F.explode(F.expr(f"sequence(s + 1, least(s + {m.longest}, length(word)))")).alias("e"))
    # The piece table is bounded by the model: tens of thousands of short strings.
    edges = spans.withColumn("piece", F.expr("substring(word, s + 1, e - s)")).join(F.broadcast(table), "piece", "left")
    return edges.where("id is not null or e = s + 1").withColumn("id", F.coalesce("id", F.lit(NO_PIECE)))


def lattice(words: DataFrame, m: Model, spark: SparkSession, folded: bool = False) -> DataFrame:
    """word, any further columns, and ids of every word (distinct, of at most LONGEST characters). folded: by
    the fold that looks for the best pair at each step, in any case."""
    more = [c for c in words.columns if c != "word"]
    if len(m.spelled) > NO_PIECE:
        raise ValueError(f"{len(m.spelled)} pieces, {NO_PIECE} at most")
    ranks = {s: r for r, s in enumerate(sorted({s for _, s in m.pieces.values()}, reverse=True))}
    if m.kind == "bpe" and m.longest < 32 and len(m.spelled) < 0xFFFF and len(alike := tied(m)) <= 8 and not folded:
        # Words without pieces of equal scores (of public models: runs of blanks) take one pass.
        odd = reduce(lambda a, b: a | b, (F.contains("word", F.lit(x)) for x in alike), F.lit(False))
        turn = {p: t for p, t in turns(m).items() if not any(x in p for x in alike)}
        if max((t[3] for t in turn.values()), default=0) < 256:
            some = _ordered_fold(words.where(~odd), turn, m, spark)
            return some.unionByName(lattice(words.where(odd), m, spark, folded=True)) if alike else some
    table = spark.createDataFrame([(p, i, s, ranks[s]) for p, (i, s) in m.pieces.items()], "piece string, id int, score double, rank long")
    edges = _edges(words, table, m)
    size, one = F.length("word"), F.lit(1).cast("long")
    bit = lambda i: F.call_function("shiftleft", one, i)
    # Bit i of a mask is a cut before character i: an edge has two at its ends, others inside.
    span = lambda s, e: (s.alias("s"), e.alias("e"), (bit(e) - bit(s + 1)).alias("inner"), bit(e).bitwiseOR(bit(s)).alias("ends"))
    if m.kind == "bpe":
        # An edge is one long while edges are grouped: rank by score (43 bits), start and end (6 each), id.
        code = F.expr("shiftleft(coalesce(rank, 0L), 32) | shiftleft(bigint(s), 26) | shiftleft(e, 20) | id")
        grouped = edges.groupBy("word", *more).agg(F.collect_list(code).alias("codes"))
        place = lambda x, at, most: F.shiftright(x, at).bitwiseAND(F.lit(most)).cast("int")
        opened = F.transform("codes", lambda x: F.struct(x.alias("code"), *span(place(x, 26, 63), place(x, 20, 63)), x.bitwiseAND(F.lit(NO_PIECE)).cast("int").alias("id")))
        grouped = grouped.withColumn("edges", opened).withColumn("pairs", F.filter("edges", lambda e: e.e - e.s > 1))
        # The state is a mask, of all cuts at first. The pairs that can merge have both ends and one
        # cut inside; the least code has the best score, leftmost, and clears it. Each merges once.
        cut = F.aggregate(
            F.sequence(F.lit(0), F.least(F.size("pairs"), size)), F.expr("shiftleft(1L, length(word) + 1) - 1"),
            lambda mask, _: F.coalesce(mask.bitwiseAND(F.bitwise_not(F.array_min(F.filter("pairs", lambda e: (mask.bitwiseAND(e.ends) == e.ends) & (F.bit_count(mask.bitwiseAND(e.inner)) == 1)))["inner"])), mask),
        )
    else:
        grouped = edges.groupBy("word", *more).agg(F.sort_array(F.collect_list(F.struct(*span(F.col("s"), F.col("e")), "id", "score"))).alias("edges"))
        # State: best sum and path for every end so far; edges come ordered by start, so the state
        # of a start is final when its edges are met. Ties keep the earlier start.
        start = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(F.when(i == 0, 0.0).otherwise(-1e300).alias("sum"), F.lit(-1).alias("back")))
        state = F.aggregate("edges", start, lambda st, e: F.transform(st, lambda x, i: F.when((i == e.e) & (F.get(st, e.s)["sum"] + F.coalesce(e.score, F.lit(UNKNOWN)) > x["sum"]), F.struct((F.get(st, e.s)["sum"] + F.coalesce(e.score, F.lit(UNKNOWN))).alias("sum"), e.s.alias("back"))).otherwise(x)))
        grouped = grouped.withColumn("state", state)
        none = F.struct(size.alias("at"), F.expr("shiftleft(1L, length(word))").alias("mask"))
        cut = F.aggregate(F.sequence(F.lit(1), size), none, lambda a, _: F.when(a["at"] > 0, F.struct(F.get("state", a["at"])["back"].alias("at"), a["mask"].bitwiseOR(bit(F.get("state", a["at"])["back"])).alias("mask"))).otherwise(a))["mask"]
    path = F.filter("edges", lambda e: (F.col("cut").bitwiseAND(e.ends) == e.ends) & (F.col("cut").bitwiseAND(e.inner) == 0))
    path = F.sort_array(F.transform(path, lambda e: F.struct(e.s, e.id)))
    ids = F.flatten(F.transform("path", lambda e: F.when(e.id == NO_PIECE, _spell(F.substring("word", e.s + 1, F.lit(1)), m)).otherwise(F.array(e.id))))
    return grouped.withColumn("cut", cut).withColumn("path", path).select("word", *more, ids.alias("ids"))


def _spell(c, m: Model):
    """Byte pieces of a character."""
    return F.transform(F.sequence(F.lit(1), F.octet_length(c)), lambda i: F.conv(F.substring(F.hex(F.encode(c, "UTF-8")), 2 * i - 1, F.lit(2)), 16, 10).cast("int") + m.bytes_at)


def _ordered_fold(words: DataFrame, turn: dict[str, tuple[int, int, int, int]], m: Model, spark: SparkSession) -> DataFrame:
    """lattice() by one pass over a word's edges in the order of their turns(); a piece without one is no edge."""
    more = [c for c in words.columns if c != "word"]
    of = [(p, i, *turn.get(p, (0, 0, 0, 0))) for p, (i, _) in m.pieces.items() if len(p) == 1 or p in turn]
    edges = _edges(words, spark.createDataFrame(of, "piece string, id int, left int, turn long, offset int, nth int"), m)
    none = 0xFFFF
    one = F.lit(1).cast("long")
    up = lambda x, n: F.call_function("shiftleft", x, n)
    down = lambda x, n: F.call_function("shiftright", x, n)
    # An edge is one long: its turn (16 bits, 6 for the place, 8), start (6), length, length of the left part (5 each), id (16).
    fields = [("coalesce(turn, 0)", 46), ("s + coalesce(offset, 0)", 40), ("coalesce(nth, 0)", 32), ("s", 26), ("e - s", 21), ("coalesce(left, 0)", 16), (f"id & {none}", 0)]
    code = F.expr(" | ".join(f"shiftleft(bigint({x}), {at})" for x, at in fields))
    grouped = edges.groupBy("word", *more).agg(F.sort_array(F.collect_list(code)).alias("codes"))
    field = lambda c, at, most: down(c, F.lit(at)).bitwiseAND(F.lit(most)).cast("int")
    start, length, left = (lambda c: field(c, 26, 63)), (lambda c: field(c, 21, 31)), (lambda c: field(c, 16, 31))
    # Bit i of the state is a cut before character i, all at first; an edge's part of it, from its start on.
    part = lambda mask, c: down(mask, start(c)).bitwiseAND(up(one, length(c) + 1) - 1)
    merge = lambda mask, c: F.when(part(mask, c) == up(one, length(c)).bitwiseOR(up(one, left(c))).bitwiseOR(one), mask.bitwiseXOR(up(one, start(c) + left(c)))).otherwise(mask)
    # What the last state leaves is found as the fold ends: a column of its own might be worked out for every edge.
    kept = lambda mask: F.filter("codes", lambda c: part(mask, c) == up(one, length(c)).bitwiseOR(one))
    path = lambda mask: F.sort_array(F.transform(kept(mask), lambda c: start(c) * (none + 1) + c.bitwiseAND(F.lit(none)).cast("int")))
    path = F.aggregate(F.filter("codes", lambda c: left(c) > 0), F.expr("shiftleft(1L, length(word) + 1) - 1"), merge, path)
    plain = F.transform("path", lambda x: x.bitwiseAND(F.lit(none)))
    letter = lambda x: F.substring("word", F.shiftright(x, 16) + 1, F.lit(1))
    spelled = F.flatten(F.transform("path", lambda x: F.when(x.bitwiseAND(F.lit(none)) == none, _spell(letter(x), m)).otherwise(F.array(x.bitwiseAND(F.lit(none))))))
    ids = F.when(F.exists("path", lambda x: x.bitwiseAND(F.lit(none)) == none), spelled).otherwise(plain)
    return grouped.withColumn("path", path).select("word", *more, ids.alias("ids"))


def units_of(text):
    """units() of a text column, as a column; an empty text has one blank unit here."""
    return F.regexp_extract_all(F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK))), F.lit(UNIT.pattern), F.lit(0))


def spellings(df: DataFrame, m: Model, text_col: str, most: int = DICTIONARY, cutter: Cutter | None = None) -> DataFrame:
    """word, frequent, ids of all distinct units (or parts, by a cutter) of at most LONGEST characters; frequent are
    those, most at most, that occur at least as often as any of them."""
    if cutter is None:
        seen = df.select(F.explode(units_of(F.col(text_col))).alias("word"), F.lit(1).alias("n")).where(F.length("word") <= LONGEST)
    else:
        shared = df.sparkSession.sparkContext.broadcast(cutter)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi, _, _ in blocks(b.column(0), BLOCK):
                    parts = shared.value.cut(b.column(0).slice(lo, hi - lo).to_pylist())
                    found = pa.RecordBatch.from_arrays([parts.told, pa.array(np.bincount(parts.which, minlength=len(parts.told)))], names=["word", "n"])
                    yield found.filter(pa.array(parts.size <= LONGEST))

        seen = df.select(text_col).mapInArrow(tidy(count), "word string, n long")
    counts = durable(seen.groupBy("word").agg(F.sum("n").alias("n")), "units")
    ladder = counts.groupBy(F.least("n", F.lit(5000)).alias("n")).agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()
    total, least = 0, None
    for r in ladder:
        if total + r["words"] > most:
            break
        total, least = total + r["words"], r["n"]
    frequent = F.lit(False) if least is None else F.col("n") >= least
    # Dealt out by word before the substrings are exploded, so that edges meet without a shuffle.
    dealt = counts.select("word", frequent.alias("frequent")).repartition(sum(r["words"] for r in ladder) // FOLDED + 8, "word")
    with _by_hash(df.sparkSession):
        out = durable(lattice(dealt, m, df.sparkSession), "spellings")
    discard(counts)
    return out


@contextlib.contextmanager
def _by_hash(spark: SparkSession):
    """While it is entered, edges are grouped by a hash table for all words of a task, and not sorted."""
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(2 * FOLDED))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Speller:
    """Ids of parts: the broadcast ones, those that came with the rows, and long parts."""

    def __init__(self, m: Model, cutter: Cutter, words: pa.Table):
        self.m, self.cutter, self.words = m, cutter, words

    def __reduce__(self):  # the dictionary is made once in a worker, where the broadcast is read
        return Speller, (self.m, self.cutter, self.words)

    @cached_property
    def index(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words.column("word").to_numpy().tolist())}

    @cached_property
    def dictionary(self) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the broadcast words, and the bounds of each."""
        words = self.words
        col = words.column("ids").combine_chunks()
        flat = col.flatten().to_numpy().astype(np.int32) if len(words) else np.zeros(0, np.int32)
        return flat, (col.offsets.to_numpy() - col.offsets[0].as_py()).astype(np.int64) if len(words) else np.zeros(1, np.int64)

    def block(self, texts: list[str | None], came: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and the n + 1 bounds. came: for each text the ids of its rare() parts in their order."""
        parts = self.cutter.cut(texts)
        known = parts.known(self.index)
        text, rare = parts.rare(known)
        if not np.array_equal(np.bincount(text, minlength=len(texts)), pc.fill_null(pc.list_value_length(came), 0).to_numpy(zero_copy_only=False)):
            raise ValueError("the input gave other rows when it was read again")
        each = came.flatten()
        own, bounds = self.dictionary
        size = np.where(known < 0, 0, bounds[known + 1] - bounds[known])
        first = np.where(known < 0, 0, bounds[known])
        size[rare] = pc.list_value_length(each).to_numpy(zero_copy_only=False)
        first[rare] = len(own) + np.cumsum(size[rare]) - size[rare]
        flat = [own, each.flatten().to_numpy(zero_copy_only=False).astype(np.int32)]
        at = sum(map(len, flat))
        for i in np.flatnonzero(size == 0).tolist():
            flat.append(np.array(fold(parts.words[i], self.m), np.int32))
            first[i], size[i] = at, len(flat[-1])
            at += len(flat[-1])
        size, first = size[parts.which], first[parts.which]
        ends = np.concatenate([[0], np.cumsum(size)])
        return np.concatenate(flat)[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])], ends[parts.bounds]


class Decoder:
    """Texts of ids that encode() gave, by a model that has the blank as a piece: the bytes of their pieces, taken one
    after another."""

    def __init__(self, m: Model):
        whole = [bytes.fromhex(x).replace(BLANK.encode(), b" ") for x in m.spelled]
        # A second time without a leading blank, for the first piece of a text.
        self.bytes, self.head = pa.array([*whole, *(x.removeprefix(b" ") for x in whole)], pa.binary()), len(whole)

    def texts(self, flat: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        if not len(flat):
            return pa.array([""] * (len(bounds) - 1), pa.string())
        ids = flat.astype(np.int32)
        ids[bounds[:-1][bounds[:-1] < bounds[1:]]] += self.head
        spelled = self.bytes.take(pa.array(ids))
        _, at, data = spelled.buffers()
        at = np.frombuffer(at, np.int32)[: len(ids) + 1]
        return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(at[bounds]), data)


def _pack(raw: bytes | None) -> bytes | None:
    """A text for a shuffle, compressed."""
    if raw is None:
        return None
    return len(raw).to_bytes(4, "little") + _zstd.compress(raw, asbytes=True)


def _unpack(b: bytes | None) -> str | None:
    return None if b is None else _zstd.decompress(b[4:], int.from_bytes(b[:4], "little"), asbytes=True).decode()


def _spans(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """First and last row of runs of rows of about most bytes; a longer row is a run of its own."""
    ends = np.cumsum([0, *sizes])
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        yield a, b
        a = b


def encode(df: DataFrame, model: str, kind: str = "bpe", text_col: str = "text", keep: tuple[str, ...] = ("doc_id", "text"), most: int = DICTIONARY, back: str | None = None) -> DataFrame:
    """The columns in keep and ids, the piece ids of every row's whole text. back: a further column, the text that these
    ids give, as by decoded()."""
    m = read_model(model, kind)
    decoder = Decoder(m) if back and BLANK in m.pieces else None  # else blanks may come as bytes, which decoded() puts together
    cutter = Cutter(m)
    body = text_col if text_col in keep else unused("_text", keep)  # a text travels once
    own = [*keep] if text_col in keep else [*keep, F.col(text_col).alias(body)]
    key, other, rare = (unused(x, (*keep, body)) for x in ("_key", "_other", "_rare"))
    # A row is known by two hashes of its columns, so that texts needn't be written again to number them.
    plain = df.select(*own)
    of = [f.name for f in plain.schema if "map<" not in f.dataType.simpleString()]
    source = plain.select("*", F.xxhash64(*of).alias(key), F.xxhash64(F.lit(1), *of).alias(other))
    spelled = spellings(source, m, body, most, cutter)
    often = spelled.where("frequent").select("word", "ids")
    shared = df.sparkSession.sparkContext.broadcast(Speller(m, cutter, often.toArrow()))  # at most `most` rows

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = shared.value
        for b in batches:
            for lo, hi, _, _ in blocks(b.column(2), BLOCK):
                parts = speller.cutter.cut(b.column(2).slice(lo, hi - lo).to_pylist())
                row, at = parts.rare(parts.known(speller.index))
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(row + lo)) for i in (0, 1)), pa.array(nth.astype(np.int32)), parts.told.take(pa.array(at))], names=["key", "other", "nth", "word"])

    met = source.where(F.col(body) != "").select(key, other, body).mapInArrow(tidy(meet), "key long, other long, nth int, word string")
    met = met.join(spelled.where("not frequent").select("word", "ids"), "word")
    # Rare parts are known by their place in the row. Written, so that the shuffle files of parts are gone when the
    # texts are shuffled.
    ids = F.transform(F.sort_array(F.collect_set(F.struct("nth", "ids"))), lambda x: x["ids"])
    met = durable(met.groupBy(F.col("key").alias(key), F.col("other").alias(other)).agg(ids.alias(rare)), "rare")
    discard(spelled)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(body)
            yield b.set_column(at, body, pa.array([_pack(t) for t in b.column(at).cast(pa.binary()).to_pylist()], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [0 if t is None else int.from_bytes(t[:4], "little") for t in b.column(body).to_pylist()]
            for lo, hi in _spans(sizes, BLOCK):
                part = b.slice(lo, hi - lo)
                texts = [_unpack(t) for t in part.column(body).to_pylist()]
                flat, bound = shared.value.block(texts, part.column(rare))
                given = [*(pa.array(texts, pa.string()) if c == body else part.column(c) for c in keep), lists(flat, bound)]
                yield pa.RecordBatch.from_arrays([*given, decoder.texts(flat, bound)] if decoder else given, names=out.names)

    packed = source.mapInArrow(tidy(pack), StructType([StructField(f.name, BinaryType()) if f.name == body else f for f in source.schema]))
    out = StructType([*(source.schema[c] for c in keep), StructField("ids", ArrayType(IntegerType())), *([StructField(back, StringType())] if decoder else [])])
    done = packed.join(met, [key, other], "left").drop(key, other).mapInArrow(tidy(run), out)
    return done.withColumn(back, decoded("ids", model)) if back and not decoder else done


def decoded(ids: str, model: str):
    """The text of a column of piece ids, as a column."""
    m = read_model(model)
    whole = [bytes.fromhex(x).decode(errors="ignore").replace(BLANK, " ") for x in m.spelled]
    private = (chr(c) for c in range(0xE000, 0xF8FF))
    taken = set("".join(whole))
    between, half = (next(c for c in private if c not in taken) for _ in range(2))
    for i in range(m.bytes_at + 128, m.bytes_at + 256):  # bytes that are no character alone
        whole[i] = half
    # Of pieces that are whole characters the text is there at once; others go by their bytes.
    as_list = lambda texts, sep: F.split(F.lit(sep.join(texts)), sep)
    join = lambda texts, sep: F.array_join(F.transform(ids, lambda i: F.get(as_list(texts, sep), i)), "")
    by_bytes = F.replace(F.decode(F.unhex(join(m.spelled, ",")), "UTF-8"), F.lit(BLANK), F.lit(" "))
    once = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  # f of x, which is worked out once
    spaced = once(join(whole, between), lambda x: F.when(F.contains(x, F.lit(half)), by_bytes).otherwise(x))
    return once(spaced, lambda x: F.when(F.startswith(x, F.lit(" ")), F.substring(x, F.lit(2), F.length(x))).otherwise(x))
