"""Scoring texts with an n-gram model held as Elias-Fano tries.

Counting. Documents are cut into chunks of CHUNK bytes inside their tasks. A chunk keeps its words
as places in its own sorted word list. Order by order, it sends the sorted keys of its distinct
n-grams with their training counts, range-partitioned by key into shards of about SHARD n-grams; so
a frequent n-gram costs one entry per chunk, not one per occurrence, and no shard is hot. A shard
sums the counts of all chunks and returns to each chunk the totals of the n-grams it asked for.
Nothing is pruned, capped or sampled, and no task or driver holds the whole model.

Model. p1(w) = (c(w) + 1) / (N + V + 1) and, for orders above one, Dirichlet-smoothed
p(w | context) = (c(context w) + MU p'(w)) / (c(context) + MU) with p' of the next lower order; an
unseen context passes p' on. Document start is a context like the end token.

Query. A chunk's slice of the model is a trie of ORDER levels: level 1 the chunk's words, level k the
successors of level k - 1 entries, as Elias-Fano sequences: monotone pointers to the first
successor, and successors made monotone by their context's place. Probabilities and back-off weights
are quantised to 16 bits. The levels lie in one memory map and stay packed: an entry is found
between its context's two pointers, which are selects on the packed high bits, by the high bits of
the successor sought (selects again) and, by halves, the packed low bits of the entries that share them.

Words and n-grams are keyed by 64-bit hashes: of n distinct ones about n * n / 2^65 pairs would share one.

Defined results: null, empty or blank text is the end token alone; equal texts score alike,
repeated ids repeat, null ids stay; a null held_col counts as false; with no training rows N = V = 0,
every token is unknown and p1 = 1.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, blocks, deltas, durable, expand, lists, mix, squeeze, tidy, undelta

ORDER, MU = 4, 64.0
#: Bytes of text in a chunk; n-grams of an order in a shard.
CHUNK, SHARD = 6 << 20, 2 << 20
END = np.uint64(0x9D39247E33776D41)
_STEP = 4096.0  # quantised log10 probabilities: 16 bits, one step is 1 / _STEP


# ---- Elias-Fano ------------------------------------------------------------------------------

_u = np.uint64
_L, _H = _u(0x0101010101010101), _u(0x8080808080808080)
_M1, _M2, _M4 = _u(0x5555555555555555), _u(0x3333333333333333), _u(0x0F0F0F0F0F0F0F0F)
#: Place of the r-th set bit of every byte.
_IN_BYTE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for r in range(8)] for b in range(256)], np.uint64)


def select(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Places of the i-th set bits (from 0) of packed words; before: set bits before each word."""
    w = np.searchsorted(before, i, "right") - 1
    r = (i - before[w]).astype(np.uint64)
    x = words[w]
    c = x - ((x >> _u(1)) & _M1)
    c = (c & _M2) + ((c >> _u(2)) & _M2)
    c = ((c + (c >> _u(4))) & _M4) * _L  # byte j: set bits of bytes 0 to j
    k = (((((r * _L) | _H) - c) & _H) >> _u(7)) * _L >> _u(56) << _u(3)
    r -= (c << _u(8)) >> k & _u(255)
    return (w << 6) + (k + _IN_BYTE[(x >> k & _u(255)).astype(np.int64), r.astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence of n integers below a bound: low bits packed, high bits unary, and
    the set bits before each word of the high bits. Everything is read from the packed parts."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in parts["head"])
        self.high, self.ones, self.low = parts["high"], parts["ones"], parts["low"]

    @staticmethod
    def build(v: np.ndarray, bound: int) -> dict[str, np.ndarray]:
        n = len(v)
        low = max(0, int(bound // max(1, n)).bit_length() - 1)
        v = v.astype(np.uint64)
        bits = np.zeros(-(-((int(bound) >> low) + n + 2) // 64) * 64, np.uint8)
        bits[(v >> _u(low)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int64))])
        packed = np.zeros(n * low // 64 + 2, np.uint64)
        if low and n:
            own, at = v & _u((1 << low) - 1), np.arange(n, dtype=np.int64) * low
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            head = np.flatnonzero(np.diff(word, prepend=-1))
            packed[word[head]] += np.add.reduceat(own << shift, head)
            over = np.flatnonzero(shift + _u(low) > 64)  # one value a word at most runs over its end
            packed[word[over] + 1] += own[over] >> (_u(64) - shift[over])
        return {"head": np.array([n, low], np.int64), "high": high, "ones": ones, "low": packed}

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        # A shift by 64 would be undefined; by 63 and 1 it is not.
        return (self.low[word] >> shift | (self.low[word + 1] << (_u(63) - shift)) << _u(1)) & _u((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (select(self.high, self.ones, i) - i << self.low_bits) | self.lows(i).astype(np.int64)

    def find(self, v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Places of the values v within [lo, hi), or -1."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        h = v >> self.low_bits
        # Values with the high part h stand between two zeros of the unary code.
        end = np.minimum(hi, select(~self.high, zeros, h) - h)
        at = np.maximum(lo, np.where(h > 0, select(~self.high, zeros, np.maximum(h - 1, 0)) - h + 1, 0))
        want = v.astype(np.uint64) & _u((1 << self.low_bits) - 1)
        out = np.full(len(v), -1, np.int64)
        live = np.flatnonzero(at < end)
        lo, hi, want = at[live], end[live], want[live]
        while len(live):  # their low bits rise: by halves
            mid = (lo + hi) >> 1
            own = self.lows(mid)
            hit = own == want
            out[live[hit]] = mid[hit]
            below = own < want
            lo, hi = np.where(below, mid + 1, lo), np.where(below, hi, mid)
            go = (lo < hi) & ~hit
            live, lo, hi, want = live[go], lo[go], hi[go], want[go]
        return out


class Trie:
    """Levels in one memory map. Level 1 has an entry for every word; level k has sorted (context
    entry of level k - 1, word) pairs."""

    def __init__(self, words: int, levels: list[tuple[np.ndarray, np.ndarray]], probs: list[np.ndarray], weights: list[np.ndarray]):
        """levels[k]: context entries and words of level k + 2, sorted; probs: log10 p of every
        entry of every level; weights: log10 back-off weight of every level but the last."""
        self.words = words
        parts: list[tuple[tuple, np.ndarray]] = []
        quant = lambda x: np.minimum(65535, np.rint(-x * _STEP)).astype(np.uint16)
        for k, p in enumerate(probs):
            parts.append(((k, "p"), quant(p)))
        for k, w in enumerate(weights):
            parts.append(((k, "w"), quant(w)))
        size = words
        for k, (ctx, word) in enumerate(levels):
            pointers = np.searchsorted(ctx, np.arange(size + 1))
            for name, ef in (("ptr", EliasFano.build(pointers, len(ctx) + 1)), ("suc", EliasFano.build(ctx.astype(np.int64) * words + word, size * words + 1))):
                parts += [((k, name, f), a) for f, a in ef.items()]
            size = len(ctx)
        self.map = mmap.mmap(-1, max(8, sum(-(-a.nbytes // 8) * 8 for _, a in parts)))
        self.at, pos = {}, 0
        for key, a in parts:
            self.map[pos : pos + a.nbytes] = a.tobytes()
            self.at[key] = (pos, a.dtype, len(a))
            pos += -(-a.nbytes // 8) * 8

    def part(self, *key) -> np.ndarray:
        pos, dtype, n = self.at[key]
        return np.frombuffer(self.map, dtype, n, pos)

    def value(self, level: int, kind: str, entry: np.ndarray) -> np.ndarray:
        return self.part(level, kind)[entry].astype(np.float64) / -_STEP

    def sequence(self, k: int, name: str) -> EliasFano:
        return EliasFano({f: self.part(k, name, f) for f in ("head", "high", "ones", "low")})

    def successors(self, k: int, ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Entry of level k + 2 for each (context entry, word), or -1; context -1 has none."""
        pointers, suc = self.sequence(k, "ptr"), self.sequence(k, "suc")
        out = np.full(len(ctx), -1, np.int64)
        ok = np.flatnonzero(ctx >= 0)
        ok = ok[np.argsort(ctx[ok] * self.words + word[ok])]  # neighbours lie in the same cache lines
        lo, hi = pointers.get(ctx[ok]), pointers.get(ctx[ok] + 1)
        some = hi > lo
        ok, lo, hi = ok[some], lo[some], hi[some]
        out[ok] = suc.find(ctx[ok] * self.words + word[ok], lo, hi)
        return out


# ---- counting --------------------------------------------------------------------------------


def chunks(df: DataFrame, id_col: str, text_col: str, held_col: str) -> DataFrame:
    """Rows of documents as words: a row per chunk."""
    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(held_col), F.lit(False)).alias("held"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        ids: list = []
        helds: list = []
        sizes: list = []
        hashes: list = []
        got = 0

        def out() -> pa.RecordBatch:
            n = np.concatenate(sizes)
            vocab, place = np.unique(np.concatenate(hashes), return_inverse=True)
            row = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) | nth]), row(pa.concat_arrays(ids)), row(pa.concat_arrays(helds)), lists(n.astype(np.int64), np.array([0, len(n)])), pa.array([deltas(vocab)]), pa.array([squeeze(place.astype(np.uint32))])], names=["chunk", "ids", "held", "sizes", "vocab", "tokens"])

        for b in batches:
            doc, held = b.column("doc_id"), b.column("held")
            for a, z, data, offs in blocks(b.column("text"), 1 << 20):
                w = Words(data, offs)
                n = np.diff(w.first) + 1
                h = np.full(n.sum(), END, np.uint64)
                keep = np.ones(len(h), bool)
                keep[np.cumsum(n) - 1] = False
                h[keep] = w.hash
                ids.append(doc[a:z]), helds.append(held[a:z]), sizes.append(n), hashes.append(h)
                got += len(data) + 8 * len(n)
                if got >= CHUNK:
                    yield out()
                    nth += 1
                    ids, helds, sizes, hashes, got = [], [], [], [], 0
        if ids:
            yield out()

    return source.mapInArrow(tidy(run), "chunk long, ids array<long>, held array<boolean>, sizes array<long>, vocab binary, tokens binary")


class Tokens:
    """The tokens of a chunk and the keys of the n-grams that end at each."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        self.vocab = undelta(row["vocab"])
        self.word = expand(row["tokens"], np.uint32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.trained = np.repeat(~self.held, self.sizes)
        self.pos = np.arange(len(self.word)) - np.repeat(self.first[:-1], self.sizes)

    def keys(self, order: int) -> np.ndarray:
        """Key of the n-gram of this order that ends at each token; before a document's first word
        stands one end token. Only where pos >= order - 2 is there an n-gram of so many."""
        h = self.vocab[self.word]
        out = h
        for k in range(2, order + 1):
            ctx = np.concatenate([[END], out[:-1]])
            if k == 2:
                ctx[self.first[:-1]] = END
            out = mix(ctx * _u(0x9E3779B97F4A7C15) + h * _u(0xC2B2AE3D27D4EB4F) + _u(k))
        return out

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of this order, and each token's place among them, or -1."""
        if order == 1:
            return self.vocab, self.word
        here = self.pos >= order - 2
        uniq, inv = np.unique(self.keys(order)[here], return_inverse=True)
        place = np.full(len(self.word), -1, np.int64)
        place[here] = inv
        return uniq, place


def asks(chunked: DataFrame, shards: int, order: int) -> DataFrame:
    """What every chunk sends to every shard: sorted keys of n-grams of this order, training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = ((1 << 64) - 1) // shards + 1
        edges = np.array([i * step for i in range(1, shards)], np.uint64)
        for b in batches:
            for row in b.to_pylist():
                t = Tokens(row)
                keys, place = t.grams(order)
                counts = np.bincount(place[t.trained & (place >= 0)], minlength=len(keys))
                at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                part = [(i, lo, hi) for i, (lo, hi) in enumerate(zip(at, at[1:], strict=False)) if hi > lo]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in part], pa.int32()), pa.array([row["chunk"]] * len(part), pa.int64()), pa.array([deltas(keys[lo:hi]) for _, lo, hi in part], pa.binary()), pa.array([squeeze(counts[lo:hi].astype(np.uint32)) for _, lo, hi in part], pa.binary())], names=["shard", "chunk", "keys", "counts"])

    return chunked.select("chunk", "ids", "held", "sizes", "vocab", "tokens").mapInArrow(tidy(run), "shard int, chunk long, keys binary, counts binary")


def answers(asked: DataFrame, order: int) -> DataFrame:
    """Totals over all chunks, in the order of each chunk's keys; distinct and tokens: training
    n-grams of the shard, on one row of it."""

    def run(t: pa.Table) -> pa.Table:
        keys = [undelta(x) for x in t.column("keys").to_pylist()]
        counts = [expand(x, np.uint32) for x in t.column("counts").to_pylist()]
        uniq, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inv, np.concatenate(counts), len(uniq)).astype(np.int64)  # exact below 2^53
        at = np.cumsum([0, *map(len, keys)])
        back = [squeeze(total[inv[a:z]].astype(np.uint64)) for a, z in zip(at, at[1:], strict=False)]
        lead = [int((total > 0).sum())] + [0] * (len(keys) - 1)
        return pa.table({"level": pa.array([order] * len(keys), pa.int32()), "shard": t.column("shard"), "chunk": t.column("chunk"), "totals": pa.array(back, pa.binary()), "distinct_n": pa.array(lead, pa.int64()), "tokens_n": pa.array([int(total.sum())] + [0] * (len(keys) - 1), pa.int64())})

    return asked.groupBy("shard").applyInArrow(run, "level int, shard int, chunk long, totals binary, distinct_n long, tokens_n long")


def scores(t: Tokens, total: list[np.ndarray], N: int, V: int, mu: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 base and model probability of every token; total: training counts of the chunk's
    distinct n-grams of each order."""
    order = len(total)
    p1 = (total[0] + 1) / (N + V + 1)
    end = int(np.searchsorted(t.vocab, END))
    # Of every order: places of the tokens' n-grams, a token that ends each n-gram, its context's
    # place one order down, counts, probabilities.
    place, some = [t.word], [np.zeros(0, np.int64)]
    context, full = [np.zeros(0, np.int64)], [p1]
    entry, probs, weights, levels = [np.arange(len(p1))], [np.log10(p1)], [], []
    before = np.concatenate([[end], t.word[:-1]])
    before[t.first[:-1]] = end
    order_of = np.arange(len(p1))
    for k in range(1, order):
        at = t.grams(k + 1)[1]
        one = np.zeros(len(total[k]), np.int64)
        here = np.flatnonzero(at >= 0)
        one[at[here]] = here
        if k > 1:
            before = np.concatenate([[-1], place[-1][:-1]])
        ctx_place, c = before[one], total[k]
        n_ctx = total[k - 1][ctx_place]
        full.append((c + mu * full[-1][place[-1][one]]) / (n_ctx + mu))
        # Entries of the level: what training has seen.
        seen = np.flatnonzero(c > 0)
        ctx, word = entry[-1][ctx_place[seen]], t.word[one[seen]]
        sort = np.argsort(ctx * len(p1) + word)
        seen = seen[sort]
        levels.append((ctx[sort], word[sort]))
        probs.append(np.log10(full[-1][seen]))
        weights.append(np.log10(mu / (total[k - 1][order_of] + mu)))
        e = np.full(len(c), -1, np.int64)
        e[seen] = np.arange(len(seen))
        entry.append(e)
        place.append(at), some.append(one), context.append(ctx_place)
        order_of = seen
    trie = Trie(len(p1), levels, probs, weights)
    # From here on only the trie tells: each distinct n-gram is looked up once, below its context's entry.
    found, lp = np.arange(len(p1)), trie.value(0, "p", np.arange(len(p1)))
    by_token = lp[t.word]
    for k in range(1, order):
        ctx = found[context[k]]
        hit = trie.successors(k - 1, ctx, t.word[some[k]])
        weight = np.zeros(len(ctx))
        known = ctx >= 0
        weight[known] = trie.value(k - 1, "w", ctx[known])
        lp = lp[place[k - 1][some[k]]] + weight
        lp[hit >= 0] = trie.value(k, "p", hit[hit >= 0])
        found = hit
        here = place[k] >= 0
        by_token[here] = lp[place[k][here]]
    return np.log10(p1)[t.word], by_token


def score(df: DataFrame, held_col: str, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, mu: float = MU) -> DataFrame:
    """Scores of all rows under the model of the rows where held_col is false."""
    chunked = durable(chunks(df, id_col, text_col, held_col), "lm-chunks")
    tokens = chunked.agg(F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    shards = max(1, -(-int(tokens) // SHARD))
    told = [durable(answers(asks(chunked, shards, k), k), f"lm-totals-{k}") for k in range(1, order + 1)]
    size = told[0].agg(F.coalesce(F.sum("tokens_n"), F.lit(0)), F.coalesce(F.sum("distinct_n"), F.lit(0))).first()
    N, V = int(size[0]), int(size[1])

    def run(mine: pa.Table, got: pa.Table) -> pa.Table:
        row = mine.to_pylist()[0]
        t = Tokens(row)
        by: dict[int, list] = {}
        for level, shard, totals in zip(*(got.column(c).to_pylist() for c in ("level", "shard", "totals")), strict=True):
            by.setdefault(level, []).append((shard, totals))
        total = [np.concatenate([np.zeros(0, np.uint64), *(expand(x, np.uint64) for _, x in sorted(by.get(k, [])))]).astype(np.int64) for k in range(1, order + 1)]
        base, lp = scores(t, total, N, V, mu)
        cut = t.first[:-1]
        return pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(t.held), "n_tokens": pa.array(t.sizes), "n_known": pa.array(np.add.reduceat((total[0] > 0)[t.word].astype(np.int64), cut)), "train_tokens": pa.array(np.full(len(cut), N, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, cut)), "score": pa.array(np.add.reduceat(lp, cut)),
        })

    every = reduce(DataFrame.unionByName, told).select("level", "shard", "chunk", "totals")
    return chunked.groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
