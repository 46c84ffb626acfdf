"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded labelled sample is built. A text is cut
greedily into phrases, each the longest string from where it begins that occurs in the sample. A
phrase of a sample of m symbols costs log2(m) bits, its place there; the language with the fewest
bits (phrases normalised by sample) wins.

The parse runs over whole texts. To go on side by side, spans of SPAN symbols are first parsed from
their beginnings, then those that the parse of the span before enters elsewhere are parsed anew from
there, until the phrase starts of both agree; what results is the parse from the text's beginning.

Symbols are folded characters: lower case, every run of non-letters one blank.

Defined results: null, empty or letterless text gives `und` with score 0; equal costs give the
alphabetically first language; with no labelled rows every text is `und`. score is
1 - fewest / second fewest bits (1 where only one language is known).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import blocks, labelled_sample, tidy, unused

#: Sample per language: rows, and characters in all, shared among the rows (a window of each).
SAMPLE_ROWS, SAMPLE_CHARS = 60, 42_000
SPAN = 512


def fold_table(limit: int = 0x3000) -> np.ndarray:
    """Code point -> folded code point: lower case for letters, 32 otherwise; larger code points
    are folded one by one."""
    t = np.full(limit, 32, np.uint32)
    for c in range(limit):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            t[c] = ord(low) if len(low) == 1 else c
    return t


_FOLD = fold_table()


def folded(codes: np.ndarray) -> np.ndarray:
    out = np.full(len(codes), 32, np.uint32)
    small = codes < len(_FOLD)
    out[small] = _FOLD[codes[small]]
    far, inv = np.unique(codes[~small], return_inverse=True)
    out[~small] = np.array([c if chr(c).isalpha() else 32 for c in far.tolist()], np.uint32)[inv] if len(far) else 32
    return out


def symbols(codes: np.ndarray) -> np.ndarray:
    """Folded code points with runs of blanks made one."""
    f = folded(codes)
    keep = np.ones(len(f), bool)
    keep[1:] = (f[1:] != 32) | (f[:-1] != 32)
    return f[keep]


class Automaton:
    """Suffix automaton of an array of small ints. A state is a number s of its own and goes over c
    to to[s + c] if owner[s + c] is s: edges of all states share one array and take room for the
    edges there are, whatever the number of symbols. first[c] is where the root goes, or for a
    symbol that the sample lacks, which is a phrase of its own, a state without edges."""

    def __init__(self, text: np.ndarray, width: int):
        nxt: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text.tolist():
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        room = 2 * sum(map(len, nxt)) + 4 * width + 64
        used, begin, taken, base = bytearray(room), {}, set(), [-1] * len(nxt)
        for s in sorted(range(len(nxt)), key=lambda s: -len(nxt[s])):
            if not nxt[s]:
                continue
            symbols_ = sorted(nxt[s])
            # States of one size go on where the last of them found room.
            at = used.find(0, max(begin.get(len(symbols_), 0), symbols_[0]))
            while True:
                if at < 0 or at + width >= len(used):
                    used.extend(bytes(len(used)))
                    at = used.find(0, max(at, symbols_[0]))
                b = at - symbols_[0]
                if b not in taken and not any(used[b + c] for c in symbols_):
                    break
                at = used.find(0, at + 1)
            begin[len(symbols_)] = at
            taken.add(b)
            base[s] = b
            for c in symbols_:
                used[b + c] = 1
        dead = max(len(used.rstrip(b"\0")), max(taken, default=0) + 1)
        self.to, self.owner = np.zeros(dead + width, np.int32), np.full(dead + width, -1, np.int32)
        for s, own in enumerate(nxt):
            for c, t in own.items():
                self.owner[base[s] + c] = base[s]
                self.to[base[s] + c] = base[t] if base[t] >= 0 else dead
        self.first = np.full(width, dead, np.int32)
        for c in nxt[0]:
            self.first[c] = self.to[base[0] + c]

    def spans(self, flat: np.ndarray, begin: np.ndarray, stop: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parse each span from its beginning: phrases begun in it, and the first phrase start at or
        after its stop. Marks the phrase starts."""
        order = np.argsort(begin - stop, kind="stable")  # longest first
        begin, stop = begin[order], stop[order]
        size = stop - begin
        idx = begin[None, :] + np.arange(int(size[0]))[:, None]
        sym = flat[np.minimum(idx, len(flat) - 1)]
        starts = np.zeros(sym.shape, bool)
        starts[0] = True
        state = self.first[sym[0]]
        live = np.searchsorted(-size, -np.arange(len(sym)), "left")  # spans still going at each step
        for t in range(1, len(sym)):
            m = live[t]
            s, c = state[:m], sym[t, :m]
            edge = s + c
            ok = self.owner[edge] == s
            np.logical_not(ok, out=starts[t, :m])
            state[:m] = np.where(ok, self.to[edge], self.first[c])
        mark[idx[starts]] = True
        # The last phrase goes on beyond the span.
        lane, at, ended = np.arange(len(begin)), stop.copy(), stop.copy()
        while len(lane):
            edge = state + flat[at]
            ok = self.owner[edge] == state
            ended[lane[~ok]] = at[~ok]
            lane, at, state = lane[ok], at[ok] + 1, self.to[edge[ok]]
        n, end = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        n[order], end[order] = starts.sum(0), ended
        return n, end

    def rejoin(self, flat: np.ndarray, begin: np.ndarray, stop: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parse from begin to a marked phrase start, or to the first one at or after the stop:
        phrases begun on the way, and where it ended."""
        n, ended = np.ones(len(begin), np.int64), np.zeros(len(begin), np.int64)
        lane, at, state = np.arange(len(begin)), begin + 1, self.first[flat[begin]]
        while len(lane):
            c = flat[at]
            edge = state + c
            ok = self.owner[edge] == state
            done = ~ok & ((at >= stop) | mark[at])
            n[lane[~ok & ~done]] += 1
            state = np.where(ok, self.to[edge], self.first[c])
            if done.any():
                ended[lane[done]] = at[done]
                go = ~done
                lane, at, state, stop = lane[go], at[go], state[go], stop[go]
            at = at + 1
        return n, ended

    def phrases(self, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each text flat[first : first + size]; a symbol without any edge follows each."""
        spans = -(-size // SPAN)
        owner = np.repeat(np.arange(len(size)), spans)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
        begin = first[owner] + nth * SPAN
        stop = np.minimum(begin + SPAN, (first + size)[owner])
        if not len(begin):
            return np.zeros(len(size), np.int64)
        mark = np.zeros(len(flat), bool)
        own_n, own_end = self.spans(flat, begin, stop, mark)
        upto = np.concatenate([[0], np.cumsum(mark)])
        enter, n, end = begin.copy(), own_n.copy(), own_end.copy()
        while True:
            want = begin.copy()
            want[1:] = np.where(nth[1:] > 0, end[:-1], begin[1:])
            some = np.flatnonzero(want != enter)
            if not len(some):
                return np.bincount(owner, n, len(size)).astype(np.int64)
            enter[some] = want[some]
            past = want[some] >= stop[some]
            n[some[past]], end[some[past]] = 0, want[some[past]]
            some = some[~past]
            got, at = np.zeros(len(some), np.int64), want[some].copy()
            new = np.flatnonzero(~mark[at])
            if len(new):
                got[new], at[new] = self.rejoin(flat, at[new], stop[some[new]], mark)
            joined = at < stop[some]
            n[some] = got + np.where(joined, upto[stop[some]] - upto[np.minimum(at, stop[some])], 0)
            end[some] = np.where(joined, own_end[some], at)


class Parser:
    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        folds = {k: symbols(np.frombuffer(v.encode("utf-32-le", "replace"), np.uint32)) for k, v in samples.items()}
        known = np.unique(np.concatenate([np.zeros(0, np.uint32), *folds.values()]))
        self.known = np.union1d(known, np.array([32], np.uint32))
        # Two symbols more: letters of no sample, and the end of a text.
        self.other, self.end = len(self.known), len(self.known) + 1
        self.low = np.full(len(_FOLD), self.other, np.int32)
        self.low[self.known[self.known < len(_FOLD)]] = np.flatnonzero(self.known < len(_FOLD))
        self.automata = [Automaton(self.index(folds[k]), self.end + 1) for k in self.names]
        self.bits = np.array([np.log2(max(2, len(folds[k]))) for k in self.names])

    def index(self, f: np.ndarray) -> np.ndarray:
        out = np.full(len(f), self.other, np.int32)
        small = f < len(self.low)
        out[small] = self.low[f[small]]
        far = np.flatnonzero(~small)
        if len(far):
            j = np.minimum(np.searchsorted(self.known, f[far]), len(self.known) - 1)
            out[far] = np.where(self.known[j] == f[far], j, self.other)
        return out

    def count(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each symbol array for each language."""
        size = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(size + 1) - size - 1
        flat = np.full(int(size.sum()) + len(size), self.end, np.int32)
        for at, t in zip(first.tolist(), texts, strict=True):
            flat[at : at + len(t)] = t
        return np.stack([a.phrases(flat, first, size) for a in self.automata], 1) if self.names else np.zeros((len(texts), 0), np.int64)


def samples(df: DataFrame, text_col: str, lang_col: str, id_col: str) -> dict[str, str]:
    """A bounded sample per language: SAMPLE_ROWS rows by hash of the id, SAMPLE_CHARS characters,
    shared among the rows there are; of a longer text a window."""
    known = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = labelled_sample(known, "lang", "id", SAMPLE_ROWS)
    share = F.floor(F.lit(SAMPLE_CHARS) / F.count("*").over(Window.partitionBy("lang"))).cast("int")
    begin = F.greatest(F.lit(1), F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.length("text") - F.col("share"))).cast("int"))
    out: dict[str, list[str]] = {}
    for r in rows.withColumn("share", share).select("id", "lang", F.substring(F.col("text"), begin, F.col("share")).alias("text")).orderBy("lang", F.xxhash64("id"), "id").collect():
        out.setdefault(r["lang"], []).append(r["text"])
    return {k: " ".join(dict.fromkeys(v)) for k, v in out.items()}


def identify(df: DataFrame, found: dict[str, str], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """id, the columns in keep, and under the names in out the language and the score of every row;
    found: a sample text per language."""
    shared = df.sparkSession.sparkContext.broadcast(Parser(found))
    body = unused("_text", (id_col, *keep))
    source = df.select(*dict.fromkeys([id_col, *keep]), F.col(text_col).alias(body))
    kept = source.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        names = np.array([*p.names, "und"], dtype=object)
        for b in batches:
            best, score = [], []
            for _, _, data, offs in blocks(b.column(body), 2 << 20):
                codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                f = folded(codes)
                # Row bounds in characters: bytes that begin one, counted up to each offset.
                heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                row = np.repeat(np.arange(len(offs) - 1), np.diff(heads[offs]))
                keep_ = np.ones(len(f), bool)
                keep_[1:] = (f[1:] != 32) | (f[:-1] != 32) | (row[1:] != row[:-1])
                letters = np.bincount(row[f != 32], minlength=len(offs) - 1)
                f, row = p.index(f[keep_]), row[keep_]
                bound = np.searchsorted(row, np.arange(len(offs)))
                counts = p.count([f[bound[i] : bound[i + 1]] for i in range(len(offs) - 1)])
                if not len(p.names):
                    best.append(np.zeros(len(letters), np.int64))
                    score.append(np.zeros(len(letters)))
                    continue
                cost = counts * p.bits
                pick = cost.argmin(1)
                ranked = np.sort(cost, 1)
                margin = 1 - ranked[:, 0] / np.maximum(1, ranked[:, 1]) if counts.shape[1] > 1 else np.ones(len(pick))
                best.append(np.where(letters > 0, pick, len(p.names)))
                score.append(np.where(letters > 0, margin, 0.0))
            n = len(p.names)
            i = np.concatenate(best) if best else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(names[np.minimum(i, n)].tolist(), pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))], names=[*kept, *out])

    schema = StructType([*(source.schema[c] for c in kept), StructField(out[0], StringType()), StructField(out[1], DoubleType())])
    return source.mapInArrow(tidy(run), schema)
