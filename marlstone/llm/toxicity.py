"""Toxicity by a bidirectional gated recurrent network with attention pooling.

The inputs of a step are a word: an embedding of the whole word and the sum of the embeddings of
all its character n-grams over the root of their number (of GRAMS bytes; bounded hash tables), without marks at its ends. Two GRUs
run over a window of WINDOW words, one in each direction; attention pools their states; a logistic
unit scores the window. Windows overlap by half: one begins every STRIDE words, so any passage of up
to WINDOW - STRIDE + 1 words lies whole in one; a document's score is that of its worst window. Trained in numpy from document labels only: naive Bayes log odds of the sample's words
propose each document's windows, and in later epochs the network's own worst window is the one
that carries the label. A fifth of the sample trains no weight; on it the worst window's logit is
scaled to a probability.

Defined results: null, empty or blank text scores 0; without labelled rows, or with one label
only, every score is the share of label 1 (0 without labels). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import _LOWER, Words, blocks, labelled_sample, mix, text_bytes, tidy, unused

WINDOW, STRIDE = 24, 12
WORD_SLOTS, CHAR_SLOTS, DIM, HIDDEN = 1 << 14, 1 << 14, 12, 8
GRAMS = (3, 4, 5)
#: Documents per label that train, with their whole texts.
SAMPLE = 1500


class Spelled:
    """The words of texts as places among the distinct ones; of each of these the slot of the whole
    word and those of its character n-grams (a flat array and bounds; slot 0 where a word has none).
    A-Z are lower-cased; slot 0 stands for none."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        w = Words(data, offs)
        # Up to three marks at either end of a word become blanks.
        word_byte = (data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122) | ((data >= 48) & (data <= 57))
        start, end, bare = w.start.copy(), w.end.copy(), data.copy()
        for _ in range(3):
            cut = (end - start > 1) & ~word_byte[end - 1]
            bare[end[cut] - 1] = 32
            end = end - cut
            cut = (end - start > 1) & ~word_byte[np.minimum(start, max(0, len(data) - 1))]
            bare[start[cut]] = 32
            start = start + cut
        w = Words(bare, offs)
        self.first = w.first
        keys, one, self.word = np.unique(w.hash, return_index=True, return_inverse=True)
        self.whole = (keys % np.uint64(WORD_SLOTS - 1)).astype(np.int64) + 1
        start, size = w.start[one], (w.end - w.start)[one]
        low = np.concatenate([_LOWER[bare].astype(np.uint64), np.zeros(8, np.uint64)])
        many = sum(np.maximum(0, size - n + 1) for n in GRAMS) if len(one) else np.zeros(0, np.int64)
        self.bound = np.concatenate([[0], np.cumsum(np.maximum(1, many))])
        self.slot = np.zeros(self.bound[-1], np.int64)
        done = self.bound[:-1].copy()
        for n in GRAMS:
            own = np.maximum(0, size - n + 1)
            at = np.repeat(start, own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            h = np.full(len(at), n, np.uint64)
            for i in range(n):
                h = (h * np.uint64(1099511628211)) ^ low[at + i]
            to = np.repeat(done, own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            self.slot[to] = (mix(h) % np.uint64(CHAR_SLOTS - 1)).astype(np.int64) + 1
            done += own


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of every window."""
    n = np.diff(first)
    many = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), many)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    at = first[row] + nth * STRIDE
    return row, at, np.minimum(WINDOW, first[row + 1] - at)


def _sig(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def grams_of(words: Spelled, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram slots of some of the distinct words, where each word's begin, and how many it has."""
    many = np.diff(words.bound)[some]
    at = np.cumsum(many) - many
    return words.slot[np.repeat(words.bound[some] - at, many) + np.arange(many.sum())], at, many


class BiGRU:
    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        s = lambda *d, k=None: (r.standard_normal(d) / np.sqrt(k or d[0])).astype(np.float32)
        # Small at first: a word or n-gram the sample doesn't have says next to nothing.
        self.p = {"E": 0.1 * s(WORD_SLOTS, DIM, k=DIM), "C": 0.1 * s(CHAR_SLOTS, DIM, k=DIM), "w": s(2 * HIDDEN), "q": s(2 * HIDDEN), "d": np.zeros(1, np.float32)}
        for k in "fb":
            self.p |= {f"X{k}": s(DIM, 3 * HIDDEN), f"U{k}": s(HIDDEN, 3 * HIDDEN), f"g{k}": np.zeros(3 * HIDDEN, np.float32)}
        self.p["E"][0] = self.p["C"][0] = 0
        self.constant: float | None = None
        self.slope, self.shift = 1.0, 0.0  # of a document's score, see calibrate()

    def inputs(self, words: Spelled, some: np.ndarray | None = None) -> np.ndarray:
        """Inputs of the distinct words, or of some of them."""
        if some is None:
            slot, at, many = words.slot, words.bound[:-1], np.diff(words.bound)
        else:
            slot, at, many = grams_of(words, some)
        chars = np.add.reduceat(self.p["C"][slot], at) / np.sqrt(many)[:, None] if len(at) else np.zeros((0, DIM), np.float32)
        return (self.p["E"][words.whole if some is None else words.whole[some]] + chars).astype(np.float32)

    def run(self, gates: np.ndarray, live: np.ndarray, d: str, states: np.ndarray, tape: list | None = None) -> None:
        """One direction over time-major gate inputs (steps, windows, 3 HIDDEN); live: whether the
        step is inside the window. Fills states (steps, windows, HIDDEN)."""
        H, U = HIDDEN, self.p[f"U{d}"]
        h = np.zeros(gates.shape[1:2] + (H,), np.float32)
        for t in range(len(gates)) if d == "f" else range(len(gates) - 1, -1, -1):
            hu = h @ U
            zr = _sig(gates[t, :, : 2 * H] + hu[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(gates[t, :, 2 * H :] + r * hu[:, 2 * H :])
            new = n + z * (h - n)
            new = np.where(live[t][:, None], new, h)
            if tape is not None:
                tape.append((t, h, hu[:, 2 * H :], z, r, n))
            states[t] = h = new

    def forward(self, x: np.ndarray, at: np.ndarray, size: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Scores of windows over word inputs x, already projected where x is a pair."""
        steps = np.arange(WINDOW)[:, None]
        live = steps < size[None, :]
        idx = np.where(live, at[None, :] + steps, at[None, :])
        S = np.empty((WINDOW, len(at), 2 * HIDDEN), np.float32)
        tapes = {"f": [], "b": []}
        for d, part in (("f", S[:, :, :HIDDEN]), ("b", S[:, :, HIDDEN:])):
            gates = (x[d] if isinstance(x, dict) else x @ self.p[f"X{d}"] + self.p[f"g{d}"])[idx]
            self.run(gates, live, d, part, tapes[d] if tape is not None else None)
        e = np.where(live, np.clip(S @ self.p["q"], -15, 15), -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tn,tnh->nh", a, S)
        y = _sig(pooled @ self.p["w"] + self.p["d"][0])
        if tape is not None:
            tape |= {"S": S, "a": a, "pooled": pooled, "live": live, "idx": idx, "t": tapes}
        return y

    def gradients(self, x: np.ndarray, g: np.ndarray, tape: dict) -> tuple[dict, np.ndarray]:
        """Gradients of the weights but for the tables, and of the word inputs."""
        p, H = self.p, HIDDEN
        S, a, live, idx = tape["S"], tape["a"], tape["live"], tape["idx"]
        out = {"w": tape["pooled"].T @ g, "d": np.array([g.sum()])}
        gp = g[:, None] * p["w"]
        gS = a[:, :, None] * gp[None]
        ga = np.einsum("tnh,nh->tn", S, gp)
        ge = a * (ga - (a * ga).sum(0))
        out["q"] = np.einsum("tn,tnh->h", ge, S)
        gS = gS + ge[:, :, None] * p["q"]
        gx = np.zeros_like(x)
        for d, part in (("f", gS[:, :, :H]), ("b", gS[:, :, H:])):
            U = p[f"U{d}"]
            gU, gG = np.zeros_like(U), np.zeros((WINDOW, g.shape[0], 3 * H), np.float32)
            gh = np.zeros((g.shape[0], H), np.float32)
            for t, h, hn, z, r, n in reversed(tape["t"][d]):
                m = live[t][:, None]
                gh = gh + part[t]
                gn = np.where(m, gh * (1 - z) * (1 - n * n), 0)
                gz = np.where(m, gh * (h - n) * z * (1 - z), 0)
                gr = gn * hn * r * (1 - r)
                G = np.concatenate([gz, gr, gn], 1)
                gG[t] = G
                via = np.concatenate([gz, gr, gn * r], 1)
                gU += h.T @ via
                gh = np.where(m, gh * z, gh) + via @ U.T
            out[f"U{d}"], out[f"g{d}"] = gU, gG.sum((0, 1))
            flat = gG.reshape(-1, 3 * H)
            out[f"X{d}"] = x[idx].reshape(-1, DIM).T @ flat
            np.add.at(gx, idx.ravel(), flat @ p[f"X{d}"].T)
        return out, gx

    def fit(self, words: Spelled, docs: np.ndarray, t: np.ndarray, epochs: int = 12, batch: int = 48, rate: float = 0.01, per_doc: int = 4, drop: float = 0.4) -> BiGRU:
        """words: the words of all texts; docs: which of the texts train, t: their labels."""
        some = np.diff(words.first)[docs] > 0
        t, docs = t[some], docs[some]
        if not len(t) or t.min() == t.max():
            self.constant = float(t.mean()) if len(t) else 0.0
            return self
        keys = [words.word[words.first[i] : words.first[i + 1]] for i in docs]
        # Naive Bayes log odds of words and of n-grams, by documents.
        hot = []
        for slots, of in ((WORD_SLOTS, lambda k: words.whole[k]), (CHAR_SLOTS, lambda k: grams_of(words, k)[0])):
            df = np.zeros((2, slots))
            for k, y in zip(keys, t, strict=True):
                df[int(y), np.unique(of(np.unique(k)))] += 1
            share = (df + 0.5) / (np.array([[np.sum(t == 0)], [np.sum(t == 1)]]) + 1)
            hot.append(np.maximum(0, np.log(share[1] / share[0]) * (df.sum(0) >= 3) - 1))
        worth_of = hot[0][words.whole] + 0.5 * np.maximum.reduceat(hot[1][words.slot], words.bound[:-1])
        # Words and n-grams that speak for the label begin along one direction, so that few documents suffice.
        line = np.random.default_rng(3).standard_normal(DIM).astype(np.float32)
        line /= np.sqrt((line * line).sum())
        for name, odds in zip("EC", hot, strict=True):
            self.p[name] += np.minimum(odds, 3)[:, None].astype(np.float32) * line
            self.p[name][0] = 0
        chosen = []
        r = np.random.default_rng(1)
        for k in keys:
            row, at, size = windows(np.array([0, len(k)]))
            worth = np.concatenate([[0], np.cumsum(worth_of[k])])
            worth = worth[at + size] - worth[at]
            top = np.argsort(-worth, kind="stable")[: per_doc - 1]
            top = np.unique(np.append(top, r.integers(len(at))))
            chosen.append((at[top], size[top], worth[top]))
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean())).astype(np.float32)
        for epoch in range(epochs):
            if epoch >= 3 and epoch % 3 == 0:  # each document's worst windows as the network has them now
                for j, (y, at, size) in enumerate(self.each(words, docs)):
                    top = np.unique(np.append(np.argsort(-y, kind="stable")[: per_doc - 1], r.integers(len(at))))
                    chosen[j] = (at[top], size[top], y[top])
            order = r.permutation(len(t))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                # Only the words of the windows chosen take part.
                size = np.concatenate([chosen[j][1] for j in pick])
                of = np.repeat(np.arange(len(pick)), [len(chosen[j][0]) for j in pick])
                begin = np.concatenate([chosen[j][0] + words.first[docs[j]] for j in pick])
                at = np.cumsum(size) - size
                tokens = words.word[np.repeat(begin - at, size) + np.arange(size.sum())]
                uniq, inv = np.unique(tokens, return_inverse=True)
                seen = (r.random(len(inv)) >= drop).astype(np.float32)[:, None]  # no word is to be relied on alone
                x = self.inputs(words, uniq)[inv] * seen
                tape: dict = {}
                y = self.forward(x, at, size, tape)
                # The window that carries the label of its document: the proposed one, later the worst.
                by = y if epoch >= 3 else np.concatenate([chosen[j][2] for j in pick])
                lead = np.lexsort((-by, of))[np.searchsorted(of, np.arange(len(pick)))]
                g = np.zeros(len(y), np.float32)
                clean = t[pick][of] == 0
                g[clean] = y[clean] * weight[pick][of][clean] / np.bincount(of)[of][clean]
                bad = lead[t[pick] == 1]
                g[bad] = (y[bad] - 1) * weight[pick][of[bad]]
                grads, gx = self.gradients(x, g / len(pick), tape)
                step += 1
                gu = np.zeros((len(uniq), DIM), np.float32)
                np.add.at(gu, inv, gx * seen)
                slot, _, many = grams_of(words, uniq)
                for name, slots, each in (("E", words.whole[uniq], gu), ("C", slot, np.repeat(gu / np.sqrt(many)[:, None], many, axis=0))):
                    rows, back = np.unique(slots, return_inverse=True)
                    gr = np.zeros((len(rows), DIM), np.float32)
                    np.add.at(gr, back, each)
                    b = m[name][1]
                    b[rows] += 0.01 * (gr * gr - b[rows]) + 1e-12
                    go = rate * np.clip(gr / (np.sqrt(b[rows]) + 1e-7), -3, 3) * 0.3
                    go[rows == 0] = 0
                    self.p[name][rows] -= go
                for name, gr in grads.items():
                    a, b = m[name]
                    a += 0.1 * (gr - a)
                    b += 0.001 * (gr * gr - b)
                    self.p[name] = (self.p[name] - rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def projected(self, words: Spelled) -> dict[str, np.ndarray]:
        """Gate inputs of every word, by direction; made once for each distinct word."""
        x = self.inputs(words)
        return {d: (x @ self.p[f"X{d}"] + self.p[f"g{d}"])[words.word] for d in "fb"}

    def each(self, words: Spelled, docs: np.ndarray):
        """Scores, first words (from the document's first) and sizes of all windows of each document."""
        row, at, size = windows(words.first)
        proj = self.projected(words)
        for i in docs:
            m = slice(*np.searchsorted(row, [i, i + 1]))
            y = [self.forward(proj, at[j : min(j + 4096, m.stop)], size[j : min(j + 4096, m.stop)]) for j in range(m.start, m.stop, 4096)]
            yield np.concatenate(y), at[m] - words.first[i], size[m]

    def calibrate(self, words: Spelled, docs: np.ndarray, t: np.ndarray) -> BiGRU:
        """Platt scaling of the worst window's logit on documents that trained no weight, each label
        with the weight it has there."""
        some = np.diff(words.first)[docs] > 0
        t, docs = t[some], docs[some]
        if self.constant is not None or not len(t) or t.min() == t.max():
            return self
        y = np.array([y.max() for y, _, _ in self.each(words, docs)], np.float64)
        x = np.log(np.clip(y, 1e-7, 1 - 1e-7) / (1 - np.clip(y, 1e-7, 1 - 1e-7)))
        goal = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(400):
            q = _sig(a * x + b)
            w = q * (1 - q) + 1e-6
            g = np.array([((q - goal) * x).sum() + 0.1 * (a - 1), (q - goal).sum() + 0.1 * b])
            h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
            step = np.linalg.solve(h, g)
            a, b = a - np.clip(step[0], -0.5, 0.5), b - np.clip(step[1], -0.5, 0.5)
            if abs(step).max() < 1e-6:
                break
        self.slope, self.shift = float(max(a, 0.05)), float(b)
        return self

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The worst window's score of each row; 0 where a row has no words."""
        if self.constant is not None:
            return np.full(len(offs) - 1, self.constant)
        words = Spelled(data, offs)
        out = np.zeros(len(offs) - 1)
        if not len(words.word):
            return out
        proj = self.projected(words)
        row, at, size = windows(words.first)
        for i in range(0, len(at), 4096):
            np.maximum.at(out, row[i : i + 4096], self.forward(proj, at[i : i + 4096], size[i : i + 4096]))
        y = np.clip(out, 1e-7, 1 - 1e-7)
        return np.where(np.diff(words.first) > 0, _sig(self.slope * np.log(y / (1 - y)) + self.shift), 0.0)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> BiGRU:
    """Fit on the whole texts of up to SAMPLE labelled rows per label."""
    rows = labelled_sample(labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label")), "label", "id", SAMPLE)
    got = rows.select("id", "label", "text").toArrow().sort_by("id")
    words = Spelled(*text_bytes(got.column("text")))
    t = np.array(got.column("label").to_pylist(), np.float64)
    apart = mix(np.array(got.column("id").to_numpy(), np.uint64)) % np.uint64(5) == 0
    part = lambda m: (np.flatnonzero(m), t[m])
    return BiGRU().fit(words, *part(~apart)).calibrate(words, *part(apart))


def score(df: DataFrame, model: BiGRU, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """The columns in keep and out, the probability of toxic text, of every row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    body = unused("_text", keep)
    source = df.select(*keep, F.col(text_col).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.scores(data, offs) for _, _, data, offs in blocks(b.column(body), 1 << 19)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(s) if s else np.zeros(0))], names=[*keep, out])

    return source.mapInArrow(tidy(run), StructType([*(source.schema[c] for c in keep), StructField(out, DoubleType())]))
