"""Quality classification by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words, a new one every PASSAGE words; the last may be
shorter, and no word is left out. A passage is encoded as shape statistics (letters, capitals, marks, digits, lengths, repeated
words and word pairs) and a signed bag of its words in HASHED cells. A learned layer turns that into a
representation h; gated attention, exp(w . (tanh(V h) * sigmoid(U h))), normalised over the bag,
weights the passages, and the label of the document is read from the weighted mean of h. Only
document labels train it, in numpy, on a bounded sample of whole texts (SAMPLE rows per label).

Defined results: null, empty or blank text is a bag of one all-zero passage and gets the score the
model gives that; with no labelled rows, or one label only, every score is the share of label 1
(0.5 without labels). Repeated rows and ties score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Words, blocks, labelled_sample, tidy, unused

PASSAGE = 64
HASHED = 1024
#: Documents per label that train, with their whole texts.
SAMPLE = 1500
_CLASS = np.zeros((256, 5), np.float32)  # capital, small letter, digit, mark, beyond ASCII
for _i in range(256):
    _c = chr(_i)
    _CLASS[_i] = [65 <= _i <= 90, 97 <= _i <= 122, 48 <= _i <= 57, 32 < _i < 127 and not _c.isalnum(), _i >= 128]
SHAPE = 13
WIDTH = SHAPE + HASHED


def encode(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of each row and the n + 1 bounds of each row's passages."""
    w = Words(data, offs)
    n_words = np.diff(w.first)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    bound = np.concatenate([[0], np.cumsum(n_pass)])
    x = np.zeros((bound[-1], WIDTH), np.float32)
    if not len(w.start):
        return x, bound
    of = bound[w.row] + (np.arange(len(w.start)) - w.first[w.row]) // PASSAGE
    n = np.bincount(of, minlength=len(x)).astype(np.float32)
    used = n > 0
    head = np.flatnonzero(np.diff(of, prepend=-1))  # first word of each passage that has words
    total = np.zeros((len(data) + 1, 5), np.int32)
    np.cumsum(_CLASS[data], axis=0, dtype=np.int32, out=total[1:])
    tail = np.append(head[1:], len(of)) - 1
    span = (total[w.end[tail]] - total[w.start[head]]).astype(np.float32)
    size = np.maximum(1, span.sum(1, keepdims=True))
    x[used, :5] = span / size
    length = (w.end - w.start).astype(np.float32)
    m = np.maximum(1, n)
    mean = np.bincount(of, length, len(x)) / m
    x[:, 5] = mean / 10
    x[:, 6] = np.sqrt(np.maximum(0, np.bincount(of, length**2, len(x)) / m - mean**2)) / 10
    # Distinct words, and distinct pairs of neighbours, of a passage.
    within = of[1:] == of[:-1]
    for col, p, h in ((7, of, w.hash), (8, of[1:][within], (w.hash[:-1] * np.uint64(31) + w.hash[1:])[within])):
        key = np.sort((p.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        x[:, col] = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(x)) / m
    same = np.zeros(len(of), np.float32)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])
    x[:, 9] = np.bincount(of, same, len(x)) / m
    marked = _CLASS[data[w.end - 1], 3]
    x[:, 10] = np.bincount(of, marked, len(x)) / m
    lone = (total[w.end, 3] - total[w.start, 3] == w.end - w.start).astype(np.float32)
    x[:, 11] = np.bincount(of, lone, len(x)) / m
    x[:, 12] = np.minimum(1, n / PASSAGE)
    sign = ((w.hash >> np.uint64(40)) & np.uint64(1)).astype(np.float32) * 2 - 1
    cell = of * HASHED + (w.hash >> np.uint64(50)).astype(np.int64) % HASHED
    x[:, SHAPE:] = (np.bincount(cell, sign, len(x) * HASHED).reshape(-1, HASHED) / np.sqrt(m)[:, None]).astype(np.float32)
    x[~used, 5:] = 0
    return x, bound


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionMIL:
    """Weights and the passes over bags; bags are given as passages and bounds."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        s = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        first = s(width, hidden)
        # The statistics and the bag of words begin with about the same weight, however many cells.
        first[:SHAPE] = s(SHAPE, hidden)
        first[SHAPE:] *= 0.3
        self.p = {"W": first, "b": np.zeros(hidden, np.float32), "V": s(hidden, gate), "U": s(hidden, gate), "w": s(gate, 1), "c": s(hidden, 1), "d": np.zeros(1, np.float32)}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, dict]:
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (v * u) @ p["w"][:, 0]
        e = np.exp(np.clip(e, -20, 20))
        bag = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
        a = e / np.add.reduceat(e, bound[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, bound[:-1], axis=0)
        y = _sigmoid(z @ p["c"][:, 0] + p["d"][0])
        return y, {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "bag": bag}

    def backward(self, y: np.ndarray, t: np.ndarray, weight: np.ndarray, k: dict) -> dict:
        p = self.p
        g = ((y - t) * weight / len(y)).astype(np.float32)
        out = {"c": k["z"].T @ g[:, None], "d": np.array([g.sum()])}
        gz = g[:, None] * p["c"][:, 0]
        gz_row = gz[k["bag"]]
        gh = k["a"][:, None] * gz_row
        ga = (gz_row * k["h"]).sum(1)
        mean = np.bincount(k["bag"], k["a"] * ga, len(y))[k["bag"]]
        ge = (k["a"] * (ga - mean)).astype(np.float32)
        out["w"] = ((k["v"] * k["u"]).T @ ge)[:, None]
        gv = ge[:, None] * p["w"][:, 0] * k["u"] * (1 - k["v"] ** 2)
        gu = ge[:, None] * p["w"][:, 0] * k["v"] * k["u"] * (1 - k["u"])
        out["V"], out["U"] = k["h"].T @ gv, k["h"].T @ gu
        gh = (gh + gv @ p["V"].T + gu @ p["U"].T) * (1 - k["h"] ** 2)
        out["W"], out["b"] = k["x"].T @ gh, gh.sum(0)
        return out

    def fit(self, bags: list[np.ndarray], t: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.004, seed: int = 3) -> AttentionMIL:
        if not len(t) or t.min() == t.max():
            self.constant = float(t.mean()) if len(t) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean[:SHAPE], self.scale[:SHAPE] = every[:, :SHAPE].mean(0), every[:, :SHAPE].std(0) + 1e-3
        weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean()))
        r = np.random.default_rng(seed)
        m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(t))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                bound = np.concatenate([[0], np.cumsum([len(bags[j]) for j in pick])])
                y, k = self.forward(np.concatenate([bags[j] for j in pick]), bound)
                step += 1
                for name, g in self.backward(y, t[pick], weight[pick], k).items():
                    g = g.astype(np.float32) + 1e-4 * self.p[name]
                    a, b = m[name]
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    self.p[name] = self.p[name] - rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bound) - 1, self.constant)
        return self.forward(x, bound)[0].astype(np.float64)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> AttentionMIL:
    """Fit on the whole texts of up to SAMPLE labelled rows per label."""
    rows = labelled_sample(labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label")), "label", "id", SAMPLE)
    got = rows.select("id", "label", "text").toArrow().sort_by("id")
    bags = []
    for _, _, data, offs in blocks(got.column("text")):
        x, bound = encode(data, offs)
        bags += [x[bound[i] : bound[i + 1]] for i in range(len(bound) - 1)]
    return AttentionMIL(WIDTH).fit(bags, np.array(got.column("label").to_pylist(), np.float64))


def score(df: DataFrame, model: AttentionMIL, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "score") -> DataFrame:
    """The columns in keep and out, the probability of label 1, of every row's whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    body = unused("_text", keep)
    source = df.select(*keep, F.col(text_col).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(*encode(data, offs)) for _, _, data, offs in blocks(b.column(body), 1 << 20)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(s) if s else np.zeros(0))], names=[*keep, out])

    return source.mapInArrow(tidy(run), StructType([*(source.schema[c] for c in keep), StructField(out, DoubleType())]))
