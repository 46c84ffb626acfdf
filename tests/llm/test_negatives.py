"""Hard negatives against brute force: odd rows, ties, bounds of segments."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import negatives

MOST = (1 << 63) - 1


def brute(rows, every=50, positives=5, k=3):
    """rows: id, vector, label."""
    ok = [(i, v, lab) for i, v, lab in rows if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    best = {}
    for i, v, lab in ok:
        best[i] = min(best.get(i, (lab, v)), (lab, v))
    x = {i: (lab, [math.floor(Fraction(c) * 256) for c in v]) for i, (lab, v) in best.items()}
    clamp = lambda s: max(-MOST - 1, min(MOST, s))
    out = []
    for a in sorted(x):
        if a % every:
            continue
        lab, q = x[a]
        scores = sorted((-clamp(sum(p * c for p, c in zip(q, v, strict=True))), i, other) for i, (other, v) in x.items() if i != a and len(v) == len(q))
        for p, pid, _ in [s for s in scores if s[2] == lab][:positives]:
            fits = [(s, i) for s, i, other in scores if other != lab and 50 * -p <= 100 * -s <= 95 * -p][:k]
            out += [(a, pid, r + 1, i, -p, -s) for r, (s, i) in enumerate(fits)]
    return sorted(out)


def mined(df, **more):
    got = negatives.mine(df, lambda i: i % 50 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


SCHEMA = "vec_id long, embedding array<double>, label int, id int, v string, seg int, pivot string, r int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA)


def test_clusters(spark, monkeypatch):
    """Rows around a few centres, so that bounds do leave segments out, of several lengths."""
    monkeypatch.setattr(negatives, "ROWS", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 3
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=8) * 0.2)[: 8 if i % 9 else 5].tolist(), int(rng.integers(3))) for i in range(900)]
    assert mined(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same, i % 2) for i in range(120)] + [(i, [0.3, -0.2, 0.9 + i / 1e4], i % 3) for i in range(120, 200)]
    rows += [(None, same, 1), (201, None, 1), (202, [], 1), (203, [1.0, None, 2.0], 1), (204, [float("nan")] * 3, 1), (205, [float("inf"), 0.0, 0.0], 0), (206, same, None), (250, [0.0, 0.0, 0.0], 1), (251, [0.0, 0.0, 0.0], 0), (300, [1.0, 2.0], 1), (301, [1.0, 2.0], 1), (302, [0.7, 1.2], 0), (350, [9.0], 7), (50, same, 1), (50, same, 0), (51, [9.0, 9.0, 9.0], 0), (51, same, 1)]
    assert mined(frame(spark, rows)) == brute(rows)
    assert mined(frame(spark, rows).limit(0)) == []
    assert mined(frame(spark, [r for r in rows if r[2] == 1])) == []


@pytest.mark.parametrize("size", [1e13, 1e17, 1e160, 1e305])
def test_large_numbers(spark, size):
    rng = np.random.default_rng(7)
    rows = [(i, (np.abs(rng.normal(size=4)) * (size if i % 3 else 1.0)).tolist(), i % 2) for i in range(101)]
    assert mined(frame(spark, rows)) == brute(rows)


def test_bounds_hold(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 30)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 6)) + np.repeat(np.eye(6)[:4] * 9, 100, 0)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "id long, v array<double>, label long")
    keys, rows = negatives.build(df, 256)
    stored = {}
    for r in rows.collect():
        stored.setdefault(r.seg, []).append(np.floor(np.array(r.v) * 256))
    least, most = keys.bounds(x[::10])
    assert len(keys.names) == len(stored) >= 10
    for s, low, high in zip(keys.names, least.T, most.T, strict=True):
        scores = np.floor(x[::10] * 256) @ np.array(stored[s]).T
        assert (scores.min(1) >= low).all() and (scores.max(1) <= high).all()
    assert (most < (np.floor(x[::10] * 256) ** 2).sum(1)[:, None]).any()  # some can be left out


def test_labels_as_given(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in e.collect()]
    got = mined(e.withColumn("label", F.col("label").cast("int")))
    assert got == brute(rows) and len(got) > 20
