"""Importance resampling against a plain version, spans of long texts, CRCs, ranks."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, items, percent=5, least=20):
    s, t = Counter(), Counter()
    for side, rows in ((s, [d for _, d in docs]), (t, items)):
        for text in rows:
            side.update(features(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000.0) / ((s[b] + 1) * (n_t + 10000.0)))) for b in range(10000)]
    out, able = [], []
    for i, text in docs:
        words, f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=str)


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = queries.op12_importance_resampling(spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == brute(docs, items) and sum(r[4] is not None for r in got) > 3


def test_odd(spark, odd_docs):
    """Also a text longer than a span."""
    long = " ".join(f"Wörd{i % 9173}-x{i % 31}" for i in range(400_000))
    assert len(long) > resample.SPAN
    odd_docs = odd_docs.unionByName(odd_docs.limit(1).withColumns({"doc_id": F.lit(77).cast("long"), "text": F.lit(long)}))
    docs = odd_docs.unionByName(odd_docs.withColumn("text", F.lit("A b C d e f g h i j k l m n o p q r s t u v w x y z"))).withColumns({"weight": F.lit(1), "rank": F.lit(2), "n_words": F.lit("x")})
    target = spark.createDataFrame([("one two three",), (None,), ("",), ("x y z one",)], "text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = resample.resample(docs, target, percent=50).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute(rows, ["one two three", "x y z one"], 50)
    assert sorted((r[:4] for r in map(tuple, got)), key=str) == sorted((r[:4] for r in want), key=str)
    assert sorted((r.rank, r.score) for r in got if r.rank) == sorted((r[4], r[3]) for r in want if r[4])
    assert resample.resample(docs.limit(0), target).count() == 0
    assert resample.resample(docs, target.limit(0)).count() == len(rows)


@pytest.mark.parametrize("most", [1, 7, 64, 1000])
def test_spans(most):
    rng = np.random.default_rng(most)
    for _ in range(30):
        text = "".join(rng.choice(list("abZ9é .-\n"), rng.integers(0, 300), p=[0.2, 0.2, 0.1, 0.1, 0.1, 0.2, 0.05, 0.03, 0.02])) + "q" * int(rng.integers(0, 200))
        data = np.frombuffer(text.encode(), np.uint8)
        total = np.zeros(10000, np.int64)
        for part, known in resample.spans(data, most):
            for bucket, of, times in resample.Suffixes(part, np.array([0, len(part)]), known).grams:
                total += np.bincount(bucket, times, 10000).astype(np.int64)
                assert (np.bincount(bucket[of[of >= 0]], minlength=10000) == np.bincount(bucket, times, 10000)).all()
        assert {b: n for b, n in enumerate(total) if n} == Counter(features(text)[1])


def test_crc():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 256, n).astype(np.uint8) for n in [*range(130), 1000, 70_000]]
    data = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    got = resample.crcs(data, ends - [len(p) for p in parts], ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    whole = resample.moved(np.full(len(parts), zlib.crc32(b"head"), np.uint32), np.array([len(p) for p in parts])) ^ got
    assert whole.tolist() == [zlib.crc32(b"head" + p.tobytes()) for p in parts]


def test_each_run_is_hashed_once():
    """As many codes as there are different n-grams, however many documents share them."""
    text = "the same five words here " * 50
    s = next(resample.runs(pa.array([text] * 40)))[2]
    assert [len(code) for code, _, times in s.grams][0] == 5
    assert [int((times > 0).sum()) for _, _, times in s.grams] == [5, 5, 5]


def test_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(resample, "RANGE", 50)
    rows = spark.range(2000).select((F.col("id") % 300).alias("doc_id"), (F.col("id") % 7).alias("score"), (F.col("id") % 3 > 0).alias("long"))
    got = resample.ranked(rows, F.col("long"), [F.desc("score"), "doc_id"], 700, 2000).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 701)) and len(got) == 2000
    best = sorted(((-r.score, r.doc_id) for r in got if r.long))[:700]
    assert [(-r.score, r.doc_id) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == best
