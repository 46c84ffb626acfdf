"""WARC records: round trips, which record is the response, byte ranges, damage."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os

from pyspark.sql import functions as F

from marlstone.llm import warc

SCHEMA = "page_id long, url string, html string, kind string, digest string, payload int, top int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def expected(rows):
    """By page id, url and body: how many responses and revisits, and what these refer to."""
    out, by = {}, {}
    low = lambda r: tuple((v is not None, v or (0 if i == 0 else "")) for i, v in enumerate(r[:2]))
    for r in rows:
        by.setdefault(r[2] or "", []).append(r)
    for body, same in by.items():
        first = max(same, key=low)
        same.remove(first)
        out.setdefault((first[0], body, "response", None), 0)
        out[first[0], body, "response", None] += 1
        for r in same:
            key = (r[0], body, "revisit", first[0])
            out[key] = out.get(key, 0) + 1
    return out


def found(spark, index):
    out = {}
    for r in warc.full_payloads(warc.read(index)).collect():
        body = bytes(r.payload)
        assert r.intact and r.payload_bytes == len(body) and r.digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        key = (r.id, body.decode(), r.kind, r.refers_to)
        out[key] = out.get(key, 0) + 1
    return out


def test_round_trip(spark, tmp_path):
    long = "<p>" + "long text ünïcödé " * 80_000
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "", ""), (5, "http://ü/ x\r\n", "WARC/1.1\r\n\r\nnot a head"), (6, "u", long), (7, "v", long), (None, "n", "no id"), (None, "n", "same"), (8, "w", "twin"), (8, "w", "twin"), (8, "w", "twin"), (8, "a", "twin"), (9, "x", "x\x00\x1fy")]
    df = pages(spark, rows)
    index = warc.write(df, str(tmp_path))
    assert found(spark, index) == expected(rows)
    urls = {(r.id, r.url) for r in warc.read(index, payload=False).collect()}
    assert urls == {(r[0], r[1]) for r in rows}
    assert warc.read(warc.write(df.limit(0))).count() == 0
    nothing = warc.read(warc.write(df, least=1 << 40), payload=False)
    assert {r.kind for r in nothing.collect()} == {"response"} and nothing.count() == len(rows)


def test_many_copies(spark):
    """A payload that a third of all rows share, and rows alike in everything."""
    df = spark.range(3000).select((F.col("id") % 2900).alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "common").otherwise(F.concat(F.lit("own"), F.col("id") % 2900)).alias("html"))
    rows = [(r.page_id, r.url, r.html) for r in df.collect()]
    got = {}
    for r in warc.read(warc.write(df)).collect():
        got[r.kind] = got.get(r.kind, 0) + 1
    want = {}
    for k, n in expected(rows).items():
        want[k[2]] = want.get(k[2], 0) + n
    assert got == want


def test_archives_are_gzip_and_scan(spark, tmp_path):
    df = pages(spark, [(i, f"http://h/{i}", f"body {i % 40} " * (i % 7)) for i in range(200)])
    index = warc.write(df, str(tmp_path))
    files = sorted(str(tmp_path / f) for f in os.listdir(tmp_path))
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\n") for f in files) == 200
    key = lambda t: sorted((os.path.basename(r.file), r.offset, r.length, r.url, r.digest, r.kind, r.id) for r in t.collect())
    assert key(warc.scan(spark, files)) == key(index)


def test_selected_records_only(spark, tmp_path, monkeypatch):
    df = pages(spark, [(i, f"http://h/{i}", f"body {i}") for i in range(300)])
    index = warc.write(df.coalesce(1), str(tmp_path))
    some = index.where("id % 10 = 3")
    assert sorted(bytes(r.payload).decode() for r in warc.read(some, gap=0).collect()) == sorted(f"body {i}" for i in range(3, 300, 10))


def test_spans():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 1000), ("b", 0, 7), ("b", 7, 1)]
    assert list(warc.spans(rows, span=40, gap=5)) == [("a", 0, 30, [(0, 10), (10, 10), (25, 5)]), ("a", 100, 1100, [(100, 1000)]), ("b", 0, 8, [(0, 7), (7, 1)])]
    assert list(warc.spans(rows[:3], span=20, gap=0)) == [("a", 0, 20, [(0, 10), (10, 10)]), ("a", 25, 30, [(25, 5)])]
    assert list(warc.spans([])) == []


def test_damage(spark, tmp_path):
    df = pages(spark, [(i, "u", f"body {i} " * 50) for i in range(20)])
    index = warc.write(df.coalesce(1), str(tmp_path))
    file, third = tmp_path / os.listdir(tmp_path)[0], sorted(index.collect(), key=lambda r: r.offset)[3]
    raw = bytearray(file.read_bytes())
    raw[third.offset + third.length // 2] ^= 0xFF
    file.write_bytes(raw)
    got = warc.read(index).collect()
    assert sorted(r.intact for r in got) == [False] + [True] * 19
