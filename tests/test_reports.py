"""Order over ranges, reports as files, lookups with many bounds, remote lookups, coverage counted on the write."""

import bisect
import glob
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import census, gate, order, report


def by_name(folder):
    return [line for f in sorted(glob.glob(f"{folder}/part-*")) for line in open(f, encoding="utf-8", newline="\n").read().split("\n")[:-1]]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_numbered(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice([None, *range(9)]), rng.choice("abc"), i) for i in range(500)] + [(4, "a", -1)] * 300
    df = spark.createDataFrame(rows, "x int, s string, i long").repartition(5)
    got = sorted(order.numbered(df, F.desc("x"), "s", "i", parts=parts).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, len(rows) + 1))
    key = lambda x, s, i: (x is None, -(x or 0), s, i)
    assert [(r.x, r.s, r.i) for r in got] == sorted(rows, key=lambda r: key(*r))
    assert order.numbered(df.limit(0), "i").count() == 0


def test_lines_of_a_report(spark, tmp_path):
    rows = [(f"r{k % 3}", k % 3, f"p{k:03}|x", 1000 * k, k % 4 > 0, None if k % 2 else "outside", f"h{min(k, 40)}") for k in range(60)] + [(None, None, None, None, None, None, None)]
    files = spark.createDataFrame(rows, "repo string, ord int, rel string, bytes long, taken boolean, reason string, sha256 string")
    lines = report.inventory(files)
    order.write_lines(lines, f"{tmp_path}/r", "line", *report.PLACE, parts=7)
    got = by_name(f"{tmp_path}/r")
    assert len(glob.glob(f"{tmp_path}/r/part-*")) > 1
    assert got == [r.line for r in sorted(lines.collect(), key=lambda r: tuple(r[c] for c in report.PLACE))]
    taken = [r for r in rows if r[4]]
    total = sum(r[3] for r in taken)
    assert got[0] == "# Inventory of reference material" and got[2] == f"Total to move: **{len(taken)}** files, **{total * 200 // 2**20 // 200}.{(total * 200 + 2**20) // 2**21 % 100:02} MiB**; left in place: **{len(rows) - len(taken)}**."
    heads = [x for x in got if x.startswith("## ")]
    assert heads == ["## —. `—`", "## 0. `r0`", "## 1. `r1`", "## 2. `r2`", "## Duplicates"]
    own = got[got.index("## 1. `r1`") : got.index("## 2. `r2`")]
    assert [x for x in own if x.startswith("| `")] == [f"| `p{k:03}\\|x` | {report_mib(1000 * k)} |" for k in range(60) if k % 3 == 1 and k % 4] + [f"| `p{k:03}\\|x` | {'—' if k % 2 else 'outside'} |" for k in range(60) if k % 3 == 1 and not k % 4]
    twice = got[got.index("## Duplicates") :]
    same = sorted(f"{r[0]}/{r[2]}" for r in taken if r[6] == "h40")
    assert twice[4:] == [f"* {report_mib(59000)} MiB — `{same[0]}`", *(f"  * `{p}`" for p in same[1:])]
    assert report.inventory(files.limit(0)).count() == 0


def report_mib(n):
    h = (n * 200 + 2**20) // 2**21
    return f"{h // 100}.{h % 100:02}"


@pytest.mark.parametrize("per,most", [(1, 5), (7, 40), (4096, 1_000_000)])
def test_as_of(spark, per, most):
    rng = random.Random(per)
    bounds = [(round(rng.gauss(0, 5) ** 3, 1), f"n{i}") for i in range(400)] + [(2.5, "a"), (2.5, "z"), (None, "no")]
    rows = [(i, round(rng.gauss(0, 6) ** 3, 1), "k") for i in range(900)] + [(1000 + i, 2.5, "hot") for i in range(300)] + [(-1, None, "x"), (-2, float("inf"), "x"), (-3, float("-inf"), "x")]
    df, b = spark.createDataFrame(rows, "i long, v double, bound string"), spark.createDataFrame(bounds, "bound double, name string")
    best = {}
    for x, n in bounds:
        if x is not None:
            best[x] = max(best.get(x, ""), n)
    order_ = sorted(best)
    want = {i: None if v is None or not (k := bisect.bisect_right(order_, v)) else best[order_[k - 1]] for i, v, _ in rows}
    got = census.as_of(df, "v", b, per, most).collect()
    assert {r.i: r.name for r in got} == want and len(got) == len(rows) and got[0].__fields__ == ["i", "v", "bound", "name"]
    assert {r.name for r in census.as_of(df, "v", b.limit(0)).collect()} == {None}
    one = census.as_of(df, "v", b.where("name = 'z'"), per, most).collect()
    assert {r.i: r.name for r in one} == {i: "z" if v is not None and v >= 2.5 else None for i, v, _ in rows}


def test_many_bounds(spark):
    """A hundred thousand bounds against a million values."""
    b = spark.range(100_000).select((F.col("id") * 10.0).alias("bound"), F.col("id").cast("string").alias("name"))
    rows = spark.range(1_000_000).select((F.pmod(F.xxhash64("id"), F.lit(1_200_000)) - 100_000).cast("double").alias("v"))
    want = F.when(F.col("v") >= 0, F.least(F.floor(F.col("v") / 10), F.lit(99_999)).cast("string"))
    got = census.as_of(rows, "v", b)
    assert got.where(~F.col("name").eqNullSafe(want)).count() == 0 and got.count() == 1_000_000


def test_each_key_is_fetched_once(spark):
    calls, asked = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def remote(keys):
        calls.add(1)
        asked.add(len(keys))
        return {k: (f"title of {k}", len(k)) for k in keys if k != "k3"}

    rows = spark.createDataFrame([(i, None if i % 10 == 9 else f"k{i % 7}") for i in range(500)], "i long, key string").repartition(6)
    got = census.fetched(rows, "key", remote, "title string, size long", size=2)
    out = {(r.key, r.title, r.size) for r in got.collect()}
    assert out == {(f"k{i}", f"title of k{i}", 2) for i in range(7) if i != 3} | {("k3", None, None), (None, None, None)}
    assert got.count() == 500 and asked.value == 7 and 4 <= calls.value <= 7
    assert census.fetched(rows.limit(0), "key", remote, "title string, size long").count() == 0


def test_coverage_counted_on_the_write(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(len(b))
            yield b

    rows = spark.createDataFrame([(i, (None, "missing", None, "too large", None)[i % 5]) for i in range(100)], "i long, skip_reason string").repartition(3).mapInArrow(count, "i long, skip_reason string")
    got = gate.written(rows, f"{tmp_path}/w")
    assert read.value == 100
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in gate.scan_coverage(rows).collect()} == {("scanned", 60, 60.0), ("missing", 20, 20.0), ("too large", 20, 20.0)}
    assert sorted(r.i for r in spark.read.parquet(f"{tmp_path}/w").collect()) == [i for i in range(100) if i % 5 in (0, 2, 4)]
