"""Islands of long parts, and profiles of pages, against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import grid, profile


def plain(rows, keep_tail):
    """(part, order, on) -> (part, start, length)."""
    out = []
    for part in {r[0] for r in rows}:
        on = [r[2] for r in sorted((r for r in rows if r[0] == part), key=lambda r: r[1])]
        i = 0
        while i < len(on):
            j = i
            while j < len(on) and on[j]:
                j += 1
            if j > i and (keep_tail or j < len(on)):
                out.append((part, i + 1, j - i))
            i = max(j, i + 1)
    return sorted(out, key=str)


@pytest.mark.parametrize("keep_tail", [True, False])
@pytest.mark.parametrize("segment", [3, 10, 64, 10_000])
def test_segments(spark, keep_tail, segment):
    rng = np.random.default_rng(segment)
    rows = [("long", int(x), bool(rng.random() < 0.7)) for x in np.cumsum(rng.integers(1, 9, 400))]
    rows += [("all", x, True) for x in range(200)] + [("none", x, False) for x in range(50)] + [(None, x, x % 5 > 0) for x in range(70)] + [("one", 5, True)]
    df = spark.createDataFrame(rows, "p string, x long, b boolean")
    got = grid.islands(df, "p", "x", F.col("b"), keep_tail, segment)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, keep_tail)
    times = df.withColumn("x", F.timestamp_micros(F.col("x") * 1000))
    assert sorted(map(tuple, grid.islands(times, "p", "x", F.col("b"), keep_tail, segment).collect()), key=str) == plain(rows, keep_tail)
    assert grid.islands(df.limit(0), "p", "x", F.col("b"), keep_tail, segment).count() == 0


def looked_at(a, dark=128):
    """The rules, stated plainly."""
    ink = a < dark
    runs = lambda on, tail: [n for _, _, n in plain([("p", i, bool(v)) for i, v in enumerate(on)], tail)]
    rows, cols, mean = ink.mean(1), ink.mean(0), ink.sum() / ink.size
    lines = runs(rows > max(0.002, mean * 0.35), True)
    wide = [n for n in runs(cols < max(0.001, mean * 0.15), False) if n > a.shape[1] * 0.04]
    gutter = min(range(int(0.4 * a.shape[1]), int(0.6 * a.shape[1])), key=lambda x: (ink[:, x].sum(), x), default=None)
    return a.shape[1], a.shape[0], round(float(mean), 4), len(lines), float(np.median(lines)) if lines else 0.0, len(wide), 1 + sum(n > a.shape[1] * 0.06 for n in wide), gutter


def test_traits(spark, monkeypatch):
    rng = np.random.default_rng(2)
    images = {}
    for i in range(6):
        a = np.full((60, 50), 240, np.uint8)
        for y in range(4 + i, 56, 9):
            a[y : y + 4 + i % 2, 5:45] = rng.integers(0, 256, (4 + i % 2, 40))
        a[:, 22:27] = 255 if i % 2 else 130
        images[i] = a
    images[6], images[7] = np.full((3, 40), 255, np.uint8), np.zeros((5, 7), np.uint8)
    df = spark.createDataFrame([(i, a.tobytes() + b"\x01\x02", a.shape[1], "k") for i, a in images.items()] + [(8, None, 5, "k"), (9, b"", 5, "k"), (10, b"abc", None, "k")], "page long, image binary, width long, y string")
    for segment in (grid.SEGMENT, 8):
        monkeypatch.setattr(grid, "SEGMENT", segment)
        means = profile.means(profile.pixels(df.drop("y"), "page", "image", "width"), "page")
        gutter = {r.page: r.x for r in profile.gutters(means, "page").collect()}
        got = {r.page: (r.w, r.h, r.density, r.lines, r.line_height, r.gaps, r.columns, gutter.get(r.page)) for r in profile.traits(means, "page").collect()}
        assert got == {i: looked_at(a) for i, a in images.items()}


def test_density_is_rounded_as_the_double_it_is(spark):
    """226 of 1600 pixels are 0.14125, as a double a little less."""
    image = bytes([0] * 226 + [255] * 1374)
    df = spark.createDataFrame([(1, image, 64)], "page int, image binary, width int")
    means = profile.means(profile.pixels(df, "page", "image", "width"), "page")
    assert profile.traits(means, "page").first().density == 0.1412
