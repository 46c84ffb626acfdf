"""Joints of tiles against all pairs."""

import numpy as np
import pytest

from marlstone.operators import assembly


def brute(tiles, overlap, threshold):
    """kit, id, rows of pixels -> (kit, axis, id): (match, cost)."""
    out = {}
    for kit, i, a in tiles:
        for axis in ("right", "down"):
            best = None
            for other, j, b in tiles:
                if other != kit or j == i:
                    continue
                x, y = (a[:, -overlap:], b[:, :overlap]) if axis == "right" else (a[-overlap:], b[:overlap])
                if x.shape == y.shape:
                    cost = float(np.abs(x.astype(int) - y).mean())
                    if cost < threshold and (best is None or (cost, j) < best):
                        best = (cost, j)
            out[kit, axis, i] = best and best[::-1]
    return out


def frame(spark, tiles):
    return spark.createDataFrame([(kit, i, [r.tobytes() for r in a], 1) for kit, i, a in tiles], "kit string, id long, rows array<binary>, axis int")


@pytest.mark.parametrize("threshold,noise", [(1.0, 0), (6.0, 3), (300.0, 40)])
def test_joints(spark, monkeypatch, threshold, noise):
    rng = np.random.default_rng(int(threshold))
    tiles = []
    for kit in "ab":
        page = np.kron(rng.integers(0, 250, (12, 12)), np.ones((6, 6))).astype(np.uint8)
        page[:20] = 255  # a blank margin
        for k, (y, x) in enumerate((y, x) for y in range(0, 56, 12) for x in range(0, 56, 12)):
            tiles.append((kit, k * 7 % 25, np.clip(page[y : y + 20, x : x + 20].astype(int) + rng.integers(0, noise + 1, (20, 20)), 0, 255).astype(np.uint8)))
    tiles.append(("a", 99, np.zeros((3, 2), np.uint8)))
    monkeypatch.setattr(assembly, "BLOCK", 7)
    got = assembly.joints(frame(spark, tiles), overlap=8, threshold=threshold).collect()
    want = brute(tiles, 8, threshold)
    assert {(r.kit, r.axis, r.id): (r.match, r.cost) if r.match is not None else None for r in got} == want and len(got) == len(want)
    if noise == 0:
        assert sum(r.compared for r in got) < 200 and sum(v is not None and v[1] == 0 for v in want.values()) > 60


def test_odd_tiles(spark):
    blank = np.full((9, 9), 7, np.uint8)
    tiles = [("k", i, blank) for i in range(40)] + [("k", 3, blank), ("l", 1, blank)]
    df = frame(spark, tiles).unionByName(spark.createDataFrame([("k", None, [b"123"], 1), ("k", 50, None, 1), ("k", 51, [], 1), ("k", 52, [b""], 1), (None, 9, [b"1"], 1)], "kit string, id long, rows array<binary>, axis int"))
    got = {(r.kit, r.axis, r.id): r.match for r in assembly.joints(df, overlap=4).collect()}
    assert got["k", "right", 0] == 1 and got["k", "down", 1] == 0 and got["k", "right", 39] == 0
    assert got["l", "right", 1] is None and got[None, "down", 9] is None and len(got) == 2 * 42
    assert assembly.joints(df.limit(0)).count() == 0


def test_small_kits_are_one_cell(spark, monkeypatch):
    """One group a kit, axis and shape, where it fits in a block; results as by cells."""
    rng = np.random.default_rng(3)
    tiles = [(kit, i, rng.integers(0, 255, (9, 9)).astype(np.uint8)) for kit in "ab" for i in range(12)]
    key = lambda rows: {(r.kit, r.axis, r.id): (r.match, r.cost) for r in rows}
    one = key(assembly.joints(frame(spark, tiles), overlap=4, threshold=60.0).collect())
    assert {k: v if v[0] is not None else None for k, v in one.items()} == brute(tiles, 4, 60.0)
    asks = assembly.strips(frame(spark, tiles), "kit", "id", "rows", 4).where("leads")
    given = assembly._given(assembly.strips(frame(spark, tiles), "kit", "id", "rows", 4))
    near = assembly._nearest(asks.select("kit", "axis", "shape", "id", "strip"), given, 60.0)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "_few" in plan
    monkeypatch.setattr(assembly, "BLOCK", 5)
    assert key(assembly.joints(frame(spark, tiles), overlap=4, threshold=60.0).collect()) == one


def best(rows):
    return {(r.kit, r.axis, r.id): (r.match, r.cost) if r.match is not None else None for r in rows}


@pytest.mark.parametrize("kit,held", [(4096, 2 << 20), (4096, 300), (14, 2 << 20), (0, 2 << 20)])
def test_kits_that_pass_by_and_kits_that_are_spread(spark, monkeypatch, kit, held):
    """Kits of several shapes, ids below 0, margins and near copies; kits cross batches, and some are too large for a task."""
    rng = np.random.default_rng(kit + held)
    tiles = []
    for k in range(9):
        page = np.kron(rng.integers(0, 250, (9, 9)), np.ones((4, 4))).astype(np.uint8)
        page[:9] = 255
        places = [(y, x) for y in range(0, 24, 6) for x in range(0, 24, 6)][: 4 + 2 * k]
        for n, (y, x) in enumerate(places):
            high, wide = [(12, 12), (12, 3), (2, 12)][n % 3 if k % 2 else 0]
            tiles.append((f"k{k}", n * 7 % 16 - 3, np.clip(page[y : y + high, x : x + wide].astype(int) + rng.integers(0, 3, (high, wide)), 0, 255).astype(np.uint8)))
    monkeypatch.setattr(assembly, "KIT", kit)
    monkeypatch.setattr(assembly, "HELD", held)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = assembly.joints(frame(spark, tiles), overlap=6, threshold=40.0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(tiles, 6, 40.0)
    assert best(got) == want and len(got) == len(want)
    assert sum(v is not None and v[1] > 0 for v in want.values()) > 30


def test_small_kits_meet_in_one_pass(spark):
    """Tiles are shuffled once, and only to be counted are they looked at a second time."""
    looks = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            looks.add(b.num_rows)
            yield b

    rng = np.random.default_rng(5)
    tiles = [(kit, i, rng.integers(0, 9, (9, 9)).astype(np.uint8)) for kit in "abcd" for i in range(10)]
    df = frame(spark, tiles).select("kit", "id", "rows")
    df = df.mapInArrow(seen, df.schema)
    found = assembly.joints(df, overlap=4, threshold=9.0)
    assert best(found.collect()) == brute(tiles, 4, 9.0)
    assert looks.value <= 3 * len(tiles)  # counted, those without a kit looked for, and met


@pytest.mark.parametrize("kit", [4096, 0])
def test_repeated_ids_and_ragged_tiles(spark, monkeypatch, kit):
    """Rows that repeat an id are one tile: it asks once and never matches itself. Strips of another length never match."""
    monkeypatch.setattr(assembly, "KIT", kit)
    a, b = np.full((4, 4), 10, np.uint8), np.full((4, 4), 12, np.uint8)
    rows = [("k", 1, [r.tobytes() for r in a]), ("k", 1, [r.tobytes() for r in b]), ("k", 2, [r.tobytes() for r in b + 1]), ("r", 1, [b"abcd", b"ab", None]), ("r", 2, [b"abcd", b"abcd", b"abcd"]), ("r", 3, [b"abcd", b"ab", b""])]
    got = best(assembly.joints(spark.createDataFrame(rows, "kit string, id long, rows array<binary>"), overlap=2, threshold=50.0).collect())
    assert len(got) == 10 and got["k", "right", 2] == (1, 1.0) and got["k", "down", 1][0] == 2 and got["k", "down", 1][1] in (1.0, 3.0)
    assert got["r", "right", 2] is None and got["r", "down", 1] is None and got["r", "down", 2] is None
    assert got["r", "right", 1] is None and got["r", "right", 3] is None


def test_cut(spark):
    """A rectangle's rows, as by slices; the image is asked for once a tile, not once a row of it."""
    from pyspark.sql import functions as F

    image = np.random.default_rng(1).integers(0, 256, (9, 7)).astype(np.uint8)
    places = [(x, y, w, h) for x in range(7) for y in range(9) for w in range(8 - x) for h in range(10 - y)]
    df = spark.createDataFrame([(*p, image.tobytes()) for p in places], "x long, y long, w long, h long, image binary")
    rows = assembly.cut(F.col("image"), F.lit(7), F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("rows")
    for r in df.select("x", "y", "w", "h", rows).collect():
        want = [image[k, r.x : r.x + r.w].tobytes() for k in range(r.y, r.y + r.h)]
        assert (r.rows is None) == (r.w == 0 or r.h == 0) and (r.rows is None or [bytes(x) for x in r.rows] == want)
    plan = df.select(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("substring(image") < plan.index("lambdafunction")


def test_grid_carries_only_a_tiles_lines(spark):
    """The same tiles with and without pixels; lines are those a tile lies in, and no row holds the whole image."""
    from marlstone.operators import grid

    rng = np.random.default_rng(2)
    pages = [rng.integers(0, 256, (h, 11)).astype(np.uint8) for h in (1, 5, 8, 9, 40)]
    df = spark.createDataFrame([(k, 11, len(a), a.tobytes() + b"rest") for k, a in enumerate(pages)], "page int, iw long, ih long, image binary")
    with_, without = grid.overlap_grid(df, "iw", "ih", 8, 3, "image"), grid.overlap_grid(df, "iw", "ih", 8, 3).drop("image")
    assert set(with_.columns) == {*without.columns, "lines"}
    rows = with_.collect()
    assert {tuple(r[c] for c in without.columns) for r in rows} == {tuple(r) for r in without.collect()} and len(rows) == without.count()
    for r in rows:
        assert bytes(r.lines) == pages[r.page][r.y : r.y + r.h].tobytes()
