"""Putting tiles together from their overlaps alone: for every tile and both axes the tile whose facing strip
differs least from its own.

Strips that are equal to the byte meet by an equi-join on their hash; however many tiles share a strip (blank
margins), it is one row there. Only what has no equal twin is compared, and only below the threshold: the means of
both halves of two strips can't lie further apart than the threshold allows, so strips meet in cells of those
means; inside a cell the sums of EIGHTHS parts bound the difference from below, and pixels are compared where
even that bound is small enough. Cells are dealt in blocks, and a block returns the best of each strip, never pairs.

That takes many passes over the tiles. Kits of at most KIT tiles of at most PIXELS bytes meet in one task each instead:
tiles are shuffled once, twins are told by a dictionary, others are compared below the same bound.

Defined results: tiles without pixels or id have no joint; strips of different height, width or length never match; a
tile doesn't match itself; equal differences go to the smaller id; rows that repeat an id count as that tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import shared

#: Parts of a strip whose sums bound a difference; strips of a cell in one block.
EIGHTHS, BLOCK = 8, 512
#: Tiles of a kit, and bytes of a tile, up to which a kit meets in one task; bytes of tiles for a task, and of strips compared at once.
KIT, PIXELS, TASK, HELD = 4096, 2048, 64 << 20, 2 << 20


def cut(image: Column, width: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """Rows (an array of binaries) of a rectangle of an image, one byte a pixel, row after row. The lines it lies in are
    taken from the image at once: each look at a column copies all of it."""
    at = lambda k: (k + 1).cast("int")
    lines = F.array(F.substring(image, at(y * width), (h * width).cast("int")))
    rows = F.transform(lines, lambda part: F.transform(F.sequence(F.lit(0).cast("long"), h.cast("long") - 1), lambda r: F.substring(part, at(r * width + x), w.cast("int"))))
    return F.when((h > 0) & (w > 0), rows[0])


def _joined(rows: Column) -> Column:
    return F.unhex(F.array_join(F.transform(rows, F.hex), ""))


def strips(tiles: DataFrame, kit: str, tile: str, rows: str, overlap: int) -> DataFrame:
    """kit, id, axis, shape, leads, strip: of each tile the strips that face its right and lower neighbour
    (leads true) and its left and upper one."""
    r, n = F.col(rows), F.lit(overlap)
    high, wide = F.size(r), F.octet_length(r[0])
    across, down = F.least(n, wide), F.least(n, high)
    side = lambda begin: F.transform(r, lambda x: F.substring(x, begin, across))
    shape = lambda h, w: F.concat_ws("x", h.cast("string"), w.cast("string"))
    made = [("right", True, shape(high, across), side(wide - across + 1)), ("right", False, shape(high, across), side(F.lit(1))), ("down", True, shape(down, wide), F.slice(r, high - down + 1, down)), ("down", False, shape(down, wide), F.slice(r, F.lit(1), down))]
    each = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.lit(leads).alias("leads"), s.alias("shape"), _joined(x).alias("strip")) for a, leads, s, x in made)))
    ok = F.col(tile).isNotNull() & (high > 0) & (wide > 0)
    cut_ = tiles.where(ok).select(F.col(kit).alias("kit"), F.col(tile).cast("long").alias("id"), each.alias("s")).select("kit", "id", "s.*")
    return cut_.withColumn("shape", F.concat_ws("x", "shape", F.octet_length("strip").cast("string")))  # rows of a tile may differ in length


def _given(all_strips: DataFrame) -> DataFrame:
    """kit, axis, shape, hash, strip, first, second: the different strips that may follow, with the two
    smallest ids that have them."""
    key = ["kit", "axis", "shape", "hash"]
    rows = all_strips.where(~F.col("leads")).withColumn("hash", F.sha2("strip", 256))
    one = rows.groupBy(*key).agg(F.first("strip").alias("strip"), F.min("id").alias("first"), F.max("id").alias("_last"))
    two = rows.select(*key, "id").join(one.where(F.col("first") != F.col("_last")).select(*key, "first"), key).where(F.col("id") > F.col("first")).groupBy(*key).agg(F.min("id").alias("second"))
    return one.drop("_last").join(two, key, "left")


def _cells(rows: DataFrame, threshold: float) -> DataFrame:
    """rows with the cell of the means of both halves of the strip: two strips whose pixels differ by less than
    the threshold in the mean lie in the same or in neighbouring cells."""
    import numpy as np
    import pyarrow as pa

    names = rows.columns

    def run(batches):
        for b in batches:
            cells = np.zeros((len(b), 2), np.int32)
            for i, x in enumerate(b.column("strip").to_pylist()):
                a = np.frombuffer(x, np.uint8)
                for k, half in enumerate((a[: len(a) // 2], a[len(a) // 2 :])):
                    cells[i, k] = int(half.sum(dtype=np.int64) / (threshold * len(a))) if len(half) else 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1])], names=[*names, "c1", "c2"])

    from pyspark.sql.types import IntegerType, StructField, StructType

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("c1", IntegerType()), StructField("c2", IntegerType())]))


def _nearest(asks: DataFrame, given: DataFrame, threshold: float) -> DataFrame:
    """kit, axis, id, match, cost, compared: of each asking strip the best of those below the threshold in its
    own and the neighbouring cells, and how many were compared pixel by pixel. Where all that a kit gives of a shape
    fits in a block, it is one cell: nine copies of a strip and cells of a few would cost more than they spare."""
    import numpy as np
    import pyarrow as pa

    key = ["kit", "axis", "shape", "c1", "c2"]
    few = given.groupBy(*key[:3]).agg((F.count("*") <= BLOCK).alias("_few"))
    zero = F.lit(0)
    given = _cells(given, threshold).join(few, key[:3]).withColumns({c: F.when(F.col("_few"), zero).otherwise(F.col(c)) for c in key[3:]}).drop("_few")
    near = lambda c: F.explode(F.when(F.col("_few"), F.array(zero)).otherwise(F.sequence(F.col(c) - 1, F.col(c) + 1))).alias(c)
    asks = _cells(asks, threshold).join(few, key[:3]).select("_few", "kit", "axis", "shape", "id", "strip", near("c1"), "c2").select("kit", "axis", "shape", "id", "strip", "c1", near("c2"))
    sizes = given.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_j"))
    many = asks.join(sizes, key).groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_i"), F.max("_j").alias("_j"))
    part = lambda n: F.pmod(F.xxhash64("strip", "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    none = F.lit(None).cast("long")
    a = asks.join(many, key).select(*key, part("_i").alias("i"), every("_j").alias("j"), F.lit(True).alias("asks"), "id", none.alias("second"), "strip")
    g = given.withColumn("id", F.col("first")).join(many, key).select(*key, every("_i").alias("i"), part("_j").alias("j"), F.lit(False).alias("asks"), "id", "second", "strip")
    kind = asks.schema["kit"].dataType.simpleString()

    def best(block: tuple, t: pa.Table) -> pa.Table:
        is_a = t.column("asks").to_numpy()
        ids, second = t.column("id").to_numpy(), t.column("second").to_pylist()
        x = np.stack([np.frombuffer(s, np.uint8) for s in t.column("strip").to_pylist()]).astype(np.int32)
        n = x.shape[1]
        edges = np.unique(np.linspace(0, n, EIGHTHS + 1).astype(int))[:-1]
        sums = np.add.reduceat(x, edges, axis=1)
        b_at, out = np.flatnonzero(~is_a), []
        for i in np.flatnonzero(is_a) if len(b_at) else ():
            least = np.abs(sums[b_at] - sums[i]).sum(1)
            cost, match, seen = threshold * n, None, 0
            for at in range(0, len(b_at), 16) if len(b_at) else ():
                order = np.argsort(least, kind="stable") if at == 0 else order
                some = order[at : at + 16]
                some = some[least[some] <= cost]
                if not len(some):
                    break
                found = np.abs(x[b_at[some]] - x[i]).sum(1)
                seen += len(some)
                for k, c in zip(b_at[some].tolist(), found.tolist(), strict=True):
                    other = int(ids[k]) if ids[k] != ids[i] else second[k]
                    if other is not None and c < threshold * n and (c < cost or match is None or c == cost and other < match):
                        cost, match = c, other
            out.append((int(ids[i]), match, cost / n if match is not None else None, seen))
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        fixed = [pa.array([v.as_py()] * len(out), t.schema.field(c).type) for v, c in zip(block[:2], key[:2], strict=True)]
        return pa.table(dict(zip(("kit", "axis", "id", "match", "cost", "compared"), [*fixed, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())], strict=True)))

    found = a.unionByName(g).groupBy(*key, "i", "j").applyInArrow(best, f"kit {kind}, axis string, id long, match long, cost double, compared long")
    return found.groupBy("kit", "axis", "id").agg(F.min(F.when(F.col("match").isNotNull(), F.struct("cost", "match"))).alias("b"), F.sum("compared").alias("compared")).select("kit", "axis", "id", F.col("b.match").alias("match"), F.col("b.cost").alias("cost"), "compared")


def _facing(ids, rows, overlap: int):
    """As strips(), of Arrow arrays. ok: which tiles count; asks and given: (axis, height, width, length) -> places of
    tiles and their strips, those that face the right and lower neighbour, and the left and upper one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    flat = rows.values
    data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    at = np.frombuffer(flat.buffers()[1], np.int64 if pa.types.is_large_binary(flat.type) else np.int32)[flat.offset :][: len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
    first, long = rows.offsets.to_numpy()[:-1].astype(np.int64), np.append(np.diff(at), 0)
    high = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    wide = np.where(high > 0, long[first], 0)
    ok = ids.is_valid().to_numpy(zero_copy_only=False) & (wide > 0)
    tile = np.repeat(np.arange(len(high)), high)
    row = np.arange(len(tile)) + (first - np.cumsum(high) + high)[tile]
    ragged = np.zeros(len(high), bool)
    ragged[tile[long[row] != wide[tile]]] = True
    asks, given = {}, {}

    def put(places, axis, h, w, lead, follow):
        for of, x in ((asks, lead), (given, follow)):
            of.setdefault((axis, h, w, x.shape[1]), []).append((places, x))

    even = np.flatnonzero(ok & ~ragged)
    kinds, kind = np.unique(np.stack([high[even], wide[even]]), axis=1, return_inverse=True)
    for k, (h, w) in enumerate(kinds.T.tolist()):
        places, across, down = even[kind.reshape(-1) == k], min(overlap, w), min(overlap, h)
        starts = at[first[places]]
        x = data[starts[0] :][: len(places) * h * w] if (np.diff(starts) == h * w).all() else np.concatenate([data[s : s + h * w] for s in starts.tolist()])
        x = x.reshape(-1, h, w)
        put(places, "right", h, across, *(np.ascontiguousarray(a).reshape(len(x), -1) for a in (x[:, :, w - across :], x[:, :, :across])))
        put(places, "down", down, w, *(np.ascontiguousarray(a).reshape(len(x), -1) for a in (x[:, h - down :], x[:, :down])))
    for p in np.flatnonzero(ok & ragged).tolist():
        x, h, w = [r or b"" for r in rows[p].as_py()], int(high[p]), int(wide[p])
        across, down = min(overlap, w), min(overlap, h)
        put(np.array([p]), "right", h, across, *(np.frombuffer(b"".join(a), np.uint8)[None] for a in ([r[w - across : w] for r in x], [r[:across] for r in x])))
        put(np.array([p]), "down", down, w, *(np.frombuffer(b"".join(a), np.uint8)[None] for a in (x[h - down :], x[:down])))
    return ok, asks, given


def _meet(of, own, lead, kits, ids, follow, threshold: float):
    """found, match, cost, compared: of each strip of lead, that of tile own of kit number of, the best that its kit has in
    follow, the strips of tiles ids of kits, in the order of both. All kits at once, in pairs of HELD bytes."""
    import numpy as np

    n, m = lead.shape[1], len(own)
    has, match, cost, seen = np.zeros(m, bool), np.zeros(m, np.int64), np.zeros(m), np.zeros(m, np.int64)
    twins: dict[tuple[int, bytes], list[int]] = {}  # different strips: a place, and the two smallest ids that have it
    text = follow.tobytes()
    for k, (c, i) in enumerate(zip(kits.tolist(), ids.tolist(), strict=True)):
        t = twins.setdefault((c, text[k * n : k * n + n]), [k, i])
        if len(t) == 2 and t[1] != i:
            t.append(i)
    text, rest = lead.tobytes(), []
    for k, (c, i) in enumerate(zip(of.tolist(), own.tolist(), strict=True)):
        t = twins.get((c, text[k * n : k * n + n]), [k])
        other = t[1] if len(t) > 1 and t[1] != i else t[2] if len(t) > 2 else None
        if other is None:
            rest.append(k)
        else:
            has[k], match[k] = True, other
    if not rest or not twins or not n:
        return has, match, cost, seen
    rest, each = np.array(rest), list(twins.values())
    one, two = np.array([t[0] for t in each]), np.array([len(t) > 2 for t in each])
    first, second, asker = ids[one], np.array([t[-1] for t in each], np.int64), own[rest]
    x, y = lead[rest].astype(np.int16), follow[one].astype(np.int16)
    edges = np.unique(np.linspace(0, n, EIGHTHS + 1).astype(int))[:-1]
    sx, sy = (np.add.reduceat(z, edges, axis=1, dtype=np.int32) for z in (x, y))
    low, high = (np.searchsorted(kits[one], of[rest], side) for side in ("left", "right"))
    ends = np.cumsum(high - low)
    begins, pairs, pixels, a = ends - high + low, max(1, HELD // (4 * len(edges))), max(1, HELD // (4 * n)), 0
    while a < len(rest):
        b = max(a + 1, int(np.searchsorted(ends, begins[a] + pairs, "right")))
        i = np.repeat(np.arange(a, b), (high - low)[a:b])
        j = np.arange(begins[a], ends[b - 1]) + (low - begins)[i]
        close = (np.abs(sx[i] - sy[j]).sum(1) < threshold * n) & ((first[j] != asker[i]) | two[j])
        i, j = i[close], j[close]
        apart = np.empty(len(i), np.int64)
        for k in range(0, len(i), pixels):
            d = x[i[k : k + pixels]]
            d -= y[j[k : k + pixels]]
            apart[k : k + pixels] = np.abs(d, out=d).sum(1, dtype=np.int64)
        seen[rest[a:b]] = np.bincount(i - a, minlength=b - a)
        near = apart < threshold * n
        i, j, apart = i[near], j[near], apart[near]
        other = np.where(first[j] != asker[i], first[j], second[j])
        order = np.lexsort((other, apart, i))
        best = order[np.diff(i[order], prepend=-1) != 0]
        to = rest[i[best]]
        has[to], match[to], cost[to] = True, other[best], apart[best] / n
        a = b
    return has, match, cost, seen


def _gathered(tiles: DataFrame, overlap: int, threshold: float, tasks: int) -> DataFrame:
    """joints of tiles (kit, id, rows) whose kits fit in a task each: kits meet as they pass by, in their order."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def meet(kits, ids, rows, names):
        ok, asks, given = _facing(ids, rows, overlap)
        run = np.cumsum([0, *(a != b for a, b in zip(names[1:], names, strict=False))])
        number = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        order = np.lexsort((number, run))
        order = order[ok[order]]
        run, number, place = run[order], number[order], np.zeros(len(ok), np.int64)
        place[order] = np.arange(len(order))
        leads = (np.diff(run, prepend=-1) != 0) | np.append(True, np.diff(number) != 0)[: len(order)]  # rows that repeat an id ask once
        out = {axis: (np.zeros(len(order), bool), np.zeros(len(order), np.int64), np.zeros(len(order)), np.zeros(len(order), np.int64)) for axis in ("right", "down")}

        def ordered(parts):
            p, x = place[np.concatenate([a for a, _ in parts])], np.concatenate([b for _, b in parts])
            by = np.argsort(p, kind="stable")
            return p[by], x[by]

        for key in asks.keys() & given.keys():
            (p, x), (q, y) = ordered(asks[key]), ordered(given[key])
            p, x = p[leads[p]], x[leads[p]]
            for to, values in zip(out[key[0]], _meet(run[p], number[p], x, run[q], number[q], y, threshold), strict=True):
                to[p] = values
        for axis, cols in out.items():
            has, match, cost, seen = (c[leads] for c in cols)
            none = lambda c: pa.array(c, mask=~has)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([kits.take(pa.array(order[leads])), pa.array([axis] * len(has), pa.string()), pa.array(number[leads]), none(match), none(cost), pa.array(seen)], names=["kit", "axis", "id", "match", "cost", "compared"])

    def run(batches):
        last = None
        for b in batches:
            t = pa.Table.from_batches([b]) if last is None else pa.concat_tables([last, pa.Table.from_batches([b])])
            names = t.column("kit").to_pylist()
            end = next((k for k in range(len(names) - 1, 0, -1) if names[k] != names[k - 1]), 0)
            if end:
                yield from meet(*(c.combine_chunks() for c in t.slice(0, end).columns), names[:end])
            last = t.slice(end)
        if last is not None and len(last):
            yield from meet(*(c.combine_chunks() for c in last.columns), last.column("kit").to_pylist())

    kind = tiles.schema["kit"].dataType.simpleString()
    return tiles.repartition(tasks, "kit").sortWithinPartitions("kit").mapInArrow(run, f"kit {kind}, axis string, id long, match long, cost double, compared long")


def _spread(tiles: DataFrame, overlap: int, threshold: float) -> DataFrame:
    """joints of tiles (kit, id, rows) of which a kit may be too large for a task."""
    every = shared.kept(strips(tiles, "kit", "id", "rows", overlap), "strips")  # many joins read them
    given = _given(every)
    asks = every.where("leads").drop("leads").dropDuplicates(["kit", "axis", "id"]).withColumn("hash", F.sha2("strip", 256))
    key = ["kit", "axis", "shape", "hash"]
    same = asks.join(given.select(*key, "first", "second"), key, "left")
    same = same.withColumn("match", F.when(F.col("first") != F.col("id"), F.col("first")).otherwise(F.col("second")))
    exact = same.where("match is not null").select("kit", "axis", "id", "match", F.lit(0.0).alias("cost"), F.lit(0).cast("long").alias("compared"))
    rest = same.where("match is null").select("kit", "axis", "shape", "id", "strip")
    near = _nearest(rest, given.select("kit", "axis", "shape", "strip", "first", "second"), threshold)
    alone = rest.select("kit", "axis", "id").join(near, ["kit", "axis", "id"], "left").withColumn("compared", F.coalesce("compared", F.lit(0).cast("long")))
    return exact.unionByName(alone.select(*exact.columns))


def joints(tiles: DataFrame, kit: str = "kit", tile: str = "id", rows: str = "rows", overlap: int = 64, threshold: float = 1.0, sizes: DataFrame | None = None) -> DataFrame:
    """kit, axis (right or down), id, match, cost, compared: for every tile the tile of its kit that continues
    it there, with a mean difference below the threshold; match is null where there is none. compared: strips
    that were compared pixel by pixel for it, 0 for matches to the byte. sizes: kit and bytes of every tile, where they are
    known without its pixels; tiles are counted first, by a job of its own."""
    spark = tiles.sparkSession
    if sizes is None:
        sizes = tiles.select(kit, (F.size(rows).cast("long") * F.octet_length(F.get(rows, F.lit(0)))).alias("bytes"))
    sizes = sizes.where(F.col(kit).isNotNull()).groupBy(F.col(kit).alias("kit")).agg(F.sum("bytes").alias("bytes"), ((F.count("*") > KIT) | F.coalesce(F.max("bytes") > PIXELS, F.lit(False))).alias("large"))
    tiles = tiles.select(F.col(kit).alias("kit"), F.col(tile).cast("long").alias("id"), F.col(rows).alias("rows"))
    total, large = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count_if("large")).first()
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK))
    axes = F.explode(F.array(F.lit("right"), F.lit("down"))).alias("axis")
    no = F.lit(None)
    out = strips(tiles.where("kit is null"), "kit", "id", "rows", overlap).select("kit", "id").distinct().select("kit", axes, "id", no.cast("long").alias("match"), no.cast("double").alias("cost"), F.lit(0).cast("long").alias("compared"))
    small = tiles.where("kit is not null")
    if large:
        beyond = shared.kept(sizes.where("large").select("kit"), "kits")
        out = out.unionByName(_spread(tiles.join(beyond, "kit", "left_semi"), overlap, threshold))
        small = small.join(beyond, "kit", "left_anti")
    return out.unionByName(_gathered(small, overlap, threshold, tasks))


def joint_quality(found: DataFrame, places: DataFrame) -> DataFrame:
    """axis, found, correct, exact: joints below the threshold, how many of them lead to a tile of the same row
    (column) further right (down) by the places (kit, id, x, y), and how many are to the byte."""
    own, other = places.select("kit", "id", F.col("x").alias("x1"), F.col("y").alias("y1")), places.select("kit", F.col("id").alias("match"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    m = found.join(own, ["kit", "id"], "left").join(other, ["kit", "match"], "left")
    right = F.when(F.col("axis") == "right", (F.col("y1") == F.col("y2")) & (F.col("x2") > F.col("x1"))).otherwise((F.col("x1") == F.col("x2")) & (F.col("y2") > F.col("y1")))
    return m.groupBy("axis").agg(F.count("match").alias("found"), F.count_if(F.coalesce(right, F.lit(False))).alias("correct"), F.count_if(F.col("cost") == 0).alias("exact"))
