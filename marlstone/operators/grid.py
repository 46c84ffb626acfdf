"""Geometry: tile grids, page samples, page specs, resolutions, tile kits. Closed forms; a row of
the input makes only its own rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def overlap_starts(total, tile: int, overlap: int) -> Column:
    """Starts of tiles with a regular step; the last is shifted to the edge."""
    total, step = _col(total).cast("long"), tile - overlap
    k = F.ceil((total - tile) / step).cast("long")
    regular = F.sequence(F.lit(0).cast("long"), (k - 1) * step, F.lit(step).cast("long"))
    return F.when(total <= tile, F.array(F.lit(0).cast("long"))).otherwise(F.array_append(regular, total - tile))


def clean_starts(total, tile: int) -> Column:
    """Starts of tiles without overlap; the last is smaller. Nothing for an empty extent."""
    total = _col(total).cast("long")
    return F.when(total > 0, F.sequence(F.lit(0).cast("long"), total - 1, F.lit(tile).cast("long"))).otherwise(F.array().cast("array<long>"))


def _grid(df: DataFrame, width: str, height: str, xs: Column, ys: Column, tile: int, image: str | None = None) -> DataFrame:
    rows = df.withColumn("_nx", F.size(xs))
    if image is None:
        rows = rows.select("*", F.posexplode(ys).alias("row", "y"))
    else:  # bound by a lambda, the image is read once, and no row of the explode holds a copy of it
        line = F.col(width).cast("long")
        lines = lambda px, y: F.substring(px, (y * line + 1).cast("int"), (F.least(F.lit(tile).cast("long"), F.col(height).cast("long") - y) * line).cast("int"))
        parts = F.transform(F.array(image), lambda px: F.transform(ys, lambda y: F.struct(y.alias("y"), lines(px, y).alias("lines"))))[0]
        rows = rows.select(*(c for c in rows.columns if c != image), F.posexplode(parts).alias("row", "_part")).select("*", "_part.y", "_part.lines").drop("_part")
    rows = rows.select("*", F.posexplode(xs).alias("col", "x"))
    size = lambda at, total: F.least(F.lit(tile).cast("long"), F.col(total).cast("long") - at)
    return rows.withColumns({"w": size(F.col("x"), width), "h": size(F.col("y"), height), "tile": F.col("row") * F.col("_nx") + F.col("col")})


def overlap_grid(df: DataFrame, width: str, height: str, tile: int = 1024, overlap: int = 128, image: str | None = None) -> DataFrame:
    """df with a row per tile: row, col, x, y, w, h, tile (row-major), the numbers of its four
    neighbours (null at the border), and the nominal overlap on each side (0 at the page's edge). image, a column of
    binaries of a byte a pixel, is replaced by lines, those that the tile lies in: with the whole of it in each row a page
    would take the square of its length."""
    xs, ys = overlap_starts(width, tile, overlap), overlap_starts(height, tile, overlap)
    out = _grid(df.withColumn("_ny", F.size(ys)), width, height, xs, ys, tile, image)
    first_row, last_row = F.col("row") == 0, F.col("row") == F.col("_ny") - 1
    first_col, last_col = F.col("col") == 0, F.col("col") == F.col("_nx") - 1
    near = lambda edge, by: F.when(~edge, F.col("tile") + by)
    over = lambda edge: F.when(edge, 0).otherwise(overlap)
    return out.withColumns({
        "up": near(first_row, -F.col("_nx")), "down": near(last_row, F.col("_nx")), "left": near(first_col, F.lit(-1)), "right": near(last_col, F.lit(1)),
        "over_up": over(first_row), "over_down": over(last_row), "over_left": over(first_col), "over_right": over(last_col),
    }).drop("_nx", "_ny")


def clean_grid(df: DataFrame, width: str, height: str, tile: int = 1024) -> DataFrame:
    return _grid(df, width, height, clean_starts(width, tile), clean_starts(height, tile), tile).drop("_nx")


def sample_pages(n) -> Column:
    """Pages to look at: all ends of short documents, thirds up to 40 pages, fifths beyond."""
    n = _col(n).cast("long")
    at = lambda k, of: F.floor(n * k / of).cast("long")
    one = F.lit(1).cast("long")
    return F.when(n <= 1, F.array(one)).otherwise(F.array_sort(F.array_distinct(F.when(n <= 4, F.array(one, n)).when(n <= 40, F.array(one, at(1, 3), at(2, 3), n)).otherwise(F.array(one, at(1, 5), at(2, 5), at(3, 5), at(4, 5), n)))))


def page_spec(spec, n) -> Column:
    """Pages of a spec such as 1-10,15: ranges clamped to 1..n, single pages outside dropped, sorted
    and distinct. 7-3 and unreadable parts name no page; an empty spec names all."""
    spec, n = _col(spec), _col(n).cast("int")
    none = F.array().cast("array<int>")

    def part(p: Column) -> Column:
        lo, hi = F.regexp_extract(p, r"^\s*(\d+)\s*(-\s*(\d+)\s*)?$", 1), F.regexp_extract(p, r"^\s*(\d+)\s*(-\s*(\d+)\s*)?$", 3)
        a = F.greatest(F.lit(1), lo.try_cast("int"))
        b = F.least(n, hi.try_cast("int"))
        single = lo.try_cast("int")
        return F.when(hi != "", F.when(b >= a, F.sequence(a, b)).otherwise(none)).when((single >= 1) & (single <= n), F.array(single)).otherwise(none)

    every = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(none)
    return F.when(F.trim(F.coalesce(spec, F.lit(""))) == "", every).otherwise(F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), part)))))


def effective_dpi(long_px, long_pt, asked: int = 300, max_px: int = 10_000) -> Column:
    """Resolution of the page's own raster, scaled down to max_px, 36 at least; asked where the
    raster or the page size isn't known."""
    px, pt = _col(long_px), _col(long_pt)
    own = 72.0 * px / pt
    known = (px > 0) & (pt > 0)
    dpi = F.when(known, own).otherwise(F.lit(float(asked)))
    wide = F.when(pt > 0, dpi * pt / 72.0)
    return F.greatest(F.lit(36), F.rint(F.when(wide > max_px, dpi * max_px / wide).otherwise(dpi)).cast("int"))


def dpi_reason(long_px, long_pt, max_px: int = 10_000) -> Column:
    """Why effective_dpi() has its value: asked, native or scaled."""
    px, pt = _col(long_px), _col(long_pt)
    known = F.coalesce((px > 0) & (pt > 0), F.lit(False))
    return F.when(~known, "asked").when(px > max_px, "scaled").otherwise("native")


def page_dpi(pages: DataFrame, images: DataFrame, sizes: DataFrame, keys: list[str], asked: int = 300, max_px: int = 10_000) -> DataFrame:
    """keys, dpi and reason of every page, from the largest image (w, h) and the size in points (w, h)
    of the page, where there are any."""
    long = lambda t, name: t.select(*keys, F.greatest("w", "h").alias(name))
    rows = pages.select(*keys).join(long(images, "_px"), keys, "left").join(long(sizes, "_pt"), keys, "left")
    return rows.select(*keys, effective_dpi("_px", "_pt", asked, max_px).alias("dpi"), dpi_reason("_px", "_pt", max_px).alias("reason"))


def needs_render(chars, force: bool = False, least: int = 200) -> Column:
    """Whether a page must be rendered: its text layer is poor, or rendering is forced."""
    return F.lit(True) if force else F.coalesce(_col(chars), F.lit(0)) < least


def tiles_of(w, h, tile: int = 1024, overlap: int = 128) -> Column:
    """Number of tiles of overlap_grid()."""
    return (F.size(overlap_starts(w, tile, overlap)) * F.size(overlap_starts(h, tile, overlap))).cast("long")


def document_rollup(pages: DataFrame, doc: str) -> DataFrame:
    """pages, with_text, rendered, chars and tiles per document, from a row per page (chars, w, h)."""
    render = needs_render("chars")
    return pages.groupBy(doc).agg(F.count("*").alias("pages"), F.count_if(F.col("chars") > 0).alias("with_text"), F.count_if(render).alias("rendered"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.coalesce(F.sum(F.when(render, tiles_of("w", "h"))), F.lit(0)).alias("tiles"))


def index_statistics(pages: DataFrame) -> DataFrame:
    """Of pages (chars, dpi, bytes_in, bytes_out): how many, the percentage with text, distinct, least
    and largest dpi, and the size of what was made in percent of what came in."""
    percent = lambda part, whole: 100.0 * part / F.greatest(F.lit(1), whole)
    return pages.agg(
        F.count("*").alias("pages"), percent(F.count_if(F.col("chars") > 0), F.count("*")).alias("text_percent"), F.count_distinct("dpi").alias("dpis"), F.min("dpi").alias("dpi_from"), F.max("dpi").alias("dpi_to"),
        percent(F.coalesce(F.sum("bytes_out"), F.lit(0)), F.coalesce(F.sum("bytes_in"), F.lit(0))).alias("size_percent"),
    )


def ink(pixels: DataFrame, page: str, flag: Column) -> DataFrame:
    """page, pixels, ink (pixels where flag holds) and density."""
    return pixels.groupBy(page).agg(F.count("*").alias("pixels"), F.count_if(flag).alias("ink")).withColumn("density", F.col("ink") / F.col("pixels"))


def column_runs(df: DataFrame, page: str, x: str, blank: Column) -> DataFrame:
    """page, gaps and columns: blank runs of over 4 % of the width, and one more than those of over
    6 %. A run that reaches the last column doesn't count, one from the first does."""
    width = df.groupBy(page).agg(F.count("*").alias("_width"))
    runs = islands(df, page, x, blank, keep_tail=False)
    return width.join(runs, page, "left").groupBy(page).agg(F.count_if(F.col("length") > 0.04 * F.col("_width")).alias("gaps"), (1 + F.count_if(F.col("length") > 0.06 * F.col("_width"))).alias("columns"))


def clamped(w, h, max_px: int) -> dict[str, Column]:
    """Width and height scaled down to max_px on the long side, fractions cut."""
    w, h = _col(w), _col(h)
    ratio = F.least(F.lit(1.0), max_px / F.greatest(w, h))
    return {"w": (w * ratio).cast("int"), "h": (h * ratio).cast("int")}


def draw(*keys: Column, seed: int = 1) -> Column:
    """A number in [0, 1) from the keys' md5, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *keys).cast("binary")), 1, 8), 16, 10).cast("long") / float(1 << 32)


def kit(tiles: DataFrame, keys: list[str], gap: int = 96, withhold: float = 0.25, scale: float = 0.5, seed: int = 1) -> DataFrame:
    """Tiles that go into an incomplete public kit: withheld by a hash of their key, cropped by the
    gap on every side, degenerate ones dropped, with the scaled size."""
    w, h = F.col("w") - 2 * gap, F.col("h") - 2 * gap
    kept = tiles.where(draw(*(F.col(k).cast("string") for k in keys), seed=seed) >= withhold).where((w >= 16) & (h >= 16))
    return kept.withColumns({"crop_w": w, "crop_h": h, "out_w": F.greatest(F.lit(1), (w * scale).cast("int")), "out_h": F.greatest(F.lit(1), (h * scale).cast("int"))})


def kit_area(tiles: DataFrame, kept: DataFrame, doc: str) -> DataFrame:
    """doc, of, kept, percent of the tiles' area that the kit shows (overlaps count twice)."""
    every = tiles.groupBy(doc).agg(F.count("*").alias("of"), F.sum(F.col("w") * F.col("h")).alias("_all"))
    some = kept.groupBy(doc).agg(F.count("*").alias("kept"), F.sum(F.col("crop_w") * F.col("crop_h")).alias("_some"))
    return every.join(some, doc, "left").select(doc, "of", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"), (100.0 * F.coalesce("_some", F.lit(0)) / F.greatest(F.lit(1), F.col("_all"))).alias("percent"))


def shown_share(areas: DataFrame) -> DataFrame:
    """Documents and the mean of their shares, each rounded to a decimal before, as they are reported."""
    return areas.agg(F.count("*").alias("documents"), text.rounded(F.avg(text.rounded(F.col("percent"), 1)), 3).alias("mean_percent"))


def image_grid(lines: DataFrame, line: str, doc: str) -> DataFrame:
    """doc, page, w, h: the largest width and height of the images on each page, from lines of an
    image list; masks (an extent of 1 or less), headers and lines that don't read are left out."""
    f = F.filter(F.split(F.trim(F.col(line)), r"\s+"), lambda x: x != "")
    num = lambda i: F.get(f, F.lit(i)).try_cast("int")
    rows = lines.select(doc, num(0).alias("page"), num(3).alias("w"), num(4).alias("h")).where("page is not null and w > 1 and h > 1")
    return rows.groupBy(doc, "page").agg(F.max("w").alias("w"), F.max("h").alias("h"))


def best_neighbours(edges: DataFrame, kit_col: str, id_col: str, out_edge: str, in_edge: str, block: int = 2048) -> DataFrame:
    """kit, id, match, cost: for every tile the tile of its kit, not itself, whose in_edge lies
    nearest to its out_edge by mean absolute difference; ties to the smaller id. Edges of another
    length are no candidates. Tiles meet in blocks, dealt over a number of tasks of their own (their bytes are few, their
    pairs many): a block returns one best row per tile. Costs add up in the order of the edge."""
    import numpy as np
    import pyarrow as pa

    parts = edges.groupBy(kit_col).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("_parts"))
    rows = edges.select(kit_col, F.col(id_col).cast("long").alias("id"), F.col(out_edge).cast("array<double>").alias("out"), F.col(in_edge).cast("array<double>").alias("in")).join(parts, kit_col)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    asks = rows.select(kit_col, F.col("_part").alias("i"), every.alias("j"), F.lit(True).alias("asks"), "id", F.col("out").alias("edge"))
    given = rows.select(kit_col, every.alias("i"), F.col("_part").alias("j"), F.lit(False).alias("asks"), "id", F.col("in").alias("edge"))

    def nearest(key: tuple, t: pa.Table) -> pa.Table:
        ids, asks_, edge = t.column("id").to_numpy(), t.column("asks").to_numpy(), t.column("edge").to_pylist()
        out = []
        by: dict[int, list[int]] = {}
        for i in np.flatnonzero(~asks_):
            if edge[i]:
                by.setdefault(len(edge[i]), []).append(i)
        tables = {n: (ids[np.array(v)], np.array([edge[i] for i in v])) for n, v in by.items()}
        asking: dict[int, list[int]] = {}
        for i in np.flatnonzero(asks_):
            if edge[i] and len(edge[i]) in tables:
                asking.setdefault(len(edge[i]), []).append(i)
        for n, places in asking.items():
            order = np.argsort(tables[n][0], kind="stable")  # of equal costs the first is the smallest id
            other, x = tables[n][0][order], np.ascontiguousarray(tables[n][1][order].T)
            for at in range(0, len(places), 128):
                some = places[at : at + 128]
                e = np.array([edge[i] for i in some]).T
                cost = np.zeros((len(some), len(other)))
                for d in range(n):
                    cost += np.abs(x[d] - e[d][:, None])
                cost /= n
                cost[other == ids[some][:, None]] = np.inf
                best = cost.argmin(1)
                least = cost[np.arange(len(some)), best]
                out += [(int(ids[i]), int(other[k]), float(m)) for i, k, m in zip(some, best.tolist(), least.tolist(), strict=True) if np.isfinite(m)]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({kit_col: pa.array([key[0].as_py()] * len(out), t.schema.field(kit_col).type), "id": pa.array(cols[0], pa.int64()), "match": pa.array(cols[1], pa.int64()), "cost": pa.array(cols[2], pa.float64())})

    kind = edges.schema[kit_col].dataType.simpleString()
    spark = edges.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = asks.unionByName(given).repartition(tasks, kit_col, "i", "j").groupBy(kit_col, "i", "j").applyInArrow(nearest, f"{kit_col} {kind}, id long, match long, cost double")
    return found.groupBy(kit_col, "id").agg(F.min(F.struct("cost", "match")).alias("b")).select(kit_col, "id", F.col("b.match").alias("match"), F.col("b.cost").alias("cost"))


def match_quality(matches: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """axis, found (cost below the threshold), correct (the match is the true neighbour), exact (cost
    0). truth: axis, id, neighbour; a tile without one has none."""
    m = matches.join(truth, ["axis", "id"], "left")
    below = F.col("cost") < threshold
    return m.groupBy("axis").agg(F.count_if(below).alias("found"), F.count_if(below & F.col("match").eqNullSafe(F.col("neighbour"))).alias("correct"), F.count_if(F.col("cost") == 0).alias("exact"))


#: Rows of a part above which it is cut into segments of about so many.
SEGMENT = 1_000_000


def islands(df: DataFrame, part: str, order: str, flag: Column, keep_tail: bool = True, segment: int | None = None) -> DataFrame:
    """part, start, length of each run of rows where flag holds, in order. With keep_tail False a run
    that reaches the last row is left out, a leading one is not. order is a number or a time; a part of more
    than `segment` rows is cut into segments of equal width in it, runs are found in each, and only those that touch a
    segment's border meet others of their part: no window holds a whole long part."""
    segment = segment or SEGMENT
    at = F.unix_micros(F.col(order).cast("timestamp")) if df.schema[order].dataType.simpleString().startswith("timestamp") else F.col(order).cast("double")
    long = df.groupBy(F.col(part).alias("_part")).agg(F.count("*").alias("_rows"), F.min(at).alias("_low"), F.max(at).alias("_high")).where(F.col("_rows") > segment)
    long = long.withColumn("_wide", F.greatest((F.col("_high") - F.col("_low")) / F.ceil(F.col("_rows") / segment), F.lit(1e-9)))
    rows = df.select(part, order, flag.alias("_on"), at.alias("_at"))
    rows = rows.join(long, F.col(part).eqNullSafe(F.col("_part")), "left").withColumn("_seg", F.coalesce(F.floor((F.col("_at") - F.col("_low")) / F.col("_wide")), F.lit(0)))
    sizes = rows.where("_rows is not null").groupBy("_part", "_seg").agg(F.count("*").alias("_size"))  # a row per segment
    before = F.coalesce(F.sum("_size").over(Window.partitionBy("_part").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = sizes.select("_part", F.col("_seg").alias("_s"), before.alias("_before"), F.sum("_size").over(Window.partitionBy("_part")).alias("_total"))

    w = Window.partitionBy(part, "_seg").orderBy(order)
    rows = rows.select(part, "_seg", order, "_on", F.row_number().over(w).alias("_i"), F.count("*").over(Window.partitionBy(part, "_seg")).alias("_n"))
    on = rows.where("_on").withColumn("_run", F.col("_i") - F.row_number().over(w))
    runs = on.groupBy(part, "_seg", "_run").agg(F.min("_i").alias("_from"), F.count("*").alias("length"), F.first("_n").alias("_n"))
    runs = runs.join(places, F.col(part).eqNullSafe(F.col("_part")) & (F.col("_seg") == F.col("_s")), "left")
    touches = F.col("_before").isNotNull() & ((F.col("_from") == 1) | (F.col("_from") + F.col("length") - 1 == F.col("_n")))
    start = F.col("_from") + F.coalesce("_before", F.lit(0))
    runs = runs.select(part, start.alias("start"), "length", F.coalesce("_total", "_n").alias("_total"), F.when(touches, -1).otherwise(start).alias("_key"))
    by = Window.partitionBy(part, "_key").orderBy("start")  # a long part's border runs, or one run
    new = F.when(F.col("start") == F.lag(F.col("start") + F.col("length")).over(by), 0).otherwise(1)
    runs = runs.withColumn("_new", new).withColumn("_run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy(part, "_key", "_run").agg(F.min("start").cast("int").alias("start"), F.sum("length").alias("length"), F.max("_total").alias("_total"))
    return (out if keep_tail else out.where(F.col("start") + F.col("length") - 1 < F.col("_total"))).select(part, "start", "length")


def gutter(profile: DataFrame, page: str, x: str, width: str, ink: str) -> DataFrame:
    """page, x: the column with the least ink in the middle fifth, the first on ties."""
    mid = profile.where((F.col(x) >= F.floor(0.4 * F.col(width))) & (F.col(x) < F.floor(0.6 * F.col(width))))
    return mid.groupBy(page).agg(F.min(F.struct(ink, x))[x].alias("x"))
