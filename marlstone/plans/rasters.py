"""Queries over pixels. The bytes of a page's html, WIDE to a row, stand for its raster."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assembly, dedupe, encode, grid, profile
from .corpus import query, table

WIDE, TILE, OVERLAP, BELOW = 64, 24, 8, 24.0

#: Tiles of every raster of at least a row: page_id, tile, x, y, w, h, and px, the raster as a list of numbers.
_IMAGES = f"i AS (SELECT page_id, hex(encode(html)) AS x, strlen(html) // {WIDE} AS ih FROM pages WHERE strlen(html) >= {WIDE}), img AS (SELECT page_id, ih, list_transform(range({WIDE} * ih), lambda k: ('0x' || substr(x, 2 * k + 1, 2))::INTEGER) AS px FROM i)"
_STARTS = lambda c: f"CASE WHEN {c} <= {TILE} THEN [0] ELSE list_append(range(0, CAST(ceil(({c} - {TILE}) / {TILE - OVERLAP}.0) AS BIGINT) * {TILE - OVERLAP}, {TILE - OVERLAP}), {c} - {TILE}) END"
_TILES = f"""{_IMAGES}, st AS (SELECT *, {_STARTS(WIDE)} AS xs, {_STARTS("ih")} AS ys FROM img), rw AS (SELECT *, unnest(range(len(ys))) AS r FROM st), cl AS (SELECT *, unnest(range(len(xs))) AS c FROM rw),
t AS (SELECT page_id, px, r * len(xs) + c AS tile, xs[c + 1] AS x, ys[r + 1] AS y, least({TILE}, {WIDE} - xs[c + 1]) AS w, least({TILE}, ih - ys[r + 1]) AS h FROM cl)"""
_STRIP = lambda h, w, y0, x0: f"list_transform(range({h} * {w}), lambda k: px[({y0} + k // {w}) * {WIDE} + {x0} + k % {w} + 1])"
_ACROSS, _DOWN = f"least({OVERLAP}, w)", f"least({OVERLAP}, h)"
_JOINTS = f"""WITH {_TILES},
s AS (SELECT page_id, tile, x, y, 'right' AS axis, h AS sh, {_ACROSS} AS sw, {_STRIP("h", _ACROSS, "y", f"(x + w - {_ACROSS})")} AS lead, {_STRIP("h", _ACROSS, "y", "x")} AS follow FROM t
  UNION ALL SELECT page_id, tile, x, y, 'down', {_DOWN}, w, {_STRIP(_DOWN, "w", f"(y + h - {_DOWN})", "x")}, {_STRIP(_DOWN, "w", "y", "x")} FROM t),
p AS (SELECT a.page_id, a.axis, a.tile AS id, b.tile AS match, list_sum(list_transform(list_zip(a.lead, b.follow), lambda z: abs(z[1] - z[2])))::DOUBLE / len(a.lead) AS cost
  FROM s a JOIN s b ON a.page_id = b.page_id AND a.axis = b.axis AND a.tile <> b.tile AND a.sh = b.sh AND a.sw = b.sw),
m AS (SELECT page_id, axis, id, min_by(match, (cost, match)) AS match, min(cost) AS cost FROM p WHERE cost < {BELOW} GROUP BY 1, 2, 3),
j AS (SELECT s.page_id, s.axis, s.tile AS id, m.match, m.cost FROM s LEFT JOIN m ON m.page_id = s.page_id AND m.axis = s.axis AND m.id = s.tile) """


def _rasters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("image"))
    return pages.where(F.octet_length("image") >= WIDE).withColumn("ih", F.expr(f"octet_length(image) div {WIDE}")).withColumn("iw", F.lit(WIDE).cast("long"))


def _grid(spark, sf_dir, image=None):
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pages = _rasters(spark, sf_dir).repartition(tasks, "page_id")  # a file of one row group is one task, however many pages it holds
    return grid.overlap_grid(pages, "iw", "ih", TILE, OVERLAP, image)


def _joints(spark, sf_dir):
    tiles = _grid(spark, sf_dir, "image")
    tiles = tiles.select("page_id", "tile", assembly.cut(F.col("lines"), F.col("iw"), F.col("x"), F.lit(0), F.col("w"), F.col("h")).alias("rows"))
    return assembly.joints(tiles, "page_id", "tile", "rows", OVERLAP, BELOW, _grid(spark, sf_dir).select("page_id", (F.col("w") * F.col("h")).alias("bytes")))


@query(_JOINTS + "SELECT page_id, axis, CAST(id AS BIGINT) AS id, CAST(match AS BIGINT) AS match, cost FROM j")
def kit_joints(spark, sf_dir):
    """Of every tile of every page the tiles that continue it to the right and down, by overlap alone."""
    return _joints(spark, sf_dir).select(F.col("kit").alias("page_id"), "axis", "id", "match", "cost")


@query(
    _JOINTS
    + """SELECT j.axis, count(j.match) AS found, count(*) FILTER (CASE WHEN j.axis = 'right' THEN a.y = b.y AND b.x > a.x ELSE a.x = b.x AND b.y > a.y END) AS correct, count(*) FILTER (j.cost = 0) AS exact
FROM j JOIN t a ON a.page_id = j.page_id AND a.tile = j.id LEFT JOIN t b ON b.page_id = j.page_id AND b.tile = j.match GROUP BY 1"""
)
def kit_joint_quality(spark, sf_dir):
    """How many joints were found, are right by the tiles' places, and hold to the byte, on each axis."""
    return assembly.joint_quality(_joints(spark, sf_dir), _grid(spark, sf_dir).select(F.col("page_id").alias("kit"), F.col("tile").cast("long").alias("id"), "x", "y"))


# ---- profiles ------------------------------------------------------------------------------------

DARK = 47  # blanks and marks count as ink
_PIXELS = f"WITH {_IMAGES}, px AS (SELECT page_id, generate_subscripts(px, 1) - 1 AS k, unnest(px) AS v FROM img), m AS (SELECT page_id, CASE WHEN grouping(k // {WIDE}) = 1 THEN 'column' ELSE 'row' END AS axis, coalesce(k // {WIDE}, k % {WIDE}) AS place, count(*) AS pixels, count(*) FILTER (v < {DARK}) AS ink FROM px GROUP BY GROUPING SETS ((page_id, k // {WIDE}), (page_id, k % {WIDE})))"


def _profile(spark, sf_dir):
    return profile.means(profile.pixels(_rasters(spark, sf_dir), "page_id", "image", "iw"), "page_id", DARK)


@query(_PIXELS + " SELECT page_id, axis, CAST(place AS BIGINT) AS place, pixels, ink, ink / pixels::DOUBLE AS mean FROM m")
def ink_profile(spark, sf_dir):
    """Ink of every row and column of every page."""
    return _profile(spark, sf_dir)


@query(
    _PIXELS
    + """, p AS (SELECT page_id, CAST(max(pixels) AS BIGINT) AS w, count(*) AS h, CAST(sum(ink) AS BIGINT) / CAST(sum(pixels) AS BIGINT)::DOUBLE AS density FROM m WHERE axis = 'row' GROUP BY 1),
f AS (SELECT m.page_id, axis, place, CASE axis WHEN 'row' THEN ink / pixels::DOUBLE > greatest(0.002::DOUBLE, density * 0.35::DOUBLE) ELSE ink / pixels::DOUBLE < greatest(0.001::DOUBLE, density * 0.15::DOUBLE) END AS on_, max(place) OVER (PARTITION BY m.page_id, axis) AS last FROM m JOIN p USING (page_id)),
o AS (SELECT *, place - row_number() OVER (PARTITION BY page_id, axis ORDER BY place) AS run FROM f WHERE on_),
r AS (SELECT page_id, axis, count(*) AS n, max(place) = max(last) AS tail FROM o GROUP BY page_id, axis, run)
SELECT p.page_id, w, h, round(density, 4) AS density, count(r.n) FILTER (axis = 'row') AS lines, coalesce(median(r.n) FILTER (axis = 'row'), 0)::DOUBLE AS line_height,
  count(r.n) FILTER (axis = 'column' AND NOT tail AND n > w * 0.04::DOUBLE) AS gaps, 1 + count(r.n) FILTER (axis = 'column' AND NOT tail AND n > w * 0.06::DOUBLE) AS columns
FROM p LEFT JOIN r USING (page_id) GROUP BY ALL"""
)
def page_traits(spark, sf_dir):
    """Lines of text, their height, gaps and columns of every page, from its ink."""
    return profile.traits(_profile(spark, sf_dir), "page_id")


@query(_PIXELS + f" SELECT page_id, CAST(min_by(place, (ink, place)) AS BIGINT) AS x FROM m WHERE axis = 'column' AND place >= floor(0.4::DOUBLE * {WIDE}) AND place < floor(0.6::DOUBLE * {WIDE}) GROUP BY 1")
def page_gutters(spark, sf_dir):
    return profile.gutters(_profile(spark, sf_dir), "page_id")


# ---- encodings -----------------------------------------------------------------------------------


@query()
def smallest_page_png(spark, sf_dir):
    """Of every page's raster, reduced to an overview, the smallest of its encodings."""
    rows = _rasters(spark, sf_dir).withColumn("image", F.substring("image", 1, (F.col("ih") * WIDE).cast("int")))
    best = encode.smallest(encode.encodings(rows, "page_id", "image", "iw", most=128), "page_id")
    return best.select("page_id", "mode", "w", "h", "bytes", F.crc32("png").alias("png_crc32"))


# ---- signatures ----------------------------------------------------------------------------------


@query("""WITH x AS (SELECT conv_id, CAST(turn + 1 AS BIGINT) AS page, text FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT conv_id, nullif(count(*), 1) AS pages, nullif(CAST(sum(length(trim(text))) FILTER (page > 1) AS BIGINT), 0) AS chars FROM x GROUP BY 1),
r AS (SELECT conv_id, page, min(sha256(text)) AS h FROM x WHERE page BETWEEN 1 AND 3 AND text IS NOT NULL GROUP BY 1, 2),
p AS (SELECT conv_id, list('p' || page || '=' || left(h, 32) ORDER BY page) AS shown FROM r GROUP BY 1),
s AS (SELECT conv_id, list_concat(list_filter(['pages=' || pages, 'txt=' || chars], lambda v: v IS NOT NULL), coalesce(shown, [])) AS parts FROM d LEFT JOIN p USING (conv_id))
SELECT conv_id, CASE WHEN len(parts) < 2 THEN '' ELSE sha256(array_to_string(parts, chr(10))) END AS signature FROM s""")
def page_signatures(spark, sf_dir):
    """Signatures of dialogues taken as documents of a page a turn; a single page's number isn't known."""
    x = table(spark, sf_dir, "conversations").where("conv_id is not null").select("conv_id", (F.col("turn") + 1).alias("page"), "text")
    n = F.sum(F.when(F.col("page") > 1, F.length(F.trim("text"))))
    docs = x.groupBy("conv_id").agg(F.nullif(F.count("*"), F.lit(1)).alias("pages"), F.nullif(n, F.lit(0)).alias("chars"))
    return dedupe.page_signature(docs, x.select("conv_id", "page", F.col("text").alias("image")), "conv_id")
