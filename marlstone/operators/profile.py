"""What a page looks like by its pixels: ink of every row and column, lines of text, gaps, columns, the gutter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import grid


def pixels(images: DataFrame, page: str, image: str, width: str) -> DataFrame:
    """page, y, x, v of every pixel of images with one byte a pixel, row after row; a last row that isn't whole
    is left out, and so are images without pixels or width."""
    w, n = F.col(width), F.octet_length(F.col(image))
    high = F.floor(n / w).cast("long")
    rows = images.where((w > 0) & (n >= w)).select(page, F.explode(F.sequence(F.lit(0).cast("long"), high - 1)).alias("y"), width, image)
    row = F.decode(F.substring(F.col(image), (F.col("y") * w + 1).cast("int"), w.cast("int")), "ISO-8859-1")
    return rows.select(page, "y", F.posexplode(F.split(row, "")).alias("x", "_v")).select(page, "y", "x", F.ascii("_v").alias("v"))


def means(px: DataFrame, page: str, dark: int = 128) -> DataFrame:
    """page, axis (row or column), place, pixels, ink and mean of every row and every column: one pass, in which
    each task adds its pixels up before anything travels."""
    both = px.groupingSets([[F.col(page), F.col("y")], [F.col(page), F.col("x")]], F.col(page), F.col("y"), F.col("x"))
    got = both.agg(F.grouping("y").alias("_column"), F.count("*").alias("pixels"), F.count_if(F.col("v") < dark).alias("ink"))
    at = F.when(F.col("_column") == 1, F.col("x").cast("long")).otherwise(F.col("y"))
    return got.select(page, F.when(F.col("_column") == 1, "column").otherwise("row").alias("axis"), at.alias("place"), "pixels", "ink", (F.col("ink") / F.col("pixels")).alias("mean"))


def traits(profile: DataFrame, page: str) -> DataFrame:
    """page, w, h, density, lines, line_height (their median height, 0 without any), gaps and columns, from means().
    A line is a run of rows with ink above 0.35 of the mean, a gap a run of columns below 0.15 of it over more
    than 4 % of the width that ends before the last column; gaps over 6 % part columns."""
    rows, cols = profile.where("axis = 'row'"), profile.where("axis = 'column'")
    whole = rows.groupBy(page).agg(F.max("pixels").alias("w"), F.count("*").alias("h"), (F.sum("ink") / F.sum("pixels")).alias("density"))
    of = lambda part: part.join(whole.select(page, "w", "density"), page)
    lines = grid.islands(of(rows), page, "place", F.col("mean") > F.greatest(F.lit(0.002), F.col("density") * 0.35))
    lines = lines.groupBy(page).agg(F.count("*").alias("lines"), F.median("length").alias("line_height"))
    gaps = grid.islands(of(cols), page, "place", F.col("mean") < F.greatest(F.lit(0.001), F.col("density") * 0.15), keep_tail=False)
    gaps = gaps.join(whole.select(page, "w"), page).groupBy(page).agg(F.count_if(F.col("length") > F.col("w") * 0.04).alias("gaps"), F.count_if(F.col("length") > F.col("w") * 0.06).alias("_wide"))
    out = whole.join(lines, page, "left").join(gaps, page, "left")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select(page, "w", "h", text.rounded(F.col("density"), 4).alias("density"), none("lines"), F.coalesce("line_height", F.lit(0.0)).alias("line_height"), none("gaps"), (1 + F.coalesce("_wide", F.lit(0).cast("long"))).alias("columns"))


def gutters(profile: DataFrame, page: str) -> DataFrame:
    """page, x: the column with the least ink in the middle fifth of each page, the first on ties."""
    cols = profile.where("axis = 'column'").select(page, F.col("place").alias("x"), "ink")
    width = cols.groupBy(page).agg((F.max("x") + 1).alias("width"))
    return grid.gutter(cols.join(width, page), page, "x", "width", "ink")
