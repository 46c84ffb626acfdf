"""Global order without one task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import shared

#: Rows of a range.
RANGE = 1_000_000


def numbered(df: DataFrame, *order, name: str = "position", parts: int | None = None) -> DataFrame:
    """df with its rows' places 1, 2, 3, ... in this order (rows equal in it in any). Rows go into ranges, sorted
    inside, and are written; a range's place is the number of rows in those before it, one number a range."""
    spark = df.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())  # rows that are equal in the order spread over ranges
    placed = tied.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = shared.kept(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    counts = sorted(placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect())
    before = [0, *accumulate(r["_n"] for r in counts)]
    offsets = spark.createDataFrame([(r["_part"], b) for r, b in zip(counts, before, strict=False)], "_part long, _before long")
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row per range
    return out.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).select(*df.columns, name)


def write_lines(lines: DataFrame, path: str, line: str, *order, parts: int | None = None) -> None:
    """One column as text, in global order over the part files by name: ranges are dealt and sorted, nothing is
    gathered."""
    parts = parts or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(F.col(line).alias("value")).write.mode("overwrite").text(path)
