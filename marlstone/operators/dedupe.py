"""Exact and near duplicates by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapsed


def content_hash(c) -> Column:
    return F.sha2(c, 256)


def short_id(c) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def signature(text) -> Column:
    """Hash of the normalised text and its length; '' where that is empty."""
    norm = F.lower(collapsed(text))
    return F.when(F.coalesce(norm, F.lit("")) == "", "").otherwise(F.sha2(F.concat_ws("\n", F.concat(F.lit("txt="), F.length(norm)), F.sha2(norm, 256)), 256))


def groups(df: DataFrame, key: str, id_col: str, size_col: str) -> DataFrame:
    """Groups of two or more rows by key: key, n, first_id, wasted (bytes of all but the first).
    Null and empty keys form no group. Only sums and minima are kept, never the members."""
    found = df.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id"), F.min_by(size_col, id_col).alias("_first"))
    return found.where("n > 1").withColumn("wasted", F.col("_first") * (F.col("n") - 1)).drop("_first")


def near_groups(df: DataFrame, exact_key: str, near_key: str, id_col: str) -> DataFrame:
    """Groups by near_key that are no exact groups: equal content has equal near_key, so a group
    with one exact_key is an exact group."""
    found = df.where(F.coalesce(F.col(near_key), F.lit("")) != "").groupBy(near_key)
    return found.agg(F.count("*").alias("n"), F.min(id_col).alias("first_id"), F.count_distinct(exact_key).alias("variants")).where("variants > 1")


def members(df: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """Rows of the groups found."""
    return df.join(found.select(key), key, "left_semi")


def totals(found: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return found.agg(F.count("*").alias("groups"), zero(F.sum(F.col("n") - 1)).alias("extra_copies"), zero(F.sum("wasted")).alias("wasted"))


def page_signature(docs: DataFrame, rasters: DataFrame, key: str, first: int = 3) -> DataFrame:
    """key and signature of documents (key, pages, chars: of the text layer but for blanks at its ends), from what is
    known of these and the hashes of the rasters (key, page, image) of the first pages: documents that only
    differ in their wrapping share it. '' where fewer than two parts are known. A page with several rasters counts
    with the smallest hash."""
    one = rasters.where((F.col("page") >= 1) & (F.col("page") <= first) & F.col("image").isNotNull()).groupBy(key, "page").agg(F.min(F.sha2(F.col("image").cast("binary"), 256)).alias("_h"))
    lead = one.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("page", "_h"))).alias("_p"))  # `first` rows at most
    shown = F.transform(F.coalesce("_p", F.array().cast(lead.schema["_p"].dataType)), lambda p: F.concat(F.lit("p"), p["page"], F.lit("="), F.substring(p["_h"], 1, 32)))
    told = F.array_compact(F.array(F.concat(F.lit("pages="), F.col("pages").cast("string")), F.concat(F.lit("txt="), F.col("chars").cast("string"))))
    parts = F.concat(told, shown)
    return docs.join(lead, key, "left").select(key, F.when(F.size(parts) < 2, "").otherwise(F.sha2(F.array_join(parts, "\n"), 256)).alias("signature"))
