"""Rights: evidence, verdicts, manual decisions and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import collapsed


def snippet(text: Column, marker: Column) -> Column:
    """The marker and up to 90 characters after it, on one line, cut to 110."""
    return F.substring(collapsed(F.substring(text, F.instr(text, marker), F.length(marker) + 90)), 1, 110)


def evidence(text, classes: Sequence[rules.RightsClass] = rules.RIGHTS) -> Column:
    """array<struct(rule, verdict, marker, snippet)>: for each class, in order, its first marker
    that the text holds. The rule table is small and becomes expressions; no join is needed."""
    text = F.col(text) if isinstance(text, str) else text
    hits = []
    for c in classes:
        marker = F.coalesce(*(F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in c.markers))
        hits.append(F.when(marker.isNotNull(), F.struct(F.lit(c.id).alias("rule"), F.lit(c.verdict).alias("verdict"), marker.alias("marker"), snippet(text, marker).alias("snippet"))))
    return F.array_compact(F.array(*hits))


def rank(verdict) -> Column:
    out = F.lit(len(rules.VERDICTS))
    for i, v in reversed(list(enumerate(rules.VERDICTS))):
        out = F.when(F.col(verdict) == v if isinstance(verdict, str) else verdict == v, i).otherwise(out)
    return out


def strictest(hits) -> Column:
    """The hit with the strictest verdict, the earliest class on ties; null without hits."""
    ranked = F.transform(hits, lambda h, i: F.struct(rank(h["verdict"]).alias("rank"), i.alias("i"), h.alias("hit")))
    return F.array_min(ranked)["hit"]


def classify(df: DataFrame, text_col: str = "text", classes: Sequence[rules.RightsClass] = rules.RIGHTS) -> DataFrame:
    """df with hits, and verdict, rule, marker and snippet of the strictest hit; a row without
    evidence has the verdict UNKNOWN."""
    out = df.withColumn("hits", evidence(text_col, classes))
    hit = strictest(F.col("hits"))
    return out.withColumn("_hit", hit).withColumns({"verdict": F.coalesce("_hit.verdict", F.lit(rules.UNKNOWN)), "rule": F.col("_hit.rule"), "marker": F.col("_hit.marker"), "snippet": F.col("_hit.snippet")}).drop("_hit")


def coverage(df: DataFrame, verdict: str = "verdict") -> DataFrame:
    """total, determined and percent; an empty table has 0 percent."""
    known = F.count_if(F.col(verdict) != rules.UNKNOWN)
    return df.agg(F.count("*").alias("total"), known.alias("determined"), (100.0 * known / F.greatest(F.lit(1), F.count("*"))).alias("percent"))


def by_group(df: DataFrame, group: str, verdict: str = "verdict") -> DataFrame:
    """Counts of each verdict per group, as columns closed, disputed, public, undetermined."""
    n = lambda v: F.count_if(F.col(verdict) == v)
    return df.groupBy(group).agg(n(rules.CLOSED).alias("closed"), n(rules.DISPUTED).alias("disputed"), n(rules.PUBLIC).alias("public"), n(rules.UNKNOWN).alias("undetermined"))


def aliases(*zones: DataFrame) -> DataFrame:
    """current, original of the zones' rename tables; a later zone's row replaces an earlier one's."""
    every = None
    for i, z in enumerate(zones):
        z = z.select("current", "original", F.lit(i).alias("zone"))
        every = z if every is None else every.unionByName(z)
    return every.groupBy("current").agg(F.max_by("original", F.struct("zone", "original")).alias("original"))


def override(rows: DataFrame, manual: DataFrame, renamed: DataFrame, key: str = "path") -> DataFrame:
    """rows with the verdict of the manual decision (path, verdict) under their own path, else
    under the path they had before, else their own; decided_by says which."""
    own = manual.groupBy("path").agg(F.min("verdict").alias("_own")).withColumnRenamed("path", key)
    old = manual.groupBy("path").agg(F.min("verdict").alias("_old")).withColumnRenamed("path", "_original")
    out = rows.join(own, key, "left").join(renamed.select(F.col("current").alias(key), F.col("original").alias("_original")), key, "left").join(old, "_original", "left")
    by = F.when(F.col("_own").isNotNull(), "manual").when(F.col("_old").isNotNull(), "alias").otherwise("rules")
    return out.withColumns({"decided_by": by, "verdict": F.coalesce("_own", "_old", "verdict")}).drop("_own", "_old", "_original")


def unseen(rows: DataFrame, cache: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose evidence isn't cached yet; only these are worth the expensive source."""
    return rows.join(cache.select(*keys).distinct(), list(keys), "left_anti")


def evidence_text(meta: DataFrame, pages: DataFrame, key: str, page: str = "page", text: str = "text", first: int = 3, poor: int = 200) -> DataFrame:
    """key, evidence, poor: metadata (key, meta) and the text of pages 1 to first, a line end between
    them. poor: the pages have under `poor` characters but for blanks at the ends, so that only
    these are worth reading by OCR. Only the first pages are gathered, so a document's length
    doesn't count."""
    lead = pages.where((F.col(page) >= 1) & (F.col(page) <= first)).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(page, F.coalesce(text, F.lit("")).alias("t")))).alias("_p"))
    lead = lead.select(key, F.array_join(F.transform("_p", lambda p: p["t"]), "\n").alias("_text"))
    rows = meta.join(lead, key, "left").withColumn("_text", F.coalesce("_text", F.lit("")))
    return rows.select(key, F.concat_ws("\n", "meta", "_text").alias("evidence"), (F.length(F.trim("_text")) < poor).alias("poor"))


def sections(df: DataFrame, verdict: str, *keys: str) -> DataFrame:
    """Rows by section (the verdicts in their fixed order, rows without evidence last), then keys."""
    return df.withColumn("section", rank(verdict)).orderBy("section", *keys)
