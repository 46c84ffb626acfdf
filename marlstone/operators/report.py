"""The inventory as a report: totals, a section per group with what is taken and what stays, duplicates. Every
line is a row with its place, so the report may be as long as the census."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a line is ordered by; larger sizes come first.
PLACE = ("section", "ord", "repo", "kind", "smaller", "digest", "key")


def mib(size) -> Column:
    """MiB with two decimals, halves up."""
    h = F.floor((F.col(size) * 200 + 1048576) / 2097152) if isinstance(size, str) else F.floor((size * 200 + 1048576) / 2097152)
    return F.concat(F.floor(h / 100).cast("string"), F.lit("."), F.lpad((h % 100).cast("string"), 2, "0"))


def _lines(rows: DataFrame, section: int, kind, line: Column, **place) -> DataFrame:
    of = {"ord": F.lit(-1), "repo": F.lit(""), "smaller": F.lit(0), "digest": F.lit(""), "key": F.lit("")} | place
    types = {"ord": "int", "repo": "string", "smaller": "long", "digest": "string", "key": "string"}
    cols = {k: F.coalesce(v.cast(types[k]), F.lit("" if types[k] == "string" else 0).cast(types[k])).alias(k) for k, v in of.items()}
    return rows.select(F.lit(section).alias("section"), cols["ord"], cols["repo"], (F.lit(kind) if isinstance(kind, int) else kind).cast("int").alias("kind"), cols["smaller"], cols["digest"], cols["key"], line.alias("line"))


def _fixed(rows: DataFrame, section: int, lines: dict[int, Column], **place) -> DataFrame:
    """Several lines of each row, by kind."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("line")) for k, v in lines.items()))).alias("l")
    return _lines(rows.select("*", each), section, F.col("l.kind"), F.col("l.line"), **place)


def inventory(files: DataFrame) -> DataFrame:
    """section, ord, repo, kind, smaller, digest, key, line, from files (repo, ord, rel, bytes, taken, reason, sha256).
    Nulls: no verdict is not taken, no size is 0, no hash is no duplicate; an empty census has no lines."""
    taken, size, text = F.coalesce("taken", F.lit(False)), F.coalesce("bytes", F.lit(0)), F.lit
    sets = files.groupingSets([[F.col("ord"), F.col("repo")], []], F.col("ord"), F.col("repo"))
    counts = sets.agg(F.grouping("repo").alias("_all"), F.count("*").alias("n"), F.count_if(taken).alias("t"), F.count_if(~taken).alias("s"), F.coalesce(F.sum(F.when(taken, size)), F.lit(0)).alias("b"))
    whole, groups = counts.where("_all = 1"), counts.where("_all = 0")
    n = lambda c: F.concat(text("**"), F.col(c).cast("string"), text("**"))
    top = _fixed(whole, 0, {0: text("# Inventory of reference material"), 1: text(""), 2: F.concat(text("Total to move: "), n("t"), text(" files, **"), mib("b"), text(" MiB**; left in place: "), n("s"), text(".")), 3: text("")})
    of = {"ord": F.col("ord"), "repo": F.col("repo")}
    head = _fixed(groups, 1, {0: F.concat(text("## "), F.coalesce(F.col("ord").cast("string"), text("—")), text(". `"), F.coalesce("repo", text("—")), text("`")), 1: text(""), 2: F.concat(text("Found: "), n("n"), text("; to move: "), n("t"), text(" ("), mib("b"), text(" MiB); left in place: "), n("s"), text(".")), 3: text(""), 4: text("| path | MiB |"), 5: text("|---|---:|"), 7: text("")}, **of)
    cell = lambda c: F.replace(F.coalesce(c, text("—")), text("|"), text("\\|"))
    rel = F.coalesce("rel", text(""))
    moved = _lines(files.where(taken), 1, 6, F.concat(text("| `"), cell(F.col("rel")), text("` | "), mib(size), text(" |")), key=rel, **of)
    rest = _fixed(groups.where("s > 0"), 1, {8: text("<details><summary>Left in place</summary>"), 9: text(""), 10: text("| path | reason |"), 11: text("|---|---|"), 13: text(""), 14: text("</details>"), 15: text("")}, **of)
    left = _lines(files.where(~taken), 1, 12, F.concat(text("| `"), cell(F.col("rel")), text("` | "), cell(F.col("reason")), text(" |")), key=rel, **of)
    path = F.concat_ws("/", "repo", "rel")
    twice = files.where(taken & F.col("sha256").isNotNull()).groupBy("sha256").agg(F.count("*").alias("n"), F.max(size).alias("b"), F.min(path).alias("first")).where("n > 1")
    sums = twice.agg(F.count("*").alias("g"), F.sum(F.col("n") - 1).alias("e"), F.sum(F.col("b") * (F.col("n") - 1)).alias("w")).where("g > 0")
    about = _fixed(sums, 2, {0: text("## Duplicates"), 1: text(""), 2: F.concat(text("**Equal to the byte:** "), F.col("g").cast("string"), text(" groups, "), F.col("e").cast("string"), text(" extra copies, "), mib("w"), text(" MiB wasted.")), 3: text("")})
    members = files.where(taken).select("sha256", path.alias("path")).join(twice, "sha256")
    lead = F.when(F.col("path") == F.col("first"), F.concat(text("* "), mib("b"), text(" MiB — `"))).otherwise(text("  * `"))
    copies = _lines(members, 2, 4, F.concat(lead, F.col("path"), text("`")), smaller=-F.col("b"), digest=F.col("sha256"), key=F.col("path"))
    out = top
    for part in (head, moved, rest, left, about, copies):
        out = out.unionByName(part)
    return out
