"""The gate in front of a publication boundary: paths, content, eligibility, rights, coverage."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import rules


#: A boundary, if it can be with the word it stands before, or before a group of words.
_EDGE = re.compile(r"\\b(?:(?P<word>\w+)(?![*+?{])|(?P<group>(?=\((?:\w[^|()]*\|)*\w[^|()]*\))))|\\b")


def _edge(m: re.Match) -> str:
    """The same places by ASCII; after a word, where it costs least."""
    if m["word"]:
        return rf"{m['word']}(?<!\w{m['word']})"
    return r"(?<!\w)" if m["group"] is not None else r"(?:(?<!\w)(?=\w)|(?<=\w)(?!\w))"


def _pattern(p: str) -> str:
    """A rule's pattern with the same meaning in Java: words, blanks and lines by ASCII alone (Java takes letters of all
    alphabets as words next to \\b, and more than line feeds as ends of lines), case by Unicode."""
    p = _EDGE.sub(_edge, p.replace("(?i)", "(?iu)").replace("(?m)", "(?dm)"))
    blanks = re.sub(r"(\[\^?(?:[^\]\\]|\\[^s])*)\\s", r"\1\\t\\n\\f\\r ", p)
    return re.sub(r"\$(?=$|[|)])", r"\\z", blanks.replace(r"\s", r"[\t\n\f\r ]"))


#: Why a file isn't scanned, see skip_reason().
SKIPPED = ("missing", "not text", "too large")


def forbidden_path(path, table: Sequence[tuple[str, str]] = rules.PATHS) -> Column:
    """Name of the first path rule that matches, or null."""
    return F.coalesce(*(F.when(F.rlike(path, F.lit(_pattern(p))), F.lit(name)) for name, p in table))


def forbidden_content(text, own_file: Column | None = None, table: Sequence[tuple[str, str, bool]] = rules.CONTENT) -> Column:
    """Names of all content rules that match; transcript markup is no violation in own files."""
    own = F.lit(False) if own_file is None else own_file
    return F.array_compact(F.array(*(F.when(F.rlike(text, F.lit(_pattern(p))) & (~own if markup else F.lit(True)), F.lit(name)) for name, p, markup in table)))


def skip_reason(path, size, text, most: int = rules.MAX_SCAN, extensions: Sequence[str] = rules.TEXT_EXTENSIONS) -> Column:
    """Why content isn't scanned: missing, no text extension, too large; null where it is."""
    ext = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    return F.when(text.isNull(), "missing").when(~ext.isin(*extensions), "not text").when(size > most, "too large")


def rights_hold(rows: DataFrame, roots: Sequence[str], path: str = "path", verdict: str = "verdict") -> DataFrame:
    """Rows under the material roots whose verdict isn't public; no verdict is held as well.
    Pointer files are exempt."""
    inside = F.exists(F.array(*map(F.lit, roots)), lambda r: F.startswith(path, r))
    return rows.where(inside & ~F.endswith(path, F.lit(".pointer.md")) & ~F.col(verdict).eqNullSafe(rules.PUBLIC))


def decided(rows: DataFrame, renames: DataFrame, decisions: DataFrame, verdicts: DataFrame, path: str = "path") -> DataFrame:
    """rows with the path they had before a rename (renames: current, original), and under it the
    author's decision (path, verdict), else the verdict of the analysis, else UNKNOWN."""
    named = rows.join(renames.select(F.col("current").alias(path), "original"), path, "left").withColumn("former", F.coalesce("original", path)).drop("original")
    one = lambda t, name: t.groupBy(F.col("path").alias("former")).agg(F.min("verdict").alias(name))
    out = named.join(one(decisions, "_decision"), "former", "left").join(one(verdicts, "_verdict"), "former", "left")
    return out.withColumn("verdict", F.coalesce("_decision", "_verdict", F.lit(rules.UNKNOWN))).withColumn("decided", F.col("_decision").isNotNull()).drop("_decision", "_verdict")


def violations(rows: DataFrame, path: str, text: str, id_col: str) -> DataFrame:
    """id, kind, rule: path and content violations together; with rights_violations() all kinds."""
    by_path = rows.select(id_col, F.lit("path").alias("kind"), forbidden_path(path).alias("rule")).where("rule is not null")
    by_text = rows.select(id_col, F.lit("content").alias("kind"), F.explode(forbidden_content(text)).alias("rule"))
    return by_path.unionByName(by_text)


def rights_violations(rows: DataFrame, roots: Sequence[str], id_col: str, path: str = "path", verdict: str = "verdict") -> DataFrame:
    """id, kind, rule of the rows that the rights rule holds back; the rule is their verdict."""
    return rights_hold(rows, roots, path, verdict).select(id_col, F.lit("rights").alias("kind"), F.coalesce(verdict, F.lit(rules.UNKNOWN)).alias("rule"))


def scan_coverage(rows: DataFrame, reason: str = "skip_reason") -> DataFrame:
    """status (scanned or the reason), n, and the share of all rows in percent. The total joins as
    one row."""
    by = rows.groupBy(F.coalesce(F.col(reason), F.lit("scanned")).alias("status")).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("_total"))
    return by.join(F.broadcast(total)).select("status", "n", (100.0 * F.col("n") / F.greatest(F.lit(1), F.col("_total"))).alias("percent"))


def written(rows: DataFrame, path: str, reason: str = "skip_reason") -> DataFrame:
    """scan_coverage() of the rows, counted in the pass that writes those that were scanned, as Parquet."""
    obs = Observation()
    of = lambda s: F.count_if(F.col(reason) == s)
    counts = [F.count_if(F.col(reason).isNull()).alias("scanned"), *(of(s).alias(s) for s in SKIPPED), F.count("*").alias("total")]
    rows.observe(obs, *counts).where(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(path)
    got = obs.get
    found = [(s, got[s], 100.0 * got[s] / got["total"]) for s in ("scanned", *SKIPPED) if got[s]]
    return rows.sparkSession.createDataFrame(found, "status string, n long, percent double")


def staged(listing: Column) -> Column:
    """Paths of a NUL-separated listing."""
    return F.filter(F.split(listing, "\\x00"), lambda p: p != "")


def changed(listing: Column, states: str = "ACMR") -> Column:
    """Paths of a NUL-separated listing of state, path, state, path ... whose state is one of these."""
    parts = F.split(listing, "\\x00")
    pairs = F.transform(F.filter(parts, lambda p, i: i % 2 == 1), lambda p, i: F.struct(F.get(parts, 2 * i).alias("state"), p.alias("path")))
    return F.transform(F.filter(pairs, lambda x: (x["path"] != "") & F.contains(F.lit(states), F.substring(x["state"], 1, 1))), lambda x: x["path"])


def event_paths(event: Column) -> Column:
    """File paths that a JSON event names."""
    return F.array_compact(F.array(*(F.get_json_object(event, f"$.tool_input.{k}") for k in ("file_path", "path", "notebook_path"))))
