"""Reports in order, lookups with many bounds, and what is counted while writing. Places are numbers here, so that
a comparison that sorts rows still sees the order."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import shared
from ..functions import rules
from ..operators import census, classify, fold, gate, order, report
from .corpus import _CLASSIFIED, _FILES, _classified, _files, _oracles, _q, exact_duplicate_groups, query, table

_MIB = lambda b: f"((({b}) * 200 + 1048576) // 2097152 // 100) || '.' || lpad(CAST((({b}) * 200 + 1048576) // 2097152 % 100 AS VARCHAR), 2, '0')"
_REPORT = f"""WITH f AS (SELECT source AS repo, CAST(substr(source, 4) AS INTEGER) AS ord, lang || '/' || doc_id || '.txt' AS rel, CAST(strlen(text) AS BIGINT) AS bytes, lang IN ('en', 'fr') AS taken, CASE WHEN lang = 'de' THEN 'excluded' ELSE 'outside' END AS reason, sha256(text) AS sha FROM documents WHERE text IS NOT NULL),
g AS (SELECT ord, repo, count(*) AS n, count(*) FILTER (taken) AS t, count(*) FILTER (NOT coalesce(taken, false)) AS s, CAST(coalesce(sum(bytes) FILTER (taken), 0) AS BIGINT) AS b FROM f GROUP BY 1, 2),
w AS (SELECT CAST(sum(t) AS BIGINT) AS t, CAST(sum(s) AS BIGINT) AS s, CAST(sum(b) AS BIGINT) AS b FROM g),
d AS (SELECT sha, count(*) AS n, max(bytes) AS b, min(repo || '/' || rel) AS first FROM f WHERE taken GROUP BY 1 HAVING count(*) > 1),
x AS (SELECT count(*) AS g, CAST(sum(n - 1) AS BIGINT) AS e, CAST(sum(b * (n - 1)) AS BIGINT) AS w FROM d HAVING count(*) > 0),
l AS (
SELECT 0 AS section, -1 AS ord, '' AS repo, unnest([0, 1, 2, 3]) AS kind, 0 AS smaller, '' AS digest, '' AS key, unnest(['# Inventory of reference material', '', 'Total to move: **' || t || '** files, **' || {_MIB("b")} || ' MiB**; left in place: **' || s || '**.', '']) AS line FROM w
UNION ALL SELECT 1, ord, repo, unnest([0, 1, 2, 3, 4, 5, 7]), 0, '', '', unnest(['## ' || ord || '. `' || repo || '`', '', 'Found: **' || n || '**; to move: **' || t || '** (' || {_MIB("b")} || ' MiB); left in place: **' || s || '**.', '', '| path | MiB |', '|---|---:|', '']) FROM g
UNION ALL SELECT 1, ord, repo, 6, 0, '', rel, '| `' || rel || '` | ' || {_MIB("bytes")} || ' |' FROM f WHERE taken
UNION ALL SELECT 1, ord, repo, unnest([8, 9, 10, 11, 13, 14, 15]), 0, '', '', unnest(['<details><summary>Left in place</summary>', '', '| path | reason |', '|---|---|', '', '</details>', '']) FROM g WHERE s > 0
UNION ALL SELECT 1, ord, repo, 12, 0, '', coalesce(rel, ''), '| `' || coalesce(rel, '—') || '` | ' || reason || ' |' FROM f WHERE NOT coalesce(taken, false)
UNION ALL SELECT 2, -1, '', unnest([0, 1, 2, 3]), 0, '', '', unnest(['## Duplicates', '', '**Equal to the byte:** ' || g || ' groups, ' || e || ' extra copies, ' || {_MIB("w")} || ' MiB wasted.', '']) FROM x
UNION ALL SELECT 2, -1, '', 4, -d.b, d.sha, repo || '/' || rel, CASE WHEN repo || '/' || rel = d.first THEN '* ' || {_MIB("d.b")} || ' MiB — `' ELSE '  * `' END || repo || '/' || rel || '`' FROM f JOIN d USING (sha) WHERE taken)
SELECT row_number() OVER (ORDER BY section, ord, repo, kind, smaller, digest, key) AS position, line FROM l"""


@query(_REPORT)
def inventory_report(spark, sf_dir):
    """The lines of the report over all documents, with their places."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    files = docs.select(F.col("source").alias("repo"), F.expr("cast(substr(source, 4) as int)").alias("ord"), F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("rel"), F.octet_length("text").cast("long").alias("bytes"), F.col("lang").isin("en", "fr").alias("taken"), F.when(F.col("lang") == "de", "excluded").otherwise("outside").alias("reason"), F.sha2("text", 256).alias("sha256"))
    return order.numbered(report.inventory(files), *report.PLACE).select("position", "line")


# ---- orders --------------------------------------------------------------------------------------


@query("SELECT row_number() OVER (ORDER BY url, page_id) AS position, page_id, url FROM pages")
def files_in_order(spark, sf_dir):
    """By path, in the order of code points."""
    return order.numbered(table(spark, sf_dir, "pages").select("page_id", "url"), "url", "page_id").select("position", "page_id", "url")


_RULES = [(i, s) for i, s in enumerate(sorted((f"src{k}" for k in range(20)), key=lambda s: s[::-1]))]


@query(f"SELECT row_number() OVER (ORDER BY r.place, d.lang, d.doc_id) AS position, d.doc_id, CAST(r.place AS INTEGER) AS place FROM documents d JOIN (VALUES {', '.join(f'({i}, {_q(s)})' for i, s in _RULES)}) r(place, include) ON starts_with(d.source || '/', r.include || '/')")
def files_in_rule_order(spark, sf_dir):
    """Files under what each rule includes, in the order of the rules, then by path."""
    given = spark.createDataFrame(_RULES, "place int, include string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    rows = docs.join(F.broadcast(given), F.startswith(F.concat("source", F.lit("/")), F.concat("include", F.lit("/"))))  # one row per rule
    return order.numbered(rows, "place", "lang", "doc_id").select("position", "doc_id", "place")


@query("""WITH h AS (SELECT doc_id, sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE text IS NOT NULL),
g AS (SELECT sha256, count(*) AS n, min(doc_id) AS first_id, CAST(min_by(bytes, doc_id) * (count(*) - 1) AS BIGINT) AS wasted FROM h GROUP BY 1 HAVING count(*) > 1)
SELECT row_number() OVER (ORDER BY wasted DESC, sha256) AS position, * FROM g""")
def duplicates_in_order(spark, sf_dir):
    """Groups of copies, the largest waste first."""
    return order.numbered(exact_duplicate_groups(spark, sf_dir), F.desc("wasted"), "sha256").select("position", "sha256", "n", "first_id", "wasted")


_RANK = f"CASE verdict {' '.join(f'WHEN {_q(v)} THEN {i}' for i, v in enumerate(rules.VERDICTS))} ELSE {len(rules.VERDICTS)} END"


@query(_CLASSIFIED + f"SELECT row_number() OVER (ORDER BY {_RANK}, source, doc_id) AS position, verdict, source, doc_id FROM rows_")
def sections_in_order(spark, sf_dir):
    """Rows by verdict in its fixed order, then source and id."""
    rows = _classified(spark, sf_dir).select("verdict", "source", "doc_id")
    return order.numbered(rows, classify.rank("verdict"), "source", "doc_id").select("position", "verdict", "source", "doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS place FROM documents")
def shuffled_places(spark, sf_dir):
    """The place of every document in a seeded shuffle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat_ws("|", F.lit(7), "doc_id").cast("binary")).alias("k"))
    return order.numbered(docs, "k", "doc_id", name="place").select("doc_id", "place")


# ---- lookups, gates, filters ---------------------------------------------------------------------


@query("""WITH b AS (SELECT o_totalprice AS bound, max(o_orderkey) AS name FROM orders GROUP BY 1)
SELECT l_orderkey, l_linenumber, CAST(b.name AS VARCHAR) AS name FROM lineitem l ASOF LEFT JOIN b ON l.l_extendedprice * 4 >= b.bound""")
def lookup_many_bounds(spark, sf_dir):
    """For every order line the order with the highest price that four times its own reaches: as many bounds
    as there are prices."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_totalprice").alias("bound")).agg(F.max("o_orderkey").cast("string").alias("name"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 4).alias("price"))
    return census.as_of(lines, "price", orders).select("l_orderkey", "l_linenumber", "name")


@query(_oracles["gate_coverage"])
def gate_coverage_written(spark, sf_dir):
    """The coverage of gate_coverage, counted while the files that pass are written."""
    rows = _files(spark, sf_dir).withColumn("skip_reason", gate.skip_reason("path", F.col("bytes"), F.col("text")))
    return gate.written(rows, shared.fresh(spark, "gated"))


@query(f"WITH {_FILES}, w AS (SELECT doc_id, len(list_filter(string_split_regex(text, '[\\s\\x0B]+'), lambda w: w <> '')) AS tokens FROM files WHERE text IS NOT NULL AND length(text) > 400) SELECT doc_id, CAST(tokens AS BIGINT) AS tokens FROM w WHERE tokens >= 96")
def probe_answers(spark, sf_dir):
    """Answers long enough for the leak probe: over 400 characters, and words for its prompt and what follows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("assistant").alias("role"), F.filter(F.split("text", r"[\s\x0B]+"), lambda w: w != "").alias("tokens"))
    return fold.probes(docs, "tokens").select("doc_id", F.size("tokens").cast("long").alias("tokens"))


@query("""WITH p AS (SELECT conv_id, count(*) AS total, count(*) FILTER (role = 'assistant') AS step, CAST(sum(length(text)) AS BIGINT) AS seconds FROM conversations GROUP BY 1)
SELECT conv_id, seconds / greatest(1, step)::DOUBLE AS per_step, seconds / greatest(1, step)::DOUBLE * (total - step) AS left_s, CAST(100 * step // greatest(1, total) AS BIGINT) AS percent FROM p""")
def run_progress(spark, sf_dir):
    """Seconds a step, seconds left and percent done of runs (a conversation each)."""
    p = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("total"), F.count_if(F.col("role") == "assistant").alias("step"), F.sum(F.length("text")).alias("seconds"))
    return p.select("conv_id", *(c.alias(k) for k, c in census.progress(F.col("step"), F.col("total"), F.col("seconds").cast("double")).items()))


# ---- plans over whole tables: zones, renames and decisions from real columns -------------------------

_DECIDED = f"CASE WHEN toxic = 1 THEN '{rules.CLOSED}' WHEN quality = 1 THEN '{rules.PUBLIC}' ELSE '{rules.DISPUTED}' END"


@query(
    _CLASSIFIED
    + f""", m AS (SELECT CASE WHEN d.lang = 'en' THEN 'old/' ELSE '' END || d.source || '/' || d.doc_id AS path, {_DECIDED} AS verdict FROM labels l JOIN documents d USING (doc_id)),
p AS (SELECT r.doc_id, r.verdict, r.source || '/' || r.doc_id AS path, CASE WHEN d.lang = 'en' THEN 'old/' || r.source || '/' || r.doc_id END AS former FROM rows_ r JOIN documents d USING (doc_id))
SELECT p.doc_id, coalesce(a.verdict, b.verdict, p.verdict) AS verdict, CASE WHEN a.path IS NOT NULL THEN 'manual' WHEN b.path IS NOT NULL THEN 'alias' ELSE 'rules' END AS decided_by FROM p LEFT JOIN m a ON a.path = p.path LEFT JOIN m b ON b.path = p.former"""
)
def decisions_over_rules(spark, sf_dir):
    """All labels as decisions, those of English documents under the names they had before."""
    docs = table(spark, sf_dir, "documents")
    path, old = F.concat("source", F.lit("/"), "doc_id"), F.concat(F.lit("old/"), "source", F.lit("/"), "doc_id")
    verdict = F.when(F.col("toxic") == 1, rules.CLOSED).when(F.col("quality") == 1, rules.PUBLIC).otherwise(rules.DISPUTED)
    manual = table(spark, sf_dir, "labels").join(docs, "doc_id").select(F.when(F.col("lang") == "en", old).otherwise(path).alias("path"), verdict.alias("verdict"))
    renamed = docs.where("lang = 'en'").select(path.alias("current"), old.alias("original"))
    return classify.override(_classified(spark, sf_dir).select("doc_id", "verdict", path.alias("path")), manual, renamed).select("doc_id", "verdict", "decided_by")


@query(_CLASSIFIED + f""", z AS (SELECT doc_id, CASE quality WHEN 1 THEN 'public' ELSE 'private' END AS zone FROM labels)
SELECT doc_id, verdict, zone, CASE WHEN verdict = '{rules.PUBLIC}' THEN 'public' ELSE 'private' END AS zone_wanted FROM rows_ JOIN z USING (doc_id) WHERE (zone = 'public') <> (verdict = '{rules.PUBLIC}')""")
def misplaced_by_label(spark, sf_dir):
    """Documents in another zone than their verdict asks for, in zones by the quality label; those without a label
    are nowhere."""
    zone = F.when(F.col("quality") == 1, "public").otherwise("private")
    located = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", zone.alias("zone")), "doc_id", "left")
    return census.misplaced(_classified(spark, sf_dir).select("doc_id", "verdict"), located, ["doc_id"]).select("doc_id", "verdict", "zone", "zone_wanted")


@query(
    _CLASSIFIED
    + f"""SELECT r.source || '/' || r.doc_id AS path, CASE WHEN d.lang = 'de' THEN 'new/' || r.doc_id ELSE r.source || '/' || r.doc_id END AS now, CAST(strlen(r.text) AS BIGINT) AS bytes, sha256(r.text) AS sha256
FROM rows_ r JOIN documents d USING (doc_id) WHERE r.verdict <> '{rules.UNKNOWN}'"""
)
def pointers_of_determined(spark, sf_dir):
    """Pointers for all documents with a verdict, the German ones under new names."""
    docs = table(spark, sf_dir, "documents")
    path, new = F.concat("source", F.lit("/"), "doc_id"), F.concat(F.lit("new/"), "doc_id")
    rights = _classified(spark, sf_dir).where(F.col("verdict") != rules.UNKNOWN).select(path.alias("path"))
    renames = docs.where("lang = 'de'").select(path.alias("original"), new.alias("current"))
    existing = docs.select(F.when(F.col("lang") == "de", new).otherwise(path).alias("path"))
    known = docs.select(path.alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    return census.pointers(rights, renames, existing, known).select("path", "now", "bytes", "sha256")
