"""The reference's operators over the driver's tables: a query each, and its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules, text
from ..operators import census, classify, dedupe, fold, gate, grid
from ..sources import marks as pdf_marks

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function as a query of its own name, with its oracle."""

    def add(f):
        _queries[f.__name__] = f
        if sql is not None:
            _oracles[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


# ---- rights ----------------------------------------------------------------------------------

_CLASSES = rules.RIGHTS + rules.LICENCE
_q = lambda s: "'" + s.replace("'", "''") + "'"


def _marker_sql(c: rules.RightsClass) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN contains(text, {_q(m)}) THEN {_q(m)} END" for m in c.markers) + ")"


#: doc_id, source, rule, verdict, marker, rank, place of every hit.
_HITS = " UNION ALL ".join(f"SELECT doc_id, source, text, {_q(c.id)} AS rule, {_q(c.verdict)} AS verdict, {rules.VERDICTS.index(c.verdict)} AS rk, {i} AS place, {_marker_sql(c)} AS marker FROM documents" for i, c in enumerate(_CLASSES))
_CLASSIFIED = f"""
WITH hits AS (SELECT * FROM ({_HITS}) WHERE marker IS NOT NULL),
best AS (SELECT doc_id, min_by(verdict, rk * 100 + place) AS verdict, min_by(rule, rk * 100 + place) AS rule, min_by(marker, rk * 100 + place) AS marker FROM hits GROUP BY 1),
rows_ AS (SELECT d.doc_id, d.source, d.text, coalesce(b.verdict, '{rules.UNKNOWN}') AS verdict, b.rule, b.marker FROM documents d LEFT JOIN best b USING (doc_id))
"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(table(spark, sf_dir, "documents"), classes=_CLASSES)


@query(_CLASSIFIED + "SELECT verdict, count(*) AS documents FROM rows_ GROUP BY 1")
def rights_verdict_counts(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("verdict").agg(F.count("*").alias("documents"))


@query(_CLASSIFIED + f"SELECT count(*) AS total, count(*) FILTER (verdict <> '{rules.UNKNOWN}') AS determined, 100.0::DOUBLE * count(*) FILTER (verdict <> '{rules.UNKNOWN}') / greatest(1, count(*)) AS percent FROM rows_")
def rights_coverage(spark, sf_dir):
    return classify.coverage(_classified(spark, sf_dir))


_SNIPPET = "left(trim(regexp_replace(substr(text, instr(text, marker), length(marker) + 90), '\\s+', ' ', 'g')), 110)"


@query(f"WITH hits AS (SELECT * FROM ({_HITS}) WHERE marker IS NOT NULL) SELECT doc_id, rule, verdict, marker, {_SNIPPET} AS snippet FROM hits")
def rights_evidence_snippet(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(classify.evidence("text", _CLASSES)).alias("h")).select("doc_id", "h.*")


@query(_CLASSIFIED + f"SELECT source, count(*) FILTER (verdict = '{rules.CLOSED}') AS closed, count(*) FILTER (verdict = '{rules.DISPUTED}') AS disputed, count(*) FILTER (verdict = '{rules.PUBLIC}') AS public, count(*) FILTER (verdict = '{rules.UNKNOWN}') AS undetermined FROM rows_ GROUP BY 1")
def verdict_by_source(spark, sf_dir):
    return classify.by_group(_classified(spark, sf_dir), "source")


def _path(prefix: str = ""):
    return F.concat(F.lit(prefix), F.col("source"), F.lit("/"), F.col("doc_id"))


@query(
    _CLASSIFIED
    + f""", manual AS (SELECT CASE WHEN l.doc_id % 2 = 0 THEN 'old/' ELSE '' END || d.source || '/' || d.doc_id AS path,
                CASE WHEN toxic = 1 THEN '{rules.CLOSED}' WHEN quality = 1 THEN '{rules.PUBLIC}' ELSE '{rules.DISPUTED}' END AS verdict
         FROM labels l JOIN documents d USING (doc_id) WHERE l.doc_id % 3 <> 0)
SELECT r.doc_id, coalesce(a.verdict, b.verdict, r.verdict) AS verdict,
       CASE WHEN a.path IS NOT NULL THEN 'manual' WHEN b.path IS NOT NULL THEN 'alias' ELSE 'rules' END AS decided_by
FROM rows_ r LEFT JOIN manual a ON a.path = r.source || '/' || r.doc_id
LEFT JOIN manual b ON r.doc_id % 4 = 0 AND b.path = 'old/' || r.source || '/' || r.doc_id"""
)
def manual_override_verdict(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = _classified(spark, sf_dir).select("doc_id", "verdict", _path().alias("path"))
    verdict = F.when(F.col("toxic") == 1, rules.CLOSED).when(F.col("quality") == 1, rules.PUBLIC).otherwise(rules.DISPUTED)
    manual = table(spark, sf_dir, "labels").where("doc_id % 3 <> 0").join(docs.select("doc_id", "source"), "doc_id")
    manual = manual.select(F.concat(F.when(F.col("doc_id") % 2 == 0, "old/").otherwise(""), _path()).alias("path"), verdict.alias("verdict"))
    first = docs.where("doc_id % 4 = 0").select(_path().alias("current"), F.lit("lost").alias("original"))
    second = docs.where("doc_id % 4 = 0").select(_path().alias("current"), _path("old/").alias("original"))
    return classify.override(rows, manual, classify.aliases(first, second)).select("doc_id", "verdict", "decided_by")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def cache_misses(spark, sf_dir):
    return classify.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), ["doc_id"])


# ---- duplicates ------------------------------------------------------------------------------

_GROUPS = """WITH h AS (SELECT doc_id, sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE text IS NOT NULL),
g AS (SELECT sha256, count(*) AS n, min(doc_id) AS first_id, CAST(min_by(bytes, doc_id) * (count(*) - 1) AS BIGINT) AS wasted FROM h GROUP BY 1 HAVING count(*) > 1) """


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", dedupe.content_hash("text").alias("sha256"), dedupe.signature("text").alias("signature"), F.octet_length("text").cast("long").alias("bytes"))


@query(_GROUPS + "SELECT * FROM g")
def exact_duplicate_groups(spark, sf_dir):
    return dedupe.groups(_hashed(spark, sf_dir), "sha256", "doc_id", "bytes")


@query(_GROUPS + "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_copies, CAST(coalesce(sum(wasted), 0) AS BIGINT) AS wasted FROM g")
def duplicate_totals(spark, sf_dir):
    return dedupe.totals(exact_duplicate_groups(spark, sf_dir))


_NORM = "lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))"


@query(f"""WITH h AS (SELECT doc_id, sha256(text) AS s, {_NORM} AS t FROM documents WHERE text IS NOT NULL)
SELECT sha256('txt=' || length(t) || chr(10) || sha256(t)) AS signature, count(*) AS n, min(doc_id) AS first_id, count(DISTINCT s) AS variants
FROM h WHERE t <> '' GROUP BY 1 HAVING count(DISTINCT s) > 1""")
def near_duplicate_groups(spark, sf_dir):
    return dedupe.near_groups(_hashed(spark, sf_dir), "sha256", "signature", "doc_id")


@query("SELECT doc_id, left(sha256(text), 16) AS short_id FROM documents")
def short_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", dedupe.short_id("text").alias("short_id"))


# ---- gate ------------------------------------------------------------------------------------

_CONTENT_SQL = " UNION ALL ".join(f"SELECT doc_id, {_q(n)} AS rule FROM documents WHERE regexp_matches(text, {_q(p)})" for n, p, _ in rules.CONTENT)


@query(_CONTENT_SQL)
def gate_secret_hits(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(gate.forbidden_content(F.col("text"))).alias("rule"))


_URL = "regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*/?', ''), '[?#].*$', '')"
_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(path, {_q(p)}) THEN {_q(n)}" for n, p in rules.PATHS) + " END"


@query(f"""WITH p AS (SELECT page_id, {_URL} AS path FROM pages),
r AS (SELECT *, starts_with(path, 'fr/') OR starts_with(path, 'en/') OR starts_with(path, 'de/') AS inc, starts_with(path, 'de/1') OR starts_with(path, 'en/2') AS exc FROM p)
SELECT page_id, path, inc AND NOT exc AS taken, CASE WHEN exc THEN 'excluded' WHEN NOT inc THEN 'outside' END AS reason, {_FIRST} AS forbidden FROM r""")
def gate_path_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", text.url_path("url").alias("rel"), F.lit("site").alias("repo"))
    rule = spark.createDataFrame([("site", ["fr/", "en/", "de/"], ["de/1", "en/2"])], "repo string, include array<string>, exclude array<string>")
    return census.select(pages, rule).select("page_id", F.col("rel").alias("path"), "taken", "reason", gate.forbidden_path(F.col("rel")).alias("forbidden"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a path with an extension by id."""
    ext = F.element_at(F.array(*map(F.lit, (".md", ".txt", ".bin", "", ".json"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text", F.octet_length("text").cast("long").alias("bytes"), F.concat("source", F.lit("/"), "doc_id", ext).alias("path"))


_FILES = "files AS (SELECT doc_id, source, text, strlen(text) AS bytes, source || '/' || doc_id || ['.md', '.txt', '.bin', '', '.json'][doc_id % 5 + 1] AS path FROM documents)"


@query(f"""WITH {_FILES}, s AS (SELECT CASE WHEN text IS NULL THEN 'missing' WHEN doc_id % 5 = 2 THEN 'not text' WHEN bytes > {rules.MAX_SCAN} THEN 'too large' ELSE 'scanned' END AS status FROM files)
SELECT status, count(*) AS n, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM s) AS percent FROM s GROUP BY 1""")
def gate_coverage(spark, sf_dir):
    return gate.scan_coverage(_files(spark, sf_dir).withColumn("skip_reason", gate.skip_reason("path", F.col("bytes"), F.col("text"))))


@query(
    _CLASSIFIED
    + f"SELECT doc_id, verdict FROM rows_ WHERE starts_with(source, 'src1') AND verdict <> '{rules.PUBLIC}'"
)
def gate_rights(spark, sf_dir):
    rows = _classified(spark, sf_dir).withColumn("path", _path())
    return gate.rights_hold(rows, ["src1"]).select("doc_id", "verdict")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def event_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k")).where("k is not null")


# ---- names and text quality --------------------------------------------------------------------

_MARKS = "".join("\\" + x if x in ".()[]{}*+-/=\"" else x for x in rules.PUNCTUATION).replace("'", "''")


@query(rf"""WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '\p{{L}}{{2,}}') AS words FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, text, len(words) AS words,
             len(list_filter(words, lambda w: length(w) >= 3 AND greatest(length(regexp_replace(w, '[^А-яЁё]', '', 'g')), length(regexp_replace(w, '[^A-Za-z]', '', 'g'))) > 0.9::DOUBLE * length(w))) AS coherent,
             length(regexp_replace(text, '[\p{{L}}\p{{N}}\s{_MARKS}]', '', 'g')) AS odd FROM w)
SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, CAST(words AS INTEGER) AS words, CAST(coherent AS INTEGER) AS coherent, CAST(odd AS INTEGER) AS odd,
       CASE WHEN trim(regexp_replace(text, '\s+', ' ', 'g')) = '' THEN NULL WHEN words = 0 THEN 1.0::DOUBLE ELSE 1 - coherent::DOUBLE / words END AS junk FROM c""")
def junk_share(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.quality("text").alias("q")).select("doc_id", "q.*")


@query(
    """WITH q AS (SELECT source, doc_id, regexp_extract_all(text, '\\p{L}{2,}') AS words, length(text) AS chars FROM documents WHERE text IS NOT NULL),
c AS (SELECT source, doc_id, chars, CASE WHEN len(words) = 0 THEN 1.0::DOUBLE ELSE 1 - len(list_filter(words, lambda w: length(w) >= 3 AND length(regexp_replace(w, '[^A-Za-z]', '', 'g')) > 0.9::DOUBLE * length(w)))::DOUBLE / len(words) END AS junk FROM q)
SELECT source, doc_id AS best, chars, junk FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY junk NULLS LAST, chars DESC, doc_id) AS r FROM c) WHERE r = 1"""
)
def sweep_best(spark, sf_dir):
    """The best setting: least junk (blank pages last), then most characters."""
    rows = table(spark, sf_dir, "documents").where("text is not null").select("source", "doc_id", text.quality("text").alias("q"))
    key = F.struct(F.col("q.junk").isNull(), "q.junk", -F.col("q.chars"), "doc_id")
    best = rows.groupBy("source").agg(F.min_by(F.struct("doc_id", "q"), key).alias("b"))
    return best.select("source", F.col("b.doc_id").alias("best"), F.col("b.q.chars").cast("long").alias("chars"), F.col("b.q.junk").alias("junk"))


_FIRST_LINE = "left(regexp_extract(text, '^[^\\n]*'), 120)"
_P = lambda p: _q(p)


@query(rf"""WITH l AS (SELECT doc_id, {_FIRST_LINE} AS s FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, length(regexp_replace(s, '\P{{L}}', '', 'g')) AS letters, greatest(length(regexp_replace(s, '[^А-яЁё]', '', 'g')), length(regexp_replace(s, '[^A-Za-z]', '', 'g'))) AS one,
             len(regexp_extract_all(s, '[A-Za-zА-Яа-яЁё]{{3,}}')) AS words FROM l)
SELECT doc_id, s AS line, CASE WHEN regexp_matches(s, {_P("(?i)" + rules.BOILERPLATE + "([^\\p{L}\\p{N}_]|$)")}) THEN false WHEN regexp_matches(s, {_P("(?i)" + rules.SPEAKS)}) THEN true
       ELSE letters >= 8 AND one >= 0.9::DOUBLE * letters AND NOT regexp_matches(s, '[{rules.MOJIBAKE}]') AND words >= 2 END AS plausible FROM n""")
def language_plausible(spark, sf_dir):
    line = F.substring(F.regexp_extract("text", r"^[^\n]*", 0), 1, 120)
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", line.alias("line")).withColumn("plausible", text.plausible("line"))


@query(_oracles["language_plausible"].replace(_FIRST_LINE, "regexp_extract(text, '^[^\\n]*')"))
def language_plausible_whole(spark, sf_dir):
    """language_plausible over whole first lines."""
    line = F.regexp_extract("text", r"^[^\n]*", 0)
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", line.alias("line")).withColumn("plausible", text.plausible("line"))


@query(rf"""WITH s AS (SELECT page_id, regexp_extract({_URL}, '([^/]*)$', 1) AS stem FROM pages)
SELECT page_id, stem, NOT regexp_matches(stem, {_P("(?i)" + rules.SPEAKS)}) AND (regexp_matches(stem, {_P("(?i)" + rules.MUSH)}) OR NOT regexp_matches(stem, '[A-Za-zА-Яа-яЁё]{{5,}}')) AS unreadable FROM s""")
def unreadable_names(spark, sf_dir):
    stem = F.regexp_extract(text.url_path("url"), r"([^/]*)$", 1)
    return table(spark, sf_dir, "pages").select("page_id", stem.alias("stem")).withColumn("unreadable", text.unreadable("stem"))


_CLEAN = r"""trim(trim(regexp_replace(regexp_replace(trim(regexp_replace(left(text, 150), '\s+', ' ', 'g')), '[\\/:*?"<>|]+', ' ', 'g'), '\s+', ' ', 'g')), ' .-–—_')"""


@query(rf"""WITH c AS (SELECT doc_id, {_CLEAN} AS name, left({_CLEAN}, 50) AS head FROM documents WHERE text IS NOT NULL),
p AS (SELECT *, CASE WHEN contains(head, ' ') THEN length(head) - instr(reverse(head), ' ') ELSE -1 END AS pos FROM c)
SELECT doc_id, name, CASE WHEN length(name) <= 50 THEN name ELSE rtrim(CASE WHEN pos > 30 THEN left(head, pos) ELSE head END, ' .-–—_') END AS short FROM p""")
def clean_short_name(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", text.cleaned(F.substring("text", 1, 150)).alias("name")).withColumn("short", text.shortened("name"))


@query(_oracles["clean_short_name"].replace("left(text, 150)", "text"))
def clean_short_name_whole(spark, sf_dir):
    """clean_short_name over whole texts; only `short` is cut."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", text.cleaned("text").alias("name")).withColumn("short", text.shortened("name"))


@query(r"SELECT page_id, nullif(regexp_extract(url || ' ' || page_id % 100 + 2000 || '.' || 10000 + page_id || 'v2', '(^|[^\p{L}\p{N}_.])(\d{4}\.\d{4,5})(v\d+)?($|[^\p{L}\p{N}_])', 2), '') AS preprint FROM pages")
def preprint_ids(spark, sf_dir):
    name = F.concat(F.col("url"), F.lit(" "), F.col("page_id") % 100 + 2000, F.lit("."), F.lit(10000) + F.col("page_id"), F.lit("v2"))
    return table(spark, sf_dir, "pages").select("page_id", text.preprint_id(name).alias("preprint"))


@query("SELECT page_id, replace(url_encode(url), '%2F', '/') AS quoted FROM pages")
def url_quote(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.quoted("url").alias("quoted"))


@query(rf"SELECT page_id, regexp_extract(p, '^(.*)/[^/]*$', 1) AS parent, regexp_extract(p, '([^/]*)$', 1) AS name, regexp_replace(regexp_extract(p, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem, lower(regexp_extract(regexp_extract(p, '([^/]*)$', 1), '.\.([^.]+)$', 1)) AS ext FROM (SELECT page_id, {_URL} AS p FROM pages)")
def path_parts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", text.url_path("url").alias("p"))
    return pages.select("page_id", *(c.alias(k) for k, c in text.path_parts("p").items()))


@query(r"SELECT doc_id, left(regexp_replace(left(text, 200), '[^\p{L}\p{N}_.\-() ]', '_', 'g'), 120) AS name FROM documents WHERE text IS NOT NULL")
def document_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.document_id(F.substring("text", 1, 200)).alias("name"))


@query(rf"""WITH t AS (SELECT page_id, regexp_replace(trim(trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_extract(html, '<title>([^<]*)', 1), '\s+', ' ', 'g')), '[\\/:*?"<>|]+', ' ', 'g'), '\s+', ' ', 'g')), ' .-–—_'), {_P("(?i)" + rules.SITE_CRUFT)}, '') AS t FROM pages)
SELECT page_id, CASE WHEN length(t) > 8 AND NOT regexp_matches(t, {_P("(?i)" + rules.EMPTY_TITLE)})
  AND (regexp_matches(t, {_P("(?i)" + rules.SPEAKS)}) OR NOT (regexp_matches(t, {_P("(?i)" + rules.MUSH)}) OR NOT regexp_matches(t, '[A-Za-zА-Яа-яЁё]{{5,}}'))) THEN t END AS title FROM t""")
def metadata_titles(spark, sf_dir):
    dump = F.concat(F.lit("Producer: x\nTitle: "), F.regexp_extract("html", "<title>([^<]*)", 1), F.lit("\nPages: 3"))
    return table(spark, sf_dir, "pages").select("page_id", text.metadata_title(dump).alias("title"))


@query()
def patent_names(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.patent_name(F.concat(F.lit("US"), F.col("doc_id") + 5_000_000), "text").alias("name"))


# ---- geometry ----------------------------------------------------------------------------------


@query("""SELECT doc_id, unnest(CASE WHEN n_chars <= 1024 THEN [0] ELSE list_append(range(0, CAST(ceil((n_chars - 1024) / 896.0) AS BIGINT) * 896, 896), n_chars - 1024) END) AS start FROM documents WHERE n_chars IS NOT NULL""")
def tile_starts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(grid.overlap_starts("n_chars", 1024, 128)).alias("start"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 97 + 50).alias("w"), (F.col("p_partkey") % 4000 + 100).alias("h"))


_GRID = """WITH p AS (SELECT p_partkey, CAST(p_size * 97 + 50 AS BIGINT) AS pw, p_partkey % 4000 + 100 AS ph FROM part),
s AS (SELECT *, CASE WHEN pw <= 1024 THEN [0] ELSE list_append(range(0, CAST(ceil((pw - 1024) / 896.0) AS BIGINT) * 896, 896), pw - 1024) END AS xs,
             CASE WHEN ph <= 1024 THEN [0] ELSE list_append(range(0, CAST(ceil((ph - 1024) / 896.0) AS BIGINT) * 896, 896), ph - 1024) END AS ys FROM p),
r AS (SELECT *, unnest(range(len(ys))) AS row FROM s), t AS (SELECT *, unnest(range(len(xs))) AS col FROM r),
g AS (SELECT p_partkey, row, col, xs[col + 1] AS x, ys[row + 1] AS y, least(1024, pw - xs[col + 1]) AS w, least(1024, ph - ys[row + 1]) AS h, row * len(xs) + col AS tile, len(xs) AS nx, len(ys) AS ny FROM t) """


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).withColumnsRenamed({"w": "pw", "h": "ph"})
    return grid.overlap_grid(pages, "pw", "ph")


@query(_GRID + """SELECT p_partkey, CAST(tile AS INTEGER) AS tile, x, y, w, h, CAST(CASE WHEN row > 0 THEN tile - nx END AS INTEGER) AS up, CAST(CASE WHEN row < ny - 1 THEN tile + nx END AS INTEGER) AS down,
CAST(CASE WHEN col > 0 THEN tile - 1 END AS INTEGER) AS "left", CAST(CASE WHEN col < nx - 1 THEN tile + 1 END AS INTEGER) AS "right",
CASE WHEN row > 0 THEN 128 ELSE 0 END AS over_up, CASE WHEN row < ny - 1 THEN 128 ELSE 0 END AS over_down, CASE WHEN col > 0 THEN 128 ELSE 0 END AS over_left, CASE WHEN col < nx - 1 THEN 128 ELSE 0 END AS over_right FROM g""")
def tile_grid_neighbors(spark, sf_dir):
    return _tiles(spark, sf_dir).select("p_partkey", "tile", "x", "y", "w", "h", "up", "down", "left", "right", "over_up", "over_down", "over_left", "over_right")


@query("""WITH p AS (SELECT p_partkey, CAST(p_size * 97 + 50 AS BIGINT) AS pw, p_partkey % 4000 + 100 AS ph FROM part),
r AS (SELECT *, unnest(range(0, ph, 1024)) AS y FROM p), t AS (SELECT *, unnest(range(0, pw, 1024)) AS x FROM r)
SELECT p_partkey, x, y, least(1024, pw - x) AS w, least(1024, ph - y) AS h FROM t""")
def clean_grid(spark, sf_dir):
    pages = _pages(spark, sf_dir).withColumnsRenamed({"w": "pw", "h": "ph"})
    return grid.clean_grid(pages, "pw", "ph").select("p_partkey", "x", "y", "w", "h")


@query("""SELECT doc_id, unnest(list_sort(list_distinct(CASE WHEN n_chars <= 1 THEN [1] WHEN n_chars <= 4 THEN [1, n_chars] WHEN n_chars <= 40 THEN [1, n_chars // 3, n_chars * 2 // 3, n_chars]
ELSE [1, n_chars // 5, n_chars * 2 // 5, n_chars * 3 // 5, n_chars * 4 // 5, n_chars] END))) AS page FROM documents""")
def page_samples(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(grid.sample_pages("n_chars")).alias("page"))


@query("""WITH p AS (SELECT p_partkey, p_size AS n, unnest(range(1, p_size + 1)) AS page FROM part)
SELECT p_partkey, CAST(page AS INTEGER) AS page FROM p WHERE (page BETWEEN 2 AND least(n, p_partkey % 7 + 3)) OR page = 15""")
def page_spec(spark, sf_dir):
    spec = F.concat(F.lit("2-"), F.col("p_partkey") % 7 + 3, F.lit(", 15,7-3, x"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(grid.page_spec(spec, "p_size")).alias("page"))


@query("""WITH v AS (SELECT p_partkey, p_partkey * 7 % 9001 AS px, p_size * 31 + p_partkey % 13 AS pt FROM part), d AS (SELECT *, CASE WHEN px > 0 AND pt > 0 THEN 72.0::DOUBLE * px / pt ELSE 300.0::DOUBLE END AS dpi FROM v)
SELECT p_partkey, greatest(36, CAST(round_even(CASE WHEN pt > 0 AND dpi * pt / 72.0::DOUBLE > 6000 THEN dpi * 6000 / (dpi * pt / 72.0::DOUBLE) ELSE dpi END, 0) AS INTEGER)) AS dpi FROM d""")
def effective_dpi(spark, sf_dir):
    v = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 7 % 9001).alias("px"), (F.col("p_size") * 31 + F.col("p_partkey") % 13).alias("pt"))
    return v.select("p_partkey", grid.effective_dpi("px", "pt", max_px=6000).alias("dpi"))


@query("""SELECT p_size AS page, CAST(max(p_partkey % 3000) AS INTEGER) AS w, CAST(max(p_partkey % 1700) AS INTEGER) AS h FROM part WHERE p_partkey % 3000 > 1 AND p_partkey % 1700 > 1 GROUP BY 1""")
def image_sizes(spark, sf_dir):
    line = F.concat_ws("   ", "p_size", F.lit(0), F.lit("image"), F.col("p_partkey") % 3000, F.col("p_partkey") % 1700, F.lit("gray"))
    lines = table(spark, sf_dir, "part").select(line.alias("line"), F.lit(1).alias("doc"))
    head = spark.createDataFrame([("page num type width height color", 1), ("-----------", 1)], "line string, doc int")
    return grid.image_grid(lines.unionByName(head), "line", "doc").select("page", "w", "h")


_DRAW = "CAST(('0x' || substr(md5('1|' || p_partkey || '|' || tile), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(_GRID + f""", k AS (SELECT p_partkey, count(*) AS kept, sum((w - 192) * (h - 192)) AS shown FROM g WHERE {_DRAW} >= 0.25 AND w - 192 >= 16 AND h - 192 >= 16 GROUP BY 1),
e AS (SELECT p_partkey, count(*) AS "of", sum(w * h) AS whole FROM g GROUP BY 1)
SELECT p_partkey, "of", coalesce(kept, 0) AS kept, 100.0::DOUBLE * CAST(coalesce(shown, 0) AS BIGINT) / greatest(1, CAST(whole AS BIGINT)) AS percent FROM e LEFT JOIN k USING (p_partkey)""")
def kit_sample_area(spark, sf_dir):
    tiles = _tiles(spark, sf_dir)
    return grid.kit_area(tiles, grid.kit(tiles, ["p_partkey", "tile"]), "p_partkey")


@query("""SELECT a.label, a.vec_id AS id, min_by(b.vec_id, (list_sum(list_transform(list_zip(a.embedding[57:64], b.embedding[1:8]), lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE))) / 8, b.vec_id)) AS match
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY 1, 2""")
def edge_match_argmin(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.slice("embedding", 57, 8).alias("out"), F.slice("embedding", 1, 8).alias("in"))
    return grid.best_neighbours(e, "label", "vec_id", "out", "in").select("label", "id", "match")


@query("""WITH e AS (SELECT user_id, event_id, value < 5 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
o AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e WHERE flag)
SELECT user_id, CAST(min(i) AS INTEGER) AS start, count(*) AS length FROM o GROUP BY user_id, run""")
def blank_runs(spark, sf_dir):
    return grid.islands(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("value") < 5)


@query("""WITH e AS (SELECT user_id, event_id, value < 5 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
o AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e WHERE flag),
r AS (SELECT user_id, count(*) AS length FROM o GROUP BY user_id, run)
SELECT u.user_id, coalesce(median(length), 0) AS line_height FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id) GROUP BY 1""")
def median_run(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    runs = grid.islands(events, "user_id", "event_id", F.col("value") < 5)
    return events.select("user_id").distinct().join(runs, "user_id", "left").groupBy("user_id").agg(F.coalesce(F.median("length"), F.lit(0.0)).alias("line_height"))


@query("""WITH p AS (SELECT label, CAST(vec_id % 100 AS INTEGER) AS x, avg(embedding[1]::DOUBLE) AS m, count(*) AS ink FROM embeddings GROUP BY 1, 2)
SELECT label, min_by(x, (ink, x)) AS x FROM p WHERE x >= 40 AND x < 60 GROUP BY 1""")
def gutter_column(spark, sf_dir):
    p = table(spark, sf_dir, "embeddings").groupBy("label", (F.col("vec_id") % 100).cast("int").alias("x")).agg(F.count("*").alias("ink"))
    return grid.gutter(p.withColumn("width", F.lit(100)), "label", "x", "width", "ink")


# ---- ordered folds -----------------------------------------------------------------------------


#: Lines with their ends, and characters before each; a chunk is carried on from the one before.
_LINE_ENDS = r"\n\r\v\f\x1c-\x1e\x85\x{2028}\x{2029}"
_CHUNKS = rf"""WITH RECURSIVE l AS (SELECT doc_id, regexp_extract_all(text, '[^{_LINE_ENDS}]*(?:\r\n|[{_LINE_ENDS}])|[^{_LINE_ENDS}]+') AS x FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[^\s\x0B\x1c-\x1f\x85\xa0]')),
t AS (SELECT doc_id, x, len(x) AS n, list_transform(range(len(x) + 1), lambda i: coalesce(list_sum(list_transform(x[1:i], lambda y: length(y))), 0)) AS total FROM l),
c AS (SELECT doc_id, 0 AS chunk, 0 AS a, greatest(0, len(list_filter(total, lambda v: v < 4000)) - 1) AS e, n FROM t
  UNION ALL SELECT doc_id, chunk + 1, b, greatest(e + 1, len(list_filter(total, lambda v: v < total[b + 1] + 4000)) - 1), n
  FROM (SELECT c.doc_id, c.chunk, c.e, c.n, t.total, greatest(c.a, len(list_filter(t.total, lambda v: v <= t.total[c.e + 2] - 400)) - 1) AS b FROM c JOIN t USING (doc_id) WHERE c.e < c.n)),
k AS (SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(a AS INTEGER) AS line_from, CAST(least(e, c.n - 1) AS INTEGER) AS line_to, array_to_string(x[a + 1:least(e, c.n - 1) + 1], '') AS text FROM c JOIN t USING (doc_id)) """


@query(_CHUNKS + "SELECT * FROM k")
def text_chunks(spark, sf_dir):
    return fold.chunks(table(spark, sf_dir, "documents"))


@query(_CHUNKS + "SELECT doc_id, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(max(length(text)) AS INTEGER) AS longest FROM k GROUP BY 1")
def doc_rollup(spark, sf_dir):
    """Chunks, characters and the largest chunk of every document that has text."""
    return text_chunks(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars"), F.max(F.length("text")).alias("longest"))


@query(r"""WITH RECURSIVE x AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, len(list_filter(string_split_regex(coalesce(text, ''), '[\s\x0B\x1c-\x1f\x85\xa0]+'), lambda w: w <> '')) + 2 AS n FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, coalesce(min_by(n, (turn, text)) FILTER (role = 'system'), 0) AS head FROM x GROUP BY 1),
s AS (SELECT conv_id, turn, role, head, least(n, 512 - head) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS k FROM x JOIN h USING (conv_id) WHERE role <> 'system' AND head < 512),
w AS (SELECT conv_id, k, 0 AS win, head + size AS tokens FROM s WHERE k = 1
  UNION ALL SELECT s.conv_id, s.k, w.win + CASE WHEN w.tokens + s.size > 512 THEN 1 ELSE 0 END, CASE WHEN w.tokens + s.size > 512 THEN s.head ELSE w.tokens END + s.size FROM w JOIN s ON s.conv_id = w.conv_id AND s.k = w.k + 1),
g AS (SELECT conv_id, win, min_by(turn, s.k) AS first_turn, max_by(turn, s.k) AS last_turn, CAST(any_value(head) + sum(size) AS BIGINT) AS tokens, CAST(coalesce(sum(size) FILTER (role = 'assistant'), 0) AS BIGINT) AS trained FROM w JOIN s USING (conv_id, k) GROUP BY 1, 2)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY win) - 1 AS win, first_turn, last_turn, tokens, trained FROM g WHERE trained > 0""")
def turn_windows(spark, sf_dir):
    return fold.turn_windows(table(spark, sf_dir, "conversations"), max_len=512)


@query("SELECT conv_id, turn, length(text) AS chars FROM conversations WHERE role = 'assistant' AND length(text) > 400")
def chat_answers(spark, sf_dir):
    return fold.answers(table(spark, sf_dir, "conversations")).select("conv_id", "turn", F.length("text").cast("long").alias("chars"))


_WORDS = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")


@query(r"""WITH d AS (SELECT doc_id, sha256(lower(text)) AS h, string_split_regex(trim(text), '\s+')[1:48] AS w FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^\S')),
f AS (SELECT left(text, 12) AS k, min(doc_id) AS lead FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '^\S') GROUP BY 1),
p AS (SELECT d.doc_id, d.w AS a, e.w AS b FROM d JOIN documents x USING (doc_id) JOIN f ON f.k = left(x.text, 12) AND f.lead <> d.doc_id JOIN d e ON e.doc_id = f.lead)
SELECT doc_id, CAST(coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda i: coalesce(a[i] = b[i], false)), false) - 1, greatest(len(a), len(b))) AS BIGINT) AS run FROM p""")
def leak_prefix_runs(spark, sf_dir):
    """Documents against the first one that begins alike: words in common from the start."""
    d = table(spark, sf_dir, "documents").where(F.rlike("text", F.lit(r"^\S"))).select("doc_id", F.substring("text", 1, 12).alias("k"), F.slice(_WORDS(F.trim("text")), 1, 48).alias("a"))
    lead = d.groupBy("k").agg(F.min_by(F.struct("doc_id", "a"), "doc_id").alias("l"))
    return d.join(lead, "k").where("doc_id <> l.doc_id").select("doc_id", fold.prefix_run(F.col("a"), F.col("l.a")).alias("run"))


#: First word of a text, words part at blanks as in _WORDS.
_FIRST_WORD = lambda c: F.regexp_extract(c, r"\S+", 0)


@query(r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '[\s\x0B]+'), lambda w: w <> '') AS a FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, list_filter(string_split_regex(text, '[\s\x0B]+'), lambda w: w <> '') AS b FROM benchmark WHERE text IS NOT NULL)
SELECT doc_id, item_id, CAST(coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda j: coalesce(a[j] = b[j], false)), false) - 1, greatest(len(a), len(b))) AS BIGINT) AS run
FROM d JOIN i ON a[1] = b[1]""")
def leak_benchmark_runs(spark, sf_dir):
    """Documents against every benchmark item that begins with the same word: words in common from
    the start, over both whole texts. All other pairs have a run of 0."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", _FIRST_WORD("text").alias("k")).where("k <> ''")
    d = d.select("doc_id", "k", _WORDS("text").alias("a"))
    i = table(spark, sf_dir, "benchmark").select("item_id", _FIRST_WORD("text").alias("k"), _WORDS("text").alias("b")).where("k <> ''")
    return d.join(i, "k").select("doc_id", "item_id", fold.prefix_run(F.col("a"), F.col("b")).alias("run"))


_RUN = "coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda j: coalesce(a[j] = b[j], false)), false) - 1, greatest(len(a), len(b)))"


@query(rf"""WITH d AS (SELECT list_filter(string_split_regex(text, '[\s\x0B]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT list_filter(string_split_regex(text, '[\s\x0B]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT least(48, len(i.w) - 48) AS full_, d.w[49:96] AS a, i.w[49:96] AS b FROM d JOIN i ON d.w[1:48] = i.w[1:48] AND len(i.w) > 48), r AS (SELECT full_, {_RUN} AS run FROM p),
s AS (SELECT count(*) AS n, count(*) FILTER (run >= full_ AND full_ > 0) AS exact, CAST(coalesce(sum(run), 0) AS BIGINT) AS runs FROM r)
SELECT n, exact, exact / greatest(1, n)::DOUBLE AS share, runs / greatest(1, n)::DOUBLE AS mean_run, n > 0 AND exact / greatest(1, n)::DOUBLE <= 0.01 AND runs / greatest(1, n)::DOUBLE <= 8 AS ok FROM s""")
def leak_metric(spark, sf_dir, prompt: int = 48):
    """Benchmark items that go on after a prompt, against the documents that open with the same
    prompt: the words after it, in the reference's window."""

    def rest(name, out):
        t = table(spark, sf_dir, name).select(_WORDS("text").alias("w"))
        return t.select(F.slice("w", 1, prompt).alias("prompt"), F.slice("w", prompt + 1, 2**31 - 1).alias(out))

    i = rest("benchmark", "b").where(F.size("b") > 0)
    return fold.leak(rest("documents", "a").join(i, "prompt"), "b", "a")


@query("""WITH RECURSIVE p AS (SELECT l_orderkey AS doc_id, l_linenumber AS page, l_discount::DOUBLE AS ink, l_quantity::DOUBLE AS h, l_linenumber % 2 AS cols, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_discount, l_quantity) AS k FROM lineitem),
g AS (SELECT doc_id, page, k, 0 AS grp, [{'i': ink, 'h': h, 'c': cols}] AS leads FROM p WHERE k = 1
  UNION ALL SELECT doc_id, page, k, coalesce(hit, len(leads) + 1) - 1, CASE WHEN hit IS NULL THEN list_append(leads, {'i': ink, 'h': h, 'c': cols}) ELSE leads END
  FROM (SELECT p.*, g.leads, list_position(list_transform(g.leads, lambda l: l.c = p.cols AND abs(l.i - p.ink) <= 0.05::DOUBLE AND abs(l.h - p.h) <= 0.4::DOUBLE * greatest(l.h, p.h, 1)), true) AS hit FROM g JOIN p ON p.doc_id = g.doc_id AND p.k = g.k + 1))
SELECT doc_id, page, CAST(grp AS INTEGER) AS "group" FROM g""")
def page_groups(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), F.col("l_discount").alias("ink"), F.col("l_quantity").alias("line_h"), (F.col("l_linenumber") % 2).alias("cols"))
    return fold.page_groups(o)


# ---- census, placement, state --------------------------------------------------------------------


@query("""WITH f AS (SELECT source AS repo, strlen(text) AS bytes, starts_with(lang, 'e') OR starts_with(lang, 'f') AS inc, starts_with(lang, 'es') AS exc FROM documents)
SELECT repo, count(*) FILTER (coalesce(inc AND NOT exc, false)) AS taken, count(*) FILTER (NOT coalesce(inc AND NOT exc, false)) AS skipped, CAST(coalesce(sum(bytes) FILTER (inc AND NOT exc), 0) AS BIGINT) AS bytes FROM f GROUP BY ROLLUP (repo)""")
def census_totals(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.col("source").alias("repo"), F.col("lang").alias("rel"), F.octet_length("text").cast("long").alias("bytes"))
    rule = files.select("repo").distinct().withColumns({"include": F.array(F.lit("e"), F.lit("f")), "exclude": F.array(F.lit("es"))})
    return census.totals(census.select(files, rule))


@query(_CLASSIFIED + "SELECT source, doc_id % 7 AS dir, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes, array_to_string(list_sort(list(DISTINCT verdict)), ',') AS verdicts FROM rows_ GROUP BY 1, 2")
def directory_rollup(spark, sf_dir):
    rows = _classified(spark, sf_dir).withColumns({"dir": F.col("doc_id") % 7, "bytes": F.octet_length("text").cast("long")})
    return census.directory_rollup(rows, ["source", "dir"])


@query(_CLASSIFIED + f"SELECT doc_id, verdict, CASE WHEN doc_id % 3 = 0 THEN 'public' ELSE 'private' END AS zone, CASE WHEN verdict = '{rules.PUBLIC}' THEN 'public' ELSE 'private' END AS zone_wanted FROM rows_ WHERE doc_id % 5 <> 0 AND (doc_id % 3 = 0) <> (verdict = '{rules.PUBLIC}')")
def rebalance_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    located = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 3 == 0, "public").otherwise("private").alias("zone"))
    return census.misplaced(_classified(spark, sf_dir).select("doc_id", "verdict"), located, ["doc_id"]).select("doc_id", "verdict", "zone", "zone_wanted")


@query("SELECT lang AS zone, CASE WHEN lang <> 'de' THEN count(*) END AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1")
def moved_by_zone(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("lang is not null").select(F.col("lang").alias("zone"))
    return census.moved_by_zone(docs.distinct().withColumn("reachable", F.col("zone") != "de"), docs)


@query("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN doc_id % 2 = 0 THEN 'ok' ELSE 'mismatch' END AS status, false AS may_delete FROM documents d LEFT JOIN labels l USING (doc_id)""")
def verified_moves(spark, sf_dir):
    plan = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    docs = plan.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    copies = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("sha256")).otherwise("damaged").alias("sha256"))
    return census.verify_moves(plan, copies, "doc_id").select("doc_id", "status", "may_delete")


@query(_CLASSIFIED + f""", r AS (SELECT source || '/' || doc_id AS path, doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new/' || doc_id END AS renamed, text FROM rows_ WHERE verdict = '{rules.DISPUTED}')
SELECT path, coalesce(renamed, path) AS now, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM r WHERE doc_id % 4 <> 1""")
def pointer_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rights = _classified(spark, sf_dir).where(F.col("verdict") == rules.DISPUTED).select(_path().alias("path"))
    new = F.concat(F.lit("new/"), F.col("doc_id"))
    renames = docs.where("doc_id % 3 = 0").select(_path().alias("original"), new.alias("current"))
    existing = docs.where("doc_id % 4 <> 1").select(F.when(F.col("doc_id") % 3 == 0, new).otherwise(_path()).alias("path"))
    known = docs.select(_path().alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    return census.pointers(rights, renames, existing, known).select("path", "now", "bytes", "sha256")


@query("SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large' WHEN o_totalprice >= 150000 THEN 'medium' WHEN o_totalprice >= 0 THEN 'small' END AS name FROM orders")
def profile_lookup(spark, sf_dir):
    bounds = spark.createDataFrame([(0.0, "small"), (150000.0, "medium"), (300000.0, "large")], "bound double, name string")
    return census.at_least(table(spark, sf_dir, "orders"), "o_totalprice", bounds).select("o_orderkey", "name")


@query("""WITH d AS (SELECT source || '-' || doc_id AS id, doc_id, CASE WHEN doc_id % 10 = 0 THEN 'bad' END AS error FROM documents)
SELECT id, doc_id FROM d WHERE error IS NULL AND contains(lower(id), '-11') ORDER BY CASE WHEN id = '-11' THEN 0 ELSE 1 END, doc_id LIMIT 1""")
def doc_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat_ws("-", "source", "doc_id").alias("id"), "doc_id", F.when(F.col("doc_id") % 10 == 0, "bad").alias("error"))
    return census.lookup(docs, "-11", "id", "doc_id").select("id", "doc_id")


@query("SELECT p_name, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) = 1")
def first_roots(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_name", "p_partkey")
    return census.first_of(parts, F.lower("p_name"), "p_partkey")


@query("SELECT user_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_state(spark, sf_dir):
    return census.latest(table(spark, sf_dir, "events"), "user_id", "ts", ["event_type", "value"], "event_id")


@query("""WITH e AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, event_id, (epoch_us(ts) - epoch_us(before)) AS gap_us FROM e WHERE epoch_us(ts) - epoch_us(before) > 3600000000""")
def stall_gaps(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(w)).alias("gap_us"))
    return e.where("gap_us > 3600000000")


@query("""SELECT conv_id, count(*) AS turns, CAST(ceil(ceil(count(*) / 8.0) * 2) AS BIGINT) AS steps, CAST(floor(100 * 3 / greatest(1, count(*))) AS BIGINT) AS percent FROM conversations GROUP BY 1""")
def hours_estimate(spark, sf_dir):
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    return n.select("conv_id", "turns", census.steps(F.col("turns"), 1, 8, 2).alias("steps"), census.progress(F.lit(3), F.col("turns"), F.lit(1.0))["percent"].alias("percent"))


_HTML_MARKS = ("<script", "<style", "href=")


@query("SELECT page_id, " + ", ".join(f"CAST((length(html) - length(replace(html, '{m}', ''))) / {len(m)} AS INTEGER) AS {a}" for m, a in zip(_HTML_MARKS, ("scripts", "styles", "links"), strict=True)) + ", CASE WHEN contains(html, '<script') THEN 'heavy' WHEN contains(html, '<style') OR contains(html, 'href=') THEN 'routine' END AS bucket FROM pages")
def mark_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    counted = pages.select("page_id", *(F.regexp_count("html", F.lit(m)).alias(a) for m, a in zip(_HTML_MARKS, ("scripts", "styles", "links"), strict=True)))
    return counted.withColumn("bucket", pdf_marks.bucket(F.col("scripts") > 0, (F.col("styles") > 0) | (F.col("links") > 0)))


@query("""SELECT doc_id, min_by(mode, (bytes, mode)) AS mode, min(bytes) AS bytes FROM (SELECT doc_id, 'utf8' AS mode, CAST(strlen(text) AS BIGINT) AS bytes FROM documents WHERE text IS NOT NULL
UNION ALL SELECT doc_id, 'utf16', CAST(2 * length(text) AS BIGINT) FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def smallest_encoding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    modes = F.array(F.struct(F.octet_length("text").cast("long").alias("bytes"), F.lit("utf8").alias("mode")), F.struct((2 * F.length("text")).cast("long").alias("bytes"), F.lit("utf16").alias("mode")))
    return docs.select("doc_id", F.array_min(modes).alias("m")).select("doc_id", "m.mode", "m.bytes")


@query("SELECT doc_id FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 50")
def seeded_shuffle(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").orderBy(F.md5(F.concat_ws("|", F.lit(7), "doc_id").cast("binary")), "doc_id").limit(50)


@query("SELECT doc_id, i AS part, strlen(substr(t, i * 512 + 1, 512)) AS bytes FROM (SELECT doc_id, hex(encode(text)) AS t, unnest(range(CAST(ceil(strlen(text) * 2 / 512.0) AS BIGINT))) AS i FROM documents WHERE text IS NOT NULL)")
def binary_parts(spark, sf_dir):
    from ..sources.files import split_parts

    return split_parts(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.hex(F.encode("text", "UTF-8")).cast("binary").alias("content")), "content", 512).select("doc_id", "part", F.octet_length("content").cast("long").alias("bytes"))


from . import more, rasters, reports, scans, streams  # noqa: E402, F401  register their queries
