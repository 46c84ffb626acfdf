"""Further queries of the reference's operators, each with its DuckDB equivalent: aggregates over
pages and files, and forms of the rule queries in which every rule has hits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules, text
from ..operators import census, classify, dedupe, fold, gate, grid
from ..sources import files
from ..sources import marks as pdf_marks
from .corpus import _CLASSES, _CLASSIFIED, _DRAW, _GRID, _HTML_MARKS, _NORM, _URL, _classified, _path, _q, _tiles, exact_duplicate_groups, junk_share, mark_counts, query, table

_list = lambda values: "[" + ", ".join(map(_q, values)) + "]"


def _pick(values, index):
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


# ---- rules, each with hits ---------------------------------------------------------------------

_MARKERS = (*(c.markers[0] for c in rules.RIGHTS), "")
_MARKED = f"SELECT doc_id, source, coalesce(text, '') || ' ' || {_list(_MARKERS)}[doc_id % {len(_MARKERS)} + 1] AS text FROM documents"


@query(_CLASSIFIED.replace("FROM documents", f"FROM ({_MARKED})") + "SELECT doc_id, verdict, rule, marker FROM rows_")
def rights_classes_hit(spark, sf_dir):
    """Documents with a marker of each class in turn, the last without one."""
    docs = table(spark, sf_dir, "documents")
    marked = docs.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" "), _pick(_MARKERS, F.col("doc_id") % len(_MARKERS))))
    return classify.classify(marked, classes=_CLASSES).select("doc_id", "verdict", "rule", "marker")


_NAMES = ("a/chatlog/b.md", "sessions/x.md", "a/context-export", ".chatman/state", "log.jsonl", "conf/.env.local", "keys/id_rsa.pub", "tls/server.pem", "notes/sessionsx.md")


@query(f"""WITH p AS (SELECT page_id, page_id || '/' || {_list(_NAMES)}[page_id % {len(_NAMES)} + 1] AS path FROM pages)
SELECT page_id, path, CASE {" ".join(f"WHEN regexp_matches(path, {_q(p)}) THEN {_q(n)}" for n, p in rules.PATHS)} END AS forbidden FROM p""")
def gate_paths_hit(spark, sf_dir):
    """Paths of which each path rule forbids some, and some none."""
    path = F.concat("page_id", F.lit("/"), _pick(_NAMES, F.col("page_id") % len(_NAMES)))
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path")).withColumn("forbidden", gate.forbidden_path(F.col("path")))


_SECRETS = ("-----BEGIN RSA PRIVATE KEY-----", "sk-ant-" + "a1" * 10, "ghp_" + "b2" * 12, "AKIA" + "C3" * 8, "xoxb-" + "d4" * 6, "password = 'longenough'", "\nUSER : hi", '{"role": "user"}', "\n<user_message>", "sk-ant-short")


@query(f"WITH d AS (SELECT doc_id, doc_id % 4 = 0 AS own, coalesce(text, '') || {_list(_SECRETS)}[doc_id % {len(_SECRETS)} + 1] AS text FROM documents) " + " UNION ALL ".join(f"SELECT doc_id, {_q(n)} AS rule FROM d WHERE regexp_matches(text, {_q(p)})" + (" AND NOT own" if markup else "") for n, p, markup in rules.CONTENT))
def gate_content_hit(spark, sf_dir):
    """Texts with a secret or markup of each kind in turn; every fourth is an own file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), _pick(_SECRETS, F.col("doc_id") % len(_SECRETS))).alias("text"))
    return docs.select("doc_id", F.explode(gate.forbidden_content(F.col("text"), F.col("doc_id") % 4 == 0)).alias("rule"))


@query(
    _CLASSIFIED
    + f""", f AS (SELECT doc_id, source || '/' || {_list(_NAMES)}[doc_id % {len(_NAMES)} + 1] AS path, text, verdict FROM rows_)
SELECT doc_id, 'path' AS kind, CASE {" ".join(f"WHEN regexp_matches(path, {_q(p)}) THEN {_q(n)}" for n, p in rules.PATHS)} END AS rule FROM f WHERE doc_id % {len(_NAMES)} <> {len(_NAMES) - 1}
UNION ALL SELECT * FROM ({" UNION ALL ".join(f"SELECT doc_id, 'content', {_q(n)} FROM f WHERE regexp_matches(text, {_q(p)})" for n, p, _ in rules.CONTENT)})
UNION ALL SELECT doc_id, 'rights', verdict FROM f WHERE starts_with(path, 'src1') AND verdict <> '{rules.PUBLIC}'"""
)
def gate_violations(spark, sf_dir):
    """Path, content and rights violations together."""
    rows = _classified(spark, sf_dir).withColumn("path", F.concat("source", F.lit("/"), _pick(_NAMES, F.col("doc_id") % len(_NAMES))))
    return gate.violations(rows, "path", F.col("text"), "doc_id").unionByName(gate.rights_violations(rows, ["src1"], "doc_id"))


@query(
    _CLASSIFIED
    + f""", f AS (SELECT doc_id, CASE WHEN lang = 'de' THEN 'new/' || doc_id ELSE source || '/' || doc_id END AS path FROM documents),
m AS (SELECT doc_id, CASE WHEN toxic = 1 THEN '{rules.CLOSED}' WHEN quality = 1 THEN '{rules.PUBLIC}' ELSE '{rules.DISPUTED}' END AS verdict FROM labels)
SELECT f.doc_id, f.path, r.source || '/' || r.doc_id AS former, coalesce(m.verdict, r.verdict) AS verdict, m.doc_id IS NOT NULL AS decided
FROM f JOIN rows_ r USING (doc_id) LEFT JOIN m USING (doc_id) WHERE coalesce(m.verdict, r.verdict) <> '{rules.PUBLIC}'"""
)
def gate_renamed(spark, sf_dir):
    """What the gate holds back: present paths, traced to the former ones, under which decisions and
    verdicts are kept."""
    docs = table(spark, sf_dir, "documents")
    new = F.concat(F.lit("new/"), "doc_id")
    now = docs.select("doc_id", F.when(F.col("lang") == "de", new).otherwise(_path()).alias("path"))
    renames = docs.where("lang = 'de'").select(new.alias("current"), _path().alias("original"))
    verdict = F.when(F.col("toxic") == 1, rules.CLOSED).when(F.col("quality") == 1, rules.PUBLIC).otherwise(rules.DISPUTED)
    decisions = table(spark, sf_dir, "labels").join(docs.select("doc_id", "source"), "doc_id").select(_path().alias("path"), verdict.alias("verdict"))
    rows = gate.decided(now, renames, decisions, _classified(spark, sf_dir).select(_path().alias("path"), "verdict"))
    return gate.rights_hold(rows, [""]).select("doc_id", "path", "former", "verdict", "decided")


_SPACED = "SELECT doc_id, text FROM documents UNION ALL SELECT -doc_id - 1, '  ' || replace(text, ' ', '  ') FROM documents WHERE lang = 'en'"


@query(f"""WITH h AS (SELECT doc_id, sha256(text) AS s, {_NORM} AS t FROM ({_SPACED}) WHERE text IS NOT NULL)
SELECT sha256('txt=' || length(t) || chr(10) || sha256(t)) AS signature, count(*) AS n, min(doc_id) AS first_id, count(DISTINCT s) AS variants
FROM h WHERE t <> '' GROUP BY 1 HAVING count(DISTINCT s) > 1""")
def near_groups_hit(spark, sf_dir):
    """Near groups among the documents and spaced copies of the English ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    copies = docs.where("lang = 'en'").select((-F.col("doc_id") - 1).alias("doc_id"), F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("  "))).alias("text"))
    rows = docs.select("doc_id", "text").unionByName(copies)
    return dedupe.near_groups(rows.select("doc_id", dedupe.content_hash("text").alias("sha256"), dedupe.signature("text").alias("signature")), "sha256", "signature", "doc_id")


@query("SELECT doc_id, 'ok' AS status, true AS may_delete FROM documents WHERE text IS NOT NULL")
def verified_moves_clean(spark, sf_dir):
    """Every copy is right, so every source may go."""
    plan = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return census.verify_moves(plan, plan, "doc_id").select("doc_id", "status", "may_delete")


@query("SELECT source || '-' || doc_id AS id, doc_id FROM documents WHERE doc_id = 11")
def doc_lookup_exact(spark, sf_dir):
    """An exact id wins over earlier documents whose id holds it."""
    docs = table(spark, sf_dir, "documents").select(F.concat_ws("-", "source", "doc_id").alias("id"), "doc_id", F.lit(None).cast("string").alias("error"))
    wanted = docs.where("doc_id = 11").select("id").first()
    return census.lookup(docs, wanted["id"] if wanted else "-", "id", "doc_id").select("id", "doc_id")


_STEMS = ("ISO 9001 note", "ГОСТ 2.105", "ab12", "2301.00001v2", "12.34-5", "long enough name", "abc")


@query(f"""WITH s AS (SELECT page_id, {_list(_STEMS)}[page_id % {len(_STEMS)} + 1] AS stem FROM pages)
SELECT page_id, stem, NOT regexp_matches(stem, {_q("(?i)" + rules.SPEAKS)}) AND (regexp_matches(stem, {_q("(?i)" + rules.MUSH)}) OR NOT regexp_matches(stem, '[A-Za-zА-Яа-яЁё]{{5,}}')) AS unreadable FROM s""")
def unreadable_stems(spark, sf_dir):
    """Names with codes that speak for themselves, and names that say nothing."""
    return table(spark, sf_dir, "pages").select("page_id", _pick(_STEMS, F.col("page_id") % len(_STEMS)).alias("stem")).withColumn("unreadable", text.unreadable("stem"))


_SQL_CLEAN = lambda x: rf"""trim(trim(regexp_replace(regexp_replace(trim(regexp_replace({x}, '\s+', ' ', 'g')), '[\\/:*?"<>|]+', ' ', 'g'), '\s+', ' ', 'g')), ' .-–—_')"""
#: Page titles; a sharp s, whose capital differs between engines, is spelled out.
_TITLE = "replace(regexp_extract(html, '<title>([^<]*)', 1), 'ß', 'ss')"


@query(rf"""WITH e AS (SELECT page_id, 'US' || 5000000 + page_id || '.A' AS stem, CASE page_id % 3 WHEN 0 THEN 'x' || chr(10) || '[54] 12 ' || {_TITLE} || ' [75] y' WHEN 1 THEN 'US 5,1' || chr(10) || upper({_TITLE}) || chr(10) || 'end' ELSE {_TITLE} END AS text FROM pages),
c AS (SELECT *, {_SQL_CLEAN(f"regexp_replace(trim(regexp_replace(regexp_extract(text, {_q('(?s)' + rules.PATENT_TITLE)}, 1), '\\s+', ' ', 'g')), {_q(rules.PATENT_CODE)}, '')")} AS coded,
  list_filter(list_transform(string_split_regex(text, '\r\n|\n|\r'), lambda x: {_SQL_CLEAN("x")}), lambda x: length(x) >= 14 AND x = upper(x) AND x <> lower(x) AND NOT regexp_matches(x, {_q(rules.PATENT_IDENTIFIER)}) AND len(regexp_extract_all(x, '[A-Z]{{3,}}')) >= 2)[1] AS capital FROM e),
t AS (SELECT page_id, regexp_extract(stem, '\d{{7,8}}') AS number, coalesce(CASE WHEN len(regexp_extract_all(coded, '[A-Za-z]{{3,}}')) >= 2 THEN coded END, capital) AS title FROM c)
SELECT page_id, 'Патент США ' || number || coalesce(' — ' || list_aggregate(list_transform(regexp_extract_all(title, '\p{{L}}+|[^\p{{L}}]+'), lambda r: upper(r[1]) || lower(r[2:])), 'string_agg', ''), '') AS name FROM t""")
def patent_titles(spark, sf_dir):
    """Names of patents from page titles, put after code 54, in a line of capitals, or as they are."""
    title = F.replace(F.regexp_extract("html", "<title>([^<]*)", 1), F.lit("ß"), F.lit("ss"))
    kind = F.col("page_id") % 3
    evidence = F.when(kind == 0, F.concat(F.lit("x\n[54] 12 "), title, F.lit(" [75] y"))).when(kind == 1, F.concat(F.lit("US 5,1\n"), F.upper(title), F.lit("\nend"))).otherwise(title)
    return table(spark, sf_dir, "pages").select("page_id", text.patent_name(F.concat(F.lit("US"), F.col("page_id") + 5_000_000, F.lit(".A")), evidence).alias("name"))


# ---- evidence, pages, index ----------------------------------------------------------------------

_EVIDENCE = """SELECT conv_id AS doc_id, 'x' AS source, 'Title: dialogue ' || conv_id || chr(10) || coalesce(string_agg(coalesce(text, ''), chr(10) ORDER BY turn, coalesce(text, '')) FILTER (turn < 3), '') AS text,
length(trim(coalesce(string_agg(coalesce(text, ''), chr(10) ORDER BY turn, coalesce(text, '')) FILTER (turn < 3), ''), ' ')) < 200 AS poor FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id"""


@query(_CLASSIFIED.replace("FROM documents", f"FROM ({_EVIDENCE})") + f"SELECT r.doc_id AS conv_id, length(r.text) AS chars, e.poor, r.verdict FROM rows_ r JOIN ({_EVIDENCE}) e USING (doc_id)")
def evidence_rights(spark, sf_dir):
    """Verdicts from the metadata and the first three pages, dialogues taken as documents of a page a turn."""
    said = table(spark, sf_dir, "conversations").where("conv_id is not null")
    meta = said.select("conv_id").distinct().withColumn("meta", F.concat(F.lit("Title: dialogue "), "conv_id"))
    pages = said.select("conv_id", (F.col("turn") + 1).alias("page"), "text")
    rows = classify.classify(classify.evidence_text(meta, pages, "conv_id"), "evidence", _CLASSES)
    return rows.select("conv_id", F.length("evidence").cast("long").alias("chars"), "poor", "verdict")


_SHEET = "SELECT conv_id, turn, length(text) AS chars, 500 + 7 * length(text) % 3000 AS w, 300 + 11 * length(text) % 2500 AS h FROM conversations"
_N = lambda c: f"CASE WHEN {c} <= 1024 THEN 1 ELSE CAST(ceil(({c} - 1024) / 896.0) AS BIGINT) + 1 END"


def _sheets(spark, sf_dir):
    n = F.length("text").cast("long")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", n.alias("chars"), (500 + 7 * n % 3000).alias("w"), (300 + 11 * n % 2500).alias("h"))


@query(f"""SELECT conv_id, count(*) AS pages, count(*) FILTER (chars > 0) AS with_text, count(*) FILTER (coalesce(chars, 0) < 200) AS rendered, CAST(coalesce(sum(chars), 0) AS BIGINT) AS chars,
CAST(coalesce(sum({_N("w")} * {_N("h")}) FILTER (coalesce(chars, 0) < 200), 0) AS BIGINT) AS tiles FROM ({_SHEET}) GROUP BY 1""")
def page_rollup(spark, sf_dir):
    """Pages, pages with text, rendered pages, characters and tiles, a turn taken as a page."""
    return grid.document_rollup(_sheets(spark, sf_dir), "conv_id")


@query(f"SELECT conv_id, turn, coalesce(chars, 0) < 200 AS render FROM ({_SHEET})")
def pages_to_render(spark, sf_dir):
    return _sheets(spark, sf_dir).select("conv_id", "turn", grid.needs_render("chars").alias("render"))


@query("""WITH p AS (SELECT length(text) AS chars, CAST(36 + n_chars % 270 AS INTEGER) AS dpi, CAST(strlen(text) AS BIGINT) AS bytes_in, CAST(length(text) AS BIGINT) AS bytes_out FROM documents)
SELECT count(*) AS pages, 100.0::DOUBLE * count(*) FILTER (chars > 0) / greatest(1, count(*)) AS text_percent, count(DISTINCT dpi) AS dpis, min(dpi) AS dpi_from, max(dpi) AS dpi_to,
100.0::DOUBLE * CAST(coalesce(sum(bytes_out), 0) AS BIGINT) / greatest(1, CAST(coalesce(sum(bytes_in), 0) AS BIGINT)) AS size_percent FROM p""")
def index_statistics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return grid.index_statistics(docs.select(F.length("text").alias("chars"), (36 + F.col("n_chars") % 270).cast("int").alias("dpi"), F.octet_length("text").cast("long").alias("bytes_in"), F.length("text").cast("long").alias("bytes_out")))


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, max(l_partkey % 12000) AS px FROM lineitem WHERE l_linenumber % 3 <> 0 GROUP BY 1, 2),
s AS (SELECT l_orderkey, l_linenumber, max(l_suppkey % 900 + 1) AS pt FROM lineitem WHERE l_linenumber % 4 <> 0 GROUP BY 1, 2),
p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), j AS (SELECT p.*, px, pt, coalesce(px > 0 AND pt > 0, false) AS known FROM p LEFT JOIN i USING (l_orderkey, l_linenumber) LEFT JOIN s USING (l_orderkey, l_linenumber)),
d AS (SELECT *, CASE WHEN known THEN 72.0::DOUBLE * px / pt ELSE 300.0::DOUBLE END AS dpi0 FROM j)
SELECT l_orderkey, l_linenumber, greatest(36, CAST(round_even(CASE WHEN pt > 0 AND dpi0 * pt / 72.0::DOUBLE > 10000 THEN dpi0 * 10000 / (dpi0 * pt / 72.0::DOUBLE) ELSE dpi0 END, 0) AS INTEGER)) AS dpi,
CASE WHEN NOT known THEN 'asked' WHEN px > 10000 THEN 'scaled' ELSE 'native' END AS reason FROM d""")
def page_dpi(spark, sf_dir):
    """Resolution and its reason, by page from the images and the page sizes that there are."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    images = lines.where("l_linenumber % 3 <> 0").groupBy(*keys).agg(F.max(F.col("l_partkey") % 12000).alias("w"), F.lit(0).cast("long").alias("h"))
    sizes = lines.where("l_linenumber % 4 <> 0").groupBy(*keys).agg(F.max(F.col("l_suppkey") % 900 + 1).alias("w"), F.lit(0).cast("long").alias("h"))
    return grid.page_dpi(lines.select(*keys).distinct(), images, sizes, keys)


@query("""WITH x AS (SELECT label, unnest(embedding) AS v FROM embeddings) SELECT label, count(*) AS pixels, count(*) FILTER (v > 0.05) AS ink, count(*) FILTER (v > 0.05) / count(*)::DOUBLE AS density FROM x GROUP BY 1""")
def ink_density(spark, sf_dir):
    return grid.ink(table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("v")), "label", F.col("v") > 0.05)


@query("""WITH e AS (SELECT user_id, event_id, value < 5 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS width FROM events),
o AS (SELECT *, i - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM e WHERE flag),
r AS (SELECT user_id, width, count(*) AS length FROM o GROUP BY user_id, width, run HAVING max(i) < width)
SELECT u.user_id, count(*) FILTER (length > 0.04::DOUBLE * width) AS gaps, 1 + count(*) FILTER (length > 0.06::DOUBLE * width) AS columns FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id) GROUP BY 1""")
def column_runs(spark, sf_dir):
    return grid.column_runs(table(spark, sf_dir, "events"), "user_id", "event_id", F.col("value") < 5)


@query(_GRID + f""", k AS (SELECT p_partkey, sum((w - 192) * (h - 192)) AS shown FROM g WHERE {_DRAW} >= 0.25 AND w - 192 >= 16 AND h - 192 >= 16 GROUP BY 1),
e AS (SELECT p_partkey, sum(w * h) AS whole FROM g GROUP BY 1), shares AS (SELECT 100.0::DOUBLE * CAST(coalesce(shown, 0) AS BIGINT) / greatest(1, CAST(whole AS BIGINT)) AS percent FROM e LEFT JOIN k USING (p_partkey))
SELECT count(*) AS documents, round(avg(round(percent, 1)), 3) AS mean_percent FROM shares""")
def kit_mean_share(spark, sf_dir):
    tiles = _tiles(spark, sf_dir)
    return grid.shown_share(grid.kit_area(tiles, grid.kit(tiles, ["p_partkey", "tile"]), "p_partkey"))


_CORNERS = "SELECT CASE WHEN vec_id % 2 = 0 THEN 'x' ELSE 'y' END AS axis, vec_id AS id, vec_id + label % 3 AS match, (vec_id % 5) / 4.0::DOUBLE AS cost, vec_id + 1 AS neighbour FROM embeddings"


@query(f"SELECT axis, count(*) FILTER (cost < 0.6::DOUBLE) AS found, count(*) FILTER (cost < 0.6::DOUBLE AND match = neighbour) AS correct, count(*) FILTER (cost = 0) AS exact FROM ({_CORNERS}) GROUP BY 1")
def match_quality(spark, sf_dir):
    """Matches with a made-up cost against the next id as the true neighbour."""
    e = table(spark, sf_dir, "embeddings").select(F.when(F.col("vec_id") % 2 == 0, "x").otherwise("y").alias("axis"), F.col("vec_id").alias("id"), (F.col("vec_id") + F.col("label") % 3).alias("match"), (F.col("vec_id") % 5 / 4.0).alias("cost"))
    return grid.match_quality(e, e.select("axis", "id", (F.col("id") + 1).alias("neighbour")), 0.6)


@query(f"""WITH p AS (SELECT CASE WHEN contains(html, '{_HTML_MARKS[0]}') THEN 'heavy' WHEN contains(html, '{_HTML_MARKS[1]}') OR contains(html, '{_HTML_MARKS[2]}') THEN 'routine' END AS bucket FROM pages)
SELECT count(*) AS files, count(*) FILTER (bucket = 'heavy') AS heavy, count(*) FILTER (bucket = 'routine') AS routine FROM p""")
def safety_totals(spark, sf_dir):
    return pdf_marks.totals(mark_counts(spark, sf_dir))


@query(rf"""WITH w AS (SELECT d.source, d.text, regexp_extract_all(text, '\p{{L}}{{2,}}') AS words FROM documents d WHERE text IS NOT NULL AND trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''),
c AS (SELECT source, CASE WHEN len(words) = 0 THEN 1.0::DOUBLE ELSE 1 - len(list_filter(words, lambda w: length(w) >= 3 AND greatest(length(regexp_replace(w, '[^А-яЁё]', '', 'g')), length(regexp_replace(w, '[^A-Za-z]', '', 'g'))) > 0.9::DOUBLE * length(w)))::DOUBLE / len(words) END AS junk FROM w)
SELECT source, count(*) AS judged, round(avg(junk), 6) AS mean_junk FROM c GROUP BY 1""")
def mean_junk(spark, sf_dir):
    """Mean junk of the texts that have any; blank ones aren't judged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = junk_share(spark, sf_dir).select("doc_id", "junk").join(docs, "doc_id").where("junk is not null")
    return rows.groupBy("source").agg(F.count("junk").alias("judged"), text.rounded(F.avg("junk"), 6).alias("mean_junk"))


@query(r"""SELECT count(*) AS n, count(*) FILTER (run >= full_ AND full_ > 0) AS exact, count(*) FILTER (run >= full_ AND full_ > 0) / greatest(1, count(*))::DOUBLE AS share, coalesce(sum(run), 0) / greatest(1, count(*))::DOUBLE AS mean_run,
count(*) > 0 AND count(*) FILTER (run >= full_ AND full_ > 0) / greatest(1, count(*))::DOUBLE <= 0.01 AND coalesce(sum(run), 0) / greatest(1, count(*))::DOUBLE <= 8 AS ok
FROM (SELECT least(48, len(b)) AS full_, coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1), lambda j: coalesce(a[j] = b[j], false)), false) - 1, greatest(len(a), len(b))) AS run
      FROM (SELECT string_split_regex(trim(d.text), '\s+')[1:48] AS a, string_split_regex(trim(i.text), '\s+')[1:48] AS b FROM documents d JOIN benchmark i ON d.doc_id = i.item_id WHERE d.text IS NOT NULL AND trim(d.text) <> '' AND i.text IS NOT NULL AND trim(i.text) <> ''))""")
def leak_by_id(spark, sf_dir):
    """The leak metric with document i taken as what a model went on with for item i, from the first word."""
    words = lambda c: F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != "")
    d = table(spark, sf_dir, "documents").where("trim(text) <> ''").select("doc_id", words("text").alias("a"))
    i = table(spark, sf_dir, "benchmark").where("trim(text) <> ''").select(F.col("item_id").alias("doc_id"), words("text").alias("b"))
    return fold.leak(d.join(i, "doc_id"), "b", "a")


# ---- plans, totals, order -------------------------------------------------------------------------


@query(_CLASSIFIED + f"SELECT source AS repo, count(*) AS files, round(CAST(sum(strlen(text)) AS BIGINT) / 1048576.0::DOUBLE, 2) AS mib FROM rows_ WHERE verdict <> '{rules.PUBLIC}' GROUP BY 1")
def private_plan(spark, sf_dir):
    return census.plan(_classified(spark, sf_dir).withColumns({"repo": F.col("source"), "bytes": F.octet_length("text").cast("long")}))


@query("""WITH z AS (SELECT lang AS zone, CASE WHEN lang <> 'de' THEN count(*) END AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1)
SELECT zone, n FROM z UNION ALL SELECT NULL, CAST(sum(coalesce(n, 0)) AS BIGINT) FROM z""")
def moved_total(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("lang is not null").select(F.col("lang").alias("zone"))
    return census.moved_total(census.moved_by_zone(docs.distinct().withColumn("reachable", F.col("zone") != "de"), docs))


@query("SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def fetched_once(spark, sf_dir):
    """Part names for order lines: a key is asked for once, however many lines have it."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return census.fetch_once(lines, "l_partkey", table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"))


@query(_CLASSIFIED + f"SELECT CAST(CASE verdict {' '.join(f'WHEN {_q(v)} THEN {i}' for i, v in enumerate(rules.VERDICTS))} ELSE {len(rules.VERDICTS)} END AS INTEGER) AS section, verdict, source, doc_id FROM rows_ ORDER BY 1, 3, 4")
def rights_sections(spark, sf_dir):
    """Rows of a report: sections by verdict in their fixed order, by source and id inside."""
    return classify.sections(_classified(spark, sf_dir).select("verdict", "source", "doc_id"), "verdict", "source", "doc_id").select("section", "verdict", "source", "doc_id")


@query("""WITH h AS (SELECT doc_id, sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE text IS NOT NULL)
SELECT sha256, count(*) AS n, min(doc_id) AS first_id, CAST(min_by(bytes, doc_id) * (count(*) - 1) AS BIGINT) AS wasted FROM h GROUP BY 1 HAVING count(*) > 1 ORDER BY wasted DESC, sha256""")
def duplicate_groups_by_size(spark, sf_dir):
    return exact_duplicate_groups(spark, sf_dir).orderBy(F.desc("wasted"), "sha256")


_RULES = "SELECT * FROM (VALUES (3, 'c', 'x/'), (1, 'a', ''), (2, 'b', 'y/z')) t(place, repo, include)"


@query(f"SELECT d.doc_id, r.place, r.repo FROM documents d JOIN ({_RULES}) r ON d.doc_id % 3 + 1 = r.place ORDER BY r.place, d.source, d.doc_id")
def files_by_rule(spark, sf_dir):
    """Files in the order of their rules, then by path."""
    some = spark.createDataFrame([(3, "c", "x/"), (1, "a", ""), (2, "b", "y/z")], "place int, repo string, include string").orderBy("place")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("doc_id") % 3 + 1).cast("int").alias("place"))
    return docs.join(F.broadcast(some), "place").orderBy("place", "source", "doc_id").select("doc_id", "place", "repo")


@query("SELECT user_id, CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60) + 1 AS BIGINT) AS beats FROM events GROUP BY 1")
def heartbeats(spark, sf_dir):
    return census.heartbeats(table(spark, sf_dir, "events"), "user_id", "ts")


@query("""WITH s AS (SELECT DISTINCT event_type AS step FROM events), d AS (SELECT DISTINCT event_type AS step FROM events WHERE user_id = 8)
SELECT step, d.step IS NULL OR step IN ('error') AS run FROM s LEFT JOIN d USING (step)""")
def steps_to_run(spark, sf_dir):
    """Event types as steps, done where user 8 has them; errors always run."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("step"), "user_id")
    return census.to_run(e.select("step").distinct(), e.where("user_id = 8").select("step", F.lit(0).alias("code")), always=("error",))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at, coalesce(json_extract_string(props, '$.missing'), '—') AS note FROM events")
def event_stamps(spark, sf_dir):
    """Dates and times as they are written, and a field that may be missing."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", F.date_format(ts, "yyyy-MM-dd").alias("day"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("at"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("—")).alias("note"))


@query("SELECT label, CAST(sum(len(embedding) * 4) AS BIGINT) AS bytes FROM embeddings GROUP BY 1")
def parameter_bytes(spark, sf_dir):
    """Weight of parameters: elements times the size of one."""
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.sum(F.size("embedding") * F.lit(4).cast("long")).alias("bytes"))


@query(rf"""WITH p AS (SELECT page_id, '/site/' || {_URL} AS p FROM pages)
SELECT page_id, CASE WHEN starts_with(p, '/site/fr/') THEN substr(p, 10) ELSE p END AS below, CASE WHEN starts_with({_URL.replace("url", "u")}, '/') THEN {_URL.replace("url", "u")} ELSE '/root/' || {_URL.replace("url", "u")} END AS whole,
regexp_extract(p, '^(.*/)?[^/]*$', 1) || 'index' AS renamed, CASE regexp_extract(u, 'example\.(\w+)', 1) WHEN 'com' THEN 'commercial' ELSE regexp_extract(u, 'example\.(\w+)', 1) END AS platform
FROM p JOIN (SELECT page_id, url AS u FROM pages) USING (page_id)""")
def path_forms(spark, sf_dir):
    """Relative and absolute forms, another last part, and a name by a table."""
    pages = table(spark, sf_dir, "pages").withColumn("rel", text.url_path("url")).withColumn("p", F.concat(F.lit("/site/"), "rel"))
    host = F.regexp_extract("url", r"example\.(\w+)", 1)
    return pages.select("page_id", text.relative(F.col("p"), F.lit("/site/fr")).alias("below"), text.absolute(F.col("rel"), F.lit("/root/")).alias("whole"), text.with_name(F.col("p"), F.lit("index")).alias("renamed"), text.platform_name(host, {"com": "commercial"}).alias("platform"))


@query(_CLASSIFIED + f"SELECT source, '# ' || source || chr(10) || count(*) FILTER (verdict = '{rules.CLOSED}') || ' closed, ' || count(*) FILTER (verdict = '{rules.UNKNOWN}') || ' undetermined, — moved' AS notice FROM rows_ GROUP BY 1")
def notices(spark, sf_dir):
    """A notice per source, from its verdict counts; what isn't known is a dash."""
    counts = classify.by_group(_classified(spark, sf_dir), "source")
    return counts.select("source", files.filled("# {repo}\n{closed} closed, {unknown} undetermined, {moved} moved", repo=F.col("source"), closed=F.col("closed"), unknown=F.col("undetermined"), moved=F.lit(None)).alias("notice"))


@query("""SELECT conv_id, CAST(ceil(ceil(count(*) / 8.0) * 2) AS BIGINT) AS steps, round(CAST(ceil(ceil(count(*) / 8.0) * 2) AS BIGINT) * (1 + conv_id % 5)::DOUBLE / 3600.0::DOUBLE, 2) AS hours FROM conversations GROUP BY 1""")
def training_hours(spark, sf_dir):
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    steps = census.steps(F.col("turns"), 1, 8, 2)
    return n.select("conv_id", steps.alias("steps"), census.hours(steps, (1 + F.col("conv_id") % 5).cast("double")).alias("hours"))


# ---- readers of one field -------------------------------------------------------------------------


@query("SELECT p_partkey, (p_partkey % 900 + 1)::DOUBLE + 0.5 AS w, (p_size * 10)::DOUBLE AS h FROM part")
def page_size_lines(spark, sf_dir):
    """Page sizes in points from lines of a page listing."""
    line = F.concat(F.lit("Page 1 size: "), F.col("p_partkey") % 900 + 1, F.lit(".5 x "), F.col("p_size") * 10, F.lit(" pts (A4)"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(files.page_sizes(line)).alias("s")).select("p_partkey", "s.w", "s.h")


@query("""SELECT doc_id, unnest(CASE doc_id % 4 WHEN 0 THEN [source || '/a.md'] WHEN 1 THEN [source || '/a.md', source || '/b'] WHEN 2 THEN [source || '/b'] ELSE [] END) AS path FROM documents WHERE source IS NOT NULL""")
def event_paths(spark, sf_dir):
    """File paths that tool events name, in either of two fields, both or none."""
    kind, docs = F.col("doc_id") % 4, table(spark, sf_dir, "documents").where("source is not null")
    fields = F.struct(F.when(kind < 2, F.concat("source", F.lit("/a.md"))).alias("file_path"), F.when(kind.isin(1, 2), F.concat("source", F.lit("/b"))).alias("path"))
    return docs.select("doc_id", F.explode(gate.event_paths(F.to_json(F.struct(fields.alias("tool_input"))))).alias("path"))


@query("SELECT doc_id, source || '/' || doc_id AS path FROM documents WHERE doc_id % 5 <> 3")
def staged_paths(spark, sf_dir):
    """Paths of NUL-separated listings: what was added, copied, modified or renamed, not deleted."""
    state = _pick(("A", "C", "M", "D", "R100"), F.col("doc_id") % 5)
    listing = F.concat(state, F.lit("\0"), _path(), F.lit("\0D\0gone.md\0"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(gate.changed(listing)).alias("path"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '—' ELSE 'T ' || page_id END AS title, CASE WHEN page_id % 2 = 0 THEN 'A, B' ELSE '—' END AS authors, '2024-01-02' AS published FROM pages")
def preprint_entries(spark, sf_dir):
    """Fields of stored entries, with dashes for what is missing."""
    author = F.when(F.col("page_id") % 2 == 0, "<author><name>A</name></author><author><name>B</name></author>").otherwise("")
    title = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(F.lit("<title>T\n "), "page_id", F.lit("</title>")))
    xml = F.concat(F.lit('<feed xmlns="http://x/"><entry>'), title, author, F.lit("<published>2024-01-02</published></entry></feed>"))
    got = files.atom_entry(xml)
    return table(spark, sf_dir, "pages").select("page_id", *(got[c].alias(c) for c in ("title", "authors", "published")))


@query("SELECT doc_id, ['pdf', 'djvu', 'pdf', 'unknown'][doc_id % 4 + 1] AS kind FROM documents")
def file_kinds(spark, sf_dir):
    """Kinds by the first bytes, else by the extension."""
    at = F.col("doc_id") % 4
    path = F.concat("doc_id", _pick((".txt", ".bin", ".PDF", ".md"), at))
    content = F.unhex(_pick(("255044462D312E37", "41542654464F524D0000", "00", "504B0304"), at))
    return table(spark, sf_dir, "documents").select("doc_id", files.kind(path, content).alias("kind"))


@query("SELECT p_partkey, CAST(p_size * 512 AS BIGINT) AS mib, round(p_partkey * 1000 / 1048576.0::DOUBLE, 2) AS size FROM part")
def device_memory(spark, sf_dir):
    """MiB in device lines, where digits of a card's name don't count, and sizes in MiB."""
    line = F.concat(F.lit("Card 3060 Ti, "), F.col("p_size") * 512, F.lit(" MiB, 7"))
    return table(spark, sf_dir, "part").select("p_partkey", text.memory_mib(line).alias("mib"), (F.col("p_partkey") * 1000).alias("size")).withColumn("size", text.mib("size"))


@query("""WITH v AS (SELECT p_partkey, p_partkey % 9001 + 1 AS w, p_size * 97 + 50 AS h FROM part), r AS (SELECT *, least(1.0::DOUBLE, 3000 / greatest(w, h)::DOUBLE) AS q FROM v)
SELECT p_partkey, CAST(trunc(w * q) AS INTEGER) AS w, CAST(trunc(h * q) AS INTEGER) AS h FROM r""")
def clamped_sizes(spark, sf_dir):
    v = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 9001 + 1).alias("w"), (F.col("p_size") * 97 + 50).alias("h"))
    return v.select("p_partkey", *(c.alias(k) for k, c in grid.clamped("w", "h", 3000).items()))


@query(_GRID + f"SELECT p_partkey, CAST(tile AS INTEGER) AS tile, w - 192 AS crop_w, h - 192 AS crop_h, greatest(1, CAST(trunc((w - 192) * 0.5::DOUBLE) AS INTEGER)) AS out_w, greatest(1, CAST(trunc((h - 192) * 0.5::DOUBLE) AS INTEGER)) AS out_h FROM g WHERE {_DRAW} >= 0.25 AND w - 192 >= 16 AND h - 192 >= 16")
def kit_crops(spark, sf_dir):
    return grid.kit(_tiles(spark, sf_dir), ["p_partkey", "tile"]).select("p_partkey", "tile", "crop_w", "crop_h", "out_w", "out_h")


_BYTE_MARKS = ("<p", "</p", "<a")


@query(" UNION ALL ".join(f"SELECT CAST(page_id AS VARCHAR) AS path, '{m}' AS mark, len(regexp_extract_all(html, '{m}([^A-Za-z0-9]|$)')) AS n FROM pages WHERE regexp_matches(html, '{m}([^A-Za-z0-9]|$)')" for m in _BYTE_MARKS))
def byte_marks(spark, sf_dir):
    """Marks in the bytes of pages; a longer name isn't a mark."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.encode("html", "UTF-8").alias("content"))
    return pdf_marks.marks(pages, _BYTE_MARKS)


@query("SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def own_states(spark, sf_dir):
    """State that was written from one folder (an event type here); the rest is foreign."""
    e = table(spark, sf_dir, "events").withColumn("folder", F.col("event_type"))
    return census.own_state(e, "error").groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS INTEGER) AS place FROM documents QUALIFY place <= 20")
def first_shuffled(spark, sf_dir):
    """The first 20 documents of a seeded shuffle, with their places."""
    first = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.concat_ws("|", F.lit(7), "doc_id").cast("binary")).alias("k")).orderBy("k", "doc_id").limit(20)
    return first.withColumn("place", F.row_number().over(Window.orderBy("k", "doc_id"))).select("doc_id", "place")
