"""Queries over files: rows of the given tables are written as files, and what the scans, readers, sinks and moves
make of these is compared with the tables."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from .. import shared
from ..sources import files, marks, moves
from .corpus import _q, query, table

#: Where a document stands as a file: its source, language (hidden below .git for one, tools/ for another) and extension.
_DIR = "CASE source WHEN 'src3' THEN '.git/x' WHEN 'src5' THEN 'tools/' || lang WHEN 'src7' THEN 'sub/.git' ELSE source || '/' || lang END"
_EXT = "CASE lang WHEN 'en' THEN 'pdf' WHEN 'fr' THEN 'PDF' WHEN 'de' THEN 'djvu' ELSE 'txt' END"
_FILES = f"f AS (SELECT doc_id, source, lang, text, {_DIR} || '/' || doc_id || '.' || {_EXT} AS rel, CAST(strlen(text) AS BIGINT) AS bytes, lower({_EXT}) AS ext FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL)"
_KEPT = "source NOT IN ('src3', 'src7')"


def _documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null and lang is not null and source is not null")
    return docs.select("doc_id", "source", "lang", "text", F.expr(f"{_DIR} || '/' || doc_id || '.' || {_EXT}").alias("rel"))


def _tree(spark, sf_dir, rows=None):
    root = shared.fresh(spark, "tree")
    files.write_files(_documents(spark, sf_dir) if rows is None else rows, root, "rel", "text")
    return root


@query(f"WITH {_FILES} SELECT rel, bytes, ext FROM f WHERE {_KEPT} AND ext IN ('pdf', 'djvu')")
def scanned_files(spark, sf_dir):
    """The census of a tree: kinds in any case, nothing of version control."""
    return files.scan(spark, _tree(spark, sf_dir), ["pdf", "djvu"]).select("rel", "bytes", "ext")


@query(f"WITH {_FILES} SELECT CASE WHEN quality = 1 THEN 'public' ELSE 'private' END AS zone, rel, bytes FROM f JOIN labels USING (doc_id) WHERE {_KEPT}")
def scanned_zones(spark, sf_dir):
    """The census of two zones."""
    rows = _documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    zones = {"public": _tree(spark, sf_dir, rows.where("quality = 1")), "private": _tree(spark, sf_dir, rows.where("quality is distinct from 1"))}
    return files.scan_zones(spark, zones).select("zone", "rel", "bytes")


@query(f"WITH {_FILES} SELECT rel FROM f WHERE {_KEPT} AND source <> 'src5' AND ext IN ('pdf', 'djvu')")
def scanned_unmanaged(spark, sf_dir):
    """The census without folders of the toolkit's own."""
    return files.scan_unmanaged(spark, _tree(spark, sf_dir), ["pdf", "djvu"]).select("rel")


@query(f"WITH {_FILES} SELECT rel FROM f WHERE {_KEPT} AND ext = 'pdf'")
def scanned_pdfs(spark, sf_dir):
    return files.scan(spark, _tree(spark, sf_dir), ["pdf"]).select("rel")


@query("SELECT page_id || '.png' AS rel, CAST(strlen(html) AS BIGINT) AS bytes FROM pages WHERE starts_with(url, 'https') AND html IS NOT NULL")
def scanned_folder(spark, sf_dir):
    """One folder alone, of images by extension; what lies below it isn't looked at."""
    rel = F.when(F.startswith("url", F.lit("https")), F.concat("page_id", F.lit(".png"))).otherwise(F.concat(F.lit("below/"), "page_id", F.lit(".png")))
    root = _tree(spark, sf_dir, table(spark, sf_dir, "pages").select(rel.alias("rel"), F.col("html").alias("text")))
    return files.scan(spark, root, ["png", "jpg"], recursive=False).select("rel", "bytes")


@query("SELECT page_id || '.jpg' AS rel FROM pages WHERE html IS NOT NULL AND NOT EXISTS (FROM pages WHERE url LIKE '%.png') UNION ALL SELECT page_id || '.png' FROM pages WHERE html IS NOT NULL AND url LIKE '%.png'")
def scanned_tiles(spark, sf_dir):
    """Tiles of the first kind that occurs."""
    rel = F.concat("page_id", F.when(F.endswith("url", F.lit(".png")), ".png").otherwise(".jpg"))
    root = _tree(spark, sf_dir, table(spark, sf_dir, "pages").select(rel.alias("rel"), F.col("html").alias("text")))
    return files.first_kind(files.scan(spark, root, ["png", "jpg"])).select("rel")


# ---- JSON and text -------------------------------------------------------------------------------


@query("SELECT doc_id, quality, toxic FROM labels")
def json_there_and_back(spark, sf_dir):
    """A table as JSON lines, read with a declared schema."""
    path = shared.fresh(spark, "json")
    files.write_json(table(spark, sf_dir, "labels"), path)
    return files.json_table(spark, path, "doc_id long, quality int, toxic int", lines=True)


@query("SELECT doc_id, quality FROM labels WHERE toxic = 0")
def json_damaged(spark, sf_dir):
    """Lines that don't read (those of toxic documents, cut short) and a path that isn't there are left out."""
    path = shared.fresh(spark, "json")
    whole = F.to_json(F.struct("doc_id", "quality"))
    table(spark, sf_dir, "labels").select(F.when(F.col("toxic") == 0, whole).otherwise(F.expr("left(to_json(struct(doc_id, quality)), 9)")).alias("value")).write.text(path)
    schema = "doc_id long, quality int"
    return files.json_table(spark, path, schema, lines=True).unionByName(files.json_table(spark, f"{path}-none", schema))


@query("SELECT CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS turn, role, text FROM conversations WHERE conv_id IS NOT NULL")
def chat_there_and_back(spark, sf_dir):
    """Conversations as chat lines, read again."""
    path = shared.fresh(spark, "chat")
    files.chat_json(table(spark, sf_dir, "conversations")).write.text(path)
    return files.chat_lines(spark, path).select("turn", "role", "text")


@query("SELECT source, lang, count(*) AS lines, CAST(sum(length(replace(text, chr(10), ' '))) AS BIGINT) AS chars FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2")
def texts_by_folder(spark, sf_dir):
    """Texts written into folders by source and language, counted from there."""
    path = shared.fresh(spark, "texts")
    files.write_texts(_documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit(" "))), path, "text", ["source", "lang"])
    got = spark.read.option("lineSep", "\n").text(path)
    return got.groupBy("source", "lang").agg(F.count("*").alias("lines"), F.sum(F.length("value")).alias("chars"))


@query(f"WITH {_FILES} SELECT rel, bytes, sha256(text) AS sha256, 'copied' AS status FROM f")
def moved_files(spark, sf_dir):
    """Files that were copied, verified and deleted where they came from."""
    root, to = _tree(spark, sf_dir), shared.fresh(spark, "moved")
    rows = _documents(spark, sf_dir)
    plan = rows.select(F.concat(F.lit(f"{root}/"), "rel").alias("src"), F.concat(F.lit(f"{to}/"), "rel").alias("dst"), F.sha2("text", 256).alias("sha256"))
    log = shared.fresh(spark, "moves")
    done = moves.copy(plan, log)
    gone = moves.delete_sources(spark, log)
    kept = done.where("status = 'copied'") if gone else done
    return kept.select(F.substring_index("dst", f"{to}/", -1).alias("rel"), "bytes", "sha256", "status")


@query("""SELECT page_id, '# ' || CASE WHEN url LIKE '%/en/%' THEN 'T ' || page_id ELSE '—' END || chr(10) || 'Authors: A, B' || chr(10) || 'Licence: —' || chr(10) || 'Published: 2024-01-02' AS card FROM pages""")
def preprint_cards(spark, sf_dir):
    """Cards from stored entries, with dashes for what is missing."""
    title = F.when(F.contains("url", F.lit("/en/")), F.concat(F.lit("<title>T\n "), "page_id", F.lit("</title>"))).otherwise("")
    xml = F.concat(F.lit('<feed xmlns="http://x/"><entry>'), title, F.lit("<author><name>A</name></author><author><name>B</name></author><published>2024-01-02</published></entry></feed>"))
    card = files.filled("# {title}\nAuthors: {authors}\nLicence: {license}\nPublished: {published}", **files.atom_entry(xml))
    return table(spark, sf_dir, "pages").select("page_id", card.alias("card"))


# ---- marks in bytes ------------------------------------------------------------------------------

_PLANTED = ("/JavaScript", "/OpenAction", "/URI", "/XFA")
_MARKED = f"m AS (SELECT page_id, html || CASE WHEN url LIKE 'https%' THEN ' {_PLANTED[0]} {_PLANTED[1]} ' ELSE ' {_PLANTED[1]}x ' END || CASE WHEN url LIKE '%/en/%' THEN ' {_PLANTED[3]}' ELSE ' {_PLANTED[1]}.' END AS body FROM pages WHERE html IS NOT NULL)"


def _streams(spark, sf_dir):
    """Files whose body is one deflated stream."""
    head = F.when(F.startswith("url", F.lit("https")), f" {_PLANTED[0]} {_PLANTED[1]} ").otherwise(f" {_PLANTED[1]}x ")
    tail = F.when(F.contains("url", F.lit("/en/")), f" {_PLANTED[3]}").otherwise(f" {_PLANTED[1]}.")
    rows = table(spark, sf_dir, "pages").where("html is not null").select(F.col("page_id").cast("string").alias("path"), F.concat("html", head, tail).cast("binary").alias("content"))

    def deflate(batches):
        import pyarrow as pa

        for b in batches:
            made = [b"%PDF-1.7\nstream\r\n" + zlib.compress(x.as_py()) + b"endstream\nstream\nnot deflated at all, but longendstream" for x in b.column("content")]
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(made, pa.binary())], names=["path", "content"])

    return rows.mapInArrow(deflate, rows.schema)


@query(f"WITH {_MARKED} SELECT CAST(page_id AS VARCHAR) AS path, k AS mark, CAST(len(regexp_extract_all(body, k || '([^A-Za-z0-9]|$)')) AS BIGINT) AS n FROM m, (SELECT unnest([{', '.join(map(_q, _PLANTED[:2] + _PLANTED[3:]))}]) AS k) WHERE regexp_matches(body, k || '([^A-Za-z0-9]|$)')")
def marks_in_streams(spark, sf_dir):
    """Marks inside streams that inflate; those that don't are passed over."""
    return marks.marks(_streams(spark, sf_dir))


@query(
    f"""WITH {_MARKED}, k AS (SELECT page_id, list_filter(['/JavaScript', '/XFA'], lambda k: regexp_matches(body, k || '([^A-Za-z0-9]|$)')) AS heavy, list_filter(['/OpenAction'], lambda k: regexp_matches(body, k || '([^A-Za-z0-9]|$)')) AS routine FROM m)
SELECT CAST(page_id AS VARCHAR) AS path, array_to_string(heavy, ',') AS heavy, array_to_string(routine, ',') AS routine, CASE WHEN len(heavy) > 0 THEN 'heavy' ELSE 'routine' END AS bucket FROM k WHERE len(heavy) + len(routine) > 0"""
)
def mark_buckets(spark, sf_dir):
    """Files by the worst mark they have, with the marks of both kinds."""
    got = marks.buckets(marks.marks(_streams(spark, sf_dir)))
    return got.select("path", F.array_join("heavy", ",").alias("heavy"), F.array_join("routine", ",").alias("routine"), "bucket")
