"""WARC archives, index first: whoever writes or scans an archive makes a row of file, offset, length,
address and digest for every record; reading begins with rows of that index, sorts them, joins
neighbouring byte ranges and touches nothing else of the archives.

Every record is a gzip member of its own. A response holds an HTTP head and the payload; a payload
that occurs again is a revisit, with the head alone. Archives bear random names and only index rows of tasks
that ended name them, so a task that is lost and runs again leaves an orphan that no one reads.

Defined results: a null or empty body is an empty payload. Of rows with equal payloads of at least
`least` bytes, the one with the largest id (null is smaller than any; of equal ids that with the larger
url, null again the smallest) is the response; of rows that are equal in id, url and payload one is it and
the others revisit it. Shorter payloads are all responses. Addresses may be null, empty, or of any characters: the archive holds
them percent-encoded. Empty tables make an empty index. A record that can't be read back, or whose
payload hasn't the digest written beside it, comes back with intact false.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, durable, shared_folder

#: Bytes of an archive after which the next is begun; of a join of ranges; between records of one read; of records a read task gets.
ARCHIVE, SPAN, GAP, TASK = 1 << 30, 8 << 20, 1 << 16, 32 << 20
INDEX = "file string, offset long, length long, url string, digest string, kind string, id long"
RECORD = "id long, kind string, refers_to long, url string, digest string, payload_bytes long, intact boolean"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STEP = 1 << 16


def store(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder or file, and its path there."""
    if not re.match(r"[a-z][a-z0-9+.-]*:/", uri):
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", uri)))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _name(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def record(kind: str, name: str, url: str | None, date: str, digest: str, size: int, payload: bytes, key: int | None, refers: tuple[int | None, str] | None) -> bytes:
    """A record as a gzip member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=-._~"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if key is not None:
        head.append(f"X-Record-Key: {key}")
    if refers is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {refers[1]}", *([f"X-Refers-To-Key: {refers[0]}"] if refers[0] is not None else [])]
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def parse(raw: bytes) -> tuple[dict[str, str], bytes | None, int | None]:
    """Header fields, payload (None unless whole) and the payload's length by its HTTP head, of a record
    with or without gzip around it."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    named = fields(head)
    size = int(named["content-length"])
    if len(rest) < size:
        raise ValueError("the record is cut")
    block = rest[:size]
    if "application/http" not in named.get("content-type", ""):
        return named, block, size
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields(http).get("content-length")
    return named, None if named.get("warc-type") == "revisit" else payload, int(said) if said is not None else len(payload)


# ---- writing -----------------------------------------------------------------------------------


def decisions(rows: DataFrame, least: int) -> DataFrame:
    """digest, top (id, url, rows like it) of every payload that occurs more than once. Only ids,
    addresses and digests travel, counted before they do."""
    each = rows.where(F.col("bytes") >= least).groupBy("digest", "id", "url").agg(F.count("*").alias("n"))
    return each.groupBy("digest").agg(F.sum("n").alias("_n"), F.max(F.struct("id", "url", "n")).alias("top")).where("_n > 1").drop("_n")


def _dealt(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with kind and refers (id and url of the response, for revisits), payloads of revisits left out."""
    joined = rows.join(groups, "digest", "left")
    top = F.col("top").isNotNull() & F.col("id").eqNullSafe(F.col("top.id")) & F.col("url").eqNullSafe(F.col("top.url"))
    names = ["id", "url", "digest", "bytes", "payload", "kind", "refers"]
    refers = F.struct(F.col("top.id").alias("id"), F.col("top.url").alias("url"))
    out = joined.where(~top | F.col("top").isNull() | (F.col("top.n") == 1))
    out = out.withColumns({"kind": F.when(F.col("top").isNull() | top, "response").otherwise("revisit"), "refers": F.when(F.col("top").isNotNull() & ~top, refers)})
    out = out.withColumn("payload", F.when(F.col("kind") == "response", F.col("payload"))).select(*names)
    if groups.where("top.n > 1").isEmpty():
        return out
    # Rows alike in everything: one response, and revisits made from their number.
    twins = joined.where(top & (F.col("top.n") > 1)).groupBy("digest").agg(*(F.first(c).alias(c) for c in ("id", "url", "bytes", "payload", "top")))
    one = twins.withColumns({"kind": F.lit("response"), "refers": F.lit(None).cast(out.schema["refers"].dataType)}).select(*names)
    size = rows.select("digest", "bytes").join(groups.where("top.n > 1").select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first("bytes").alias("bytes"))
    some = groups.where("top.n > 1").join(size, "digest")
    some = some.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("top.n") - 1, F.lit(_STEP).cast("long"))))
    some = some.withColumn("_i", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + _STEP - 1, F.col("top.n") - 1))))
    more = some.select(F.col("top.id").alias("id"), F.col("top.url").alias("url"), "digest", "bytes", F.lit(None).cast("binary").alias("payload"), F.lit("revisit").alias("kind"), refers.alias("refers"))
    return out.unionByName(one).unionByName(more)


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row to archives in folder (one in the shared folder, if not given) and return
    the index, itself a durable table: file, offset, length, url, digest, kind, id."""
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/marlstone/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    body = F.coalesce(F.col(body_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    groups = durable(decisions(rows, least), "warc-groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(folder)
        out, at, path, nth = None, 0, "", 0
        try:
            for b in batches:
                made = []
                for r in zip(*(b.column(c) for c in ("id", "url", "digest", "bytes", "payload", "kind", "refers")), strict=True):
                    key, url, digest, size, payload, kind, refers = (c.as_py() for c in r)
                    digest = base32(bytes.fromhex(digest))
                    if out is None or at >= ARCHIVE:
                        if out is not None:
                            out.close()
                        else:
                            fs.create_dir(base, recursive=True)
                        path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                        out, at = fs.open_output_stream(path, compression=None), 0
                    name = _name(key, url, digest) if kind == "response" and size >= least else _name(path, nth)
                    raw = record(kind, name, url, date, digest, size, payload or b"", key, refers and (refers["id"], _name(refers["id"], refers["url"], digest)))
                    out.write(raw)
                    made.append((f"{folder}/{path.rsplit('/', 1)[1]}", at, len(raw), url, digest, kind, key))
                    at, nth = at + len(raw), nth + 1
                yield _batch(made, INDEX)
        finally:
            if out is not None:
                out.close()

    index = durable(_dealt(rows, groups).mapInArrow(run, INDEX), "warc-index")
    discard(groups)
    return index


_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    named = [c.split() for c in ddl.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, named, strict=True)], names=[n for n, _ in named])


# ---- reading -----------------------------------------------------------------------------------


def spans(rows: list[tuple[str, int, int]], span: int = SPAN, gap: int = GAP) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """file, start, end and the records (offset, length) in them, of sorted rows: neighbours with at most
    gap bytes between them are read at once, up to span bytes."""
    file, start, end, inside = "", 0, 0, []
    for f, offset, length in rows:
        if inside and (f != file or offset - end > gap or offset + length - start > span):
            yield file, start, end, inside
            inside = []
        if not inside:
            file, start, end = f, offset, offset
        inside.append((offset, length))
        end = max(end, offset + length)
    if inside:
        yield file, start, end, inside


def read(index: DataFrame, payload: bool = True, span: int = SPAN, gap: int = GAP) -> DataFrame:
    """Records of the index rows given, however few of an archive's: id, kind, refers_to, url, digest,
    payload_bytes (of the full payload, for revisits too), intact, and the payload (null for revisits),
    if wanted. Ranges are dealt out by (file, offset), not by file."""
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // TASK))
    ddl = RECORD + (", payload binary" if payload else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = ("", None)
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            for file, start, end, inside in spans(rows, span, gap):
                if opened[0] != file:
                    fs, path = store(file)
                    opened = (file, fs.open_input_file(path))
                raw = opened[1].read_at(end - start, start)
                made = [_record(raw[o - start : o - start + n], payload) for o, n in inside]
                yield _batch(made, ddl)

    return index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, ddl)


def _record(raw: bytes, payload: bool) -> tuple:
    try:
        named, body, size = parse(raw)
    except (ValueError, KeyError, zlib.error):
        return (None, None, None, None, None, None, False, *([None] if payload else []))
    said = named.get("warc-payload-digest", "").removeprefix("sha1:")
    found = base32(hashlib.sha1(body).digest()) if body is not None else said
    number = lambda k: int(named[k]) if k in named else None
    url = unquote(named["warc-target-uri"]) if "warc-target-uri" in named else None
    intact = not said or found == said and (body is None or size == len(body))
    return (number("x-record-key"), named.get("warc-type"), number("x-refers-to-key"), url, found, size, intact, *([body] if payload else []))


def scan(spark: SparkSession, files: list[str]) -> DataFrame:
    """The index of archives that came without one (a gzip member per record), read once from end to end
    in pieces, an archive a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file in b.column("file").to_pylist():
                fs, path = store(file)
                with fs.open_input_stream(path, compression=None) as f:
                    at, left, made = 0, b"", []
                    while left or (left := f.read(_STEP)):
                        one, length, parts = zlib.decompressobj(31), 0, []
                        while not one.eof and (left or (left := f.read(_STEP))):
                            parts.append(one.decompress(left))
                            length, left = length + len(left) - len(one.unused_data), one.unused_data
                        if not one.eof:
                            break  # a member that is cut off
                        named, body, _ = parse(b"".join(parts))
                        key = named.get("x-record-key")
                        said = named.get("warc-payload-digest", "").removeprefix("sha1:")
                        made.append((file, at, length, unquote(named["warc-target-uri"]) if "warc-target-uri" in named else None, said or base32(hashlib.sha1(body or b"").digest()), named.get("warc-type"), int(key) if key else None))
                        at += length
                        if len(made) >= 1000:
                            yield _batch(made, INDEX)
                            made = []
                    yield _batch(made, INDEX)

    return spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files))).mapInArrow(run, INDEX)


def full_payloads(records: DataFrame) -> DataFrame:
    """Records of read(), revisits with the payload of the response they refer to."""
    given = records.where("kind = 'response'").select("digest", "payload").groupBy("digest").agg(F.first("payload").alias("_given"))
    return records.join(given, "digest", "left").withColumn("payload", F.coalesce("payload", "_given")).drop("_given")


# ---- the query ---------------------------------------------------------------------------------

_B32 = " || ".join(f"translate(to_base(CAST('0x' || substr(h, {1 + 10 * i}, 10) AS BIGINT), 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')" for i in range(4))
ORACLE = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, {_B32} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN page_id <> top THEN top END AS refers_to FROM m
"""
