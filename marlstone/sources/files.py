"""File census and JSON sources, and the sinks of small reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .stores import is_folder


def _listing(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    """rel, length of the files below a folder, level by level: tasks list the folders of a level, and no file is
    opened."""
    from .. import shared

    def run(batches):
        import pyarrow as pa

        from .stores import listed

        for b in batches:
            for below in b.column("rel").to_pylist():
                got = listed(root, below)
                for at in range(0, len(got), 10_000):
                    some = got[at : at + 10_000]
                    yield pa.RecordBatch.from_pydict({"rel": pa.array([r for r, _ in some], pa.string()), "length": pa.array([n for _, n in some], pa.int64())})

    schema = "rel string, length long"
    level, levels = spark.createDataFrame([("",)], "rel string"), []
    while True:
        found = shared.kept(level.mapInArrow(run, schema), "listing")
        levels.append(found.where("length is not null"))
        n = found.where("length is null").count() if recursive else 0
        if not n:
            break
        level = found.where("length is null").select("rel").repartition(min(n, 4 * spark.sparkContext.defaultParallelism))
    return reduce(DataFrame.unionByName, levels)


def scan(spark: SparkSession, root: str, extensions: Sequence[str] = (), content: bool = False, recursive: bool = True) -> DataFrame:
    """path, rel, bytes, ext (and content) of the files below root, without version-control
    folders. Content isn't read unless asked for; extensions (without dot) compare in any case."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not content and is_folder(root):
        whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
        files = _listing(spark, root, recursive).withColumn("path", F.concat(F.lit(f"{whole}/"), "rel"))
    else:  # bytes, a pattern or a file, or a store that only Spark opens
        files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    ext = F.lower(F.regexp_extract("path", r"[^/]\.([^./]+)$", 1))
    base = at.toUri().getPath().rstrip("/")
    rel = F.regexp_replace(F.substring_index("path", base + "/", -1), "^/+", "")
    out = files.select("path", rel.alias("rel"), F.col("length").alias("bytes"), ext.alias("ext"), *(["content"] if content else []))
    out = out.where(~F.rlike("rel", F.lit(r"(^|/)\.git(/|$)")))
    return out.where(F.col("ext").isin(*[e.lower() for e in extensions])) if extensions else out


def scan_zones(spark: SparkSession, zones: dict[str, str], extensions: Sequence[str] = ()) -> DataFrame:
    """The census of several zones, tagged zone."""
    out = None
    for name, root in zones.items():
        z = scan(spark, root, extensions).withColumn("zone", F.lit(name))
        out = z if out is None else out.unionByName(z)
    return out


def scan_unmanaged(spark: SparkSession, root: str, extensions: Sequence[str], skip: Sequence[str] = ("docs/", "tools/", "env/")) -> DataFrame:
    """The census of root without what lies below these folders."""
    files = scan(spark, root, extensions)
    return files.where(~F.exists(F.array(*map(F.lit, skip)), lambda s: F.startswith("rel", s)))


def first_kind(files: DataFrame, extensions: Sequence[str] = ("png", "jpg")) -> DataFrame:
    """The files of the first of these extensions that occurs at all."""
    order = F.array_position(F.array(*map(F.lit, extensions)), F.col("ext"))
    ranked = files.withColumn("_at", order).where("_at > 0")
    return ranked.join(F.broadcast(ranked.agg(F.min("_at").alias("_at"))), "_at", "left_semi").drop("_at")


def verified_copies(spark: SparkSession, source: str, copy: str) -> DataFrame:
    """rel, status and may_delete of every file below source: its copy below the other folder is read
    again and compared by hash. No source may go unless all copies are right (see verify_moves)."""
    from ..operators import census

    hashed = lambda root: scan(spark, root, content=True).select("rel", F.sha2("content", 256).alias("sha256"))
    return census.verify_moves(hashed(source), hashed(copy), "rel").select("rel", "status", "may_delete")


def write_files(rows: DataFrame, root: str, path: str, content: str) -> int:
    """A file below root for each row, with this path and these bytes or text; how many. A task that runs again
    writes the same files; rows without a path or content write none."""
    root = root.rstrip("/")

    def run(batches):
        import pyarrow as pa

        from .stores import put

        made: set[str] = set()
        for b in batches:
            for p, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                put(f"{root}/{p}", body.as_py(), made)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(b)], pa.int64())})

    named = rows.select(F.col(path).cast("string").alias("p"), F.col(content).cast("binary").alias("c")).where("p is not null and c is not null")
    return named.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def chat_json(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """value: a line {"messages": [{"role", "content"}, ...]} per conversation, its turns in order. A line holds
    its whole conversation, as its readers expect."""
    one = F.struct(turn, F.col(role).alias("role"), F.col(text).alias("content"))
    rows = turns.where(F.col(conv).isNotNull()).groupBy(conv).agg(F.sort_array(F.collect_list(one)).alias("m"))
    messages = F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return rows.select(F.to_json(F.struct(messages.alias("messages")), {"ignoreNullFields": "false"}).alias("value"))


def write_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines; null fields stay, so that null isn't taken for missing."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_texts(rows: DataFrame, path: str, text: str, by: Sequence[str]) -> None:
    """A text column as files, in folders by these columns: pages, chunks, notices or cards."""
    rows.select(*by, F.col(text).alias("value")).repartition(*by).write.mode("overwrite").partitionBy(*by).text(path)


def json_table(spark: SparkSession, path: str, schema: StructType | str, lines: bool = False) -> DataFrame:
    """A JSON document (or lines) with a declared schema; what doesn't read, and a path that isn't
    there, is empty."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    try:
        return spark.read.schema(schema).option("multiLine", not lines).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def chat_lines(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """conv_id, turn, role, text of chat lines {"messages": [{"role", "content"}, ...]}; most limits
    the conversations, in file order."""
    rows = json_table(spark, path, "messages array<struct<role: string, content: string>>", lines=True).withColumn("conv_id", F.monotonically_increasing_id())
    rows = rows.orderBy("conv_id").limit(most) if most is not None else rows
    return rows.select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", "m.role", F.col("m.content").alias("text"))


def kind(path: Column, content: Column) -> Column:
    """pdf, djvu or unknown, by the first bytes, else by the extension."""
    head = F.hex(F.substring(content, 1, 8))
    by_ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(F.startswith(head, F.lit("25504446")), "pdf").when(F.startswith(head, F.lit("41542654464F524D")), "djvu").when(by_ext.isin("pdf", "djvu"), by_ext).otherwise("unknown")


def split_parts(df: DataFrame, content: str, size: int) -> DataFrame:
    """df with a row per part of at most size bytes of a binary column; empty content has none."""
    n = F.ceil(F.octet_length(content) / size).cast("long")
    return df.where(n > 0).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).withColumn(content, F.substring(F.col(content), (F.col("part") * size + 1).cast("int"), F.lit(size)))


def page_sizes(info: Column) -> Column:
    """Widths and heights in points from page lines such as "Page 1 size: 595 x 842 pts"."""
    return F.transform(F.regexp_extract_all(info, F.lit(r"size:\s*([\d.]+ x [\d.]+)"), F.lit(1)), lambda s: F.struct(F.split(s, " x ")[0].cast("double").alias("w"), F.split(s, " x ")[1].cast("double").alias("h")))


def atom_entry(xml: Column) -> dict[str, Column]:
    """Fields of an Atom entry; what is missing is a dash."""
    plain = F.regexp_replace(F.regexp_replace(xml, r"\sxmlns(:\w+)?=\"[^\"]*\"", ""), r"<(/?)\w+:", "<$1")
    one = lambda p: F.coalesce(F.nullif(F.trim(F.regexp_replace(F.xpath_string(plain, F.lit(p)), r"\s+", " ")), F.lit("")), F.lit("—"))
    many = F.array_join(F.xpath(plain, F.lit("//entry/author/name/text()")), ", ")
    return {"title": one("//entry/title"), "summary": one("//entry/summary"), "published": one("//entry/published"), "license": one("//entry/license"), "authors": F.coalesce(F.nullif(many, F.lit("")), F.lit("—"))}


def markdown(rows: DataFrame, columns: Sequence[str], order: Sequence[str], most: int = 1000) -> str:
    """A Markdown table of at most `most` rows, with a line that says how many more there are."""
    got = rows.select(*columns).orderBy(*order).limit(most + 1).collect()
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in got[:most]]
    if len(got) > most:
        lines.append(f"and {rows.count() - most} more")
    return "\n".join(lines)


def filled(template: str, **fields) -> Column:
    """template with each {name} replaced by a column; null reads as a dash. For notices and cards,
    a text per row: DataFrame.write.text takes them."""
    out = F.lit(template)
    for name, c in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("—")))
    return out
