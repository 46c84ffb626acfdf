"""Census of files: selection, totals, placement, pointers, moves, renames, state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text


def under(path, prefixes) -> Column:
    """Whether the path begins with one of an array of prefixes; '' holds for all."""
    path = F.col(path) if isinstance(path, str) else path
    return F.exists(prefixes, lambda p: F.startswith(path, p))


def select(files: DataFrame, rules_: DataFrame, group: str = "repo", path: str = "rel") -> DataFrame:
    """files with taken and reason, by the selection rules (group, include, exclude) of their group:
    exclusion wins. A group without a rule takes nothing. Rules are few: a row per group."""
    rows = files.join(rules_.select(group, "include", "exclude"), group, "left")
    inc, exc = F.coalesce(under(path, F.col("include")), F.lit(False)), F.coalesce(under(path, F.col("exclude")), F.lit(False))
    reason = F.when(exc, "excluded").when(~inc, "outside")
    return rows.withColumns({"taken": inc & ~exc, "reason": reason}).drop("include", "exclude")


def totals(files: DataFrame, group: str = "repo", size: str = "bytes") -> DataFrame:
    """taken, skipped and bytes taken per group, and the grand total under a null group."""
    taken = F.coalesce("taken", F.lit(False))
    return files.rollup(group).agg(F.count_if(taken).alias("taken"), F.count_if(~taken).alias("skipped"), F.coalesce(F.sum(F.when(taken, F.col(size))), F.lit(0)).alias("bytes"))


def directory_rollup(files: DataFrame, keys: Sequence[str], size: str = "bytes", verdict: str = "verdict") -> DataFrame:
    """n, bytes and the verdicts that occur, sorted, per (group, directory)."""
    return files.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(size).alias("bytes"), F.array_join(F.array_sort(F.collect_set(verdict)), ",").alias("verdicts"))


def placement(files: DataFrame, verdict: str = "verdict") -> DataFrame:
    """files with the zone that their verdict asks for."""
    return files.withColumn("zone_wanted", F.when(F.col(verdict) == rules.PUBLIC, "public").otherwise("private"))


def misplaced(rights: DataFrame, located: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Located files in another zone than the verdict asks for; unlocated rows, and rows without a
    zone, can't be judged and are left out."""
    return placement(rights).join(located.where("zone is not null"), list(keys)).where("zone <> zone_wanted")


def moved_by_zone(zones: DataFrame, files: DataFrame, zone: str = "zone") -> DataFrame:
    """n of every zone; null (not 0) for a zone that can't be reached."""
    n = files.groupBy(zone).agg(F.count("*").alias("_n"))
    return zones.join(n, zone, "left").select(zone, F.when(F.col("reachable"), F.coalesce("_n", F.lit(0))).cast("long").alias("n"))


def moved_total(by_zone: DataFrame) -> DataFrame:
    """by_zone and, under a null zone, the sum, in which zones that can't be reached count 0."""
    return by_zone.unionByName(by_zone.agg(F.lit(None).cast("string").alias("zone"), F.sum(F.coalesce("n", F.lit(0))).alias("n")))


def plan(rights: DataFrame, group: str = "repo", size: str = "bytes", verdict: str = "verdict") -> DataFrame:
    """Files and MiB that aren't public, per group."""
    held = rights.where(F.col(verdict) != rules.PUBLIC)
    return held.groupBy(group).agg(F.count("*").alias("files"), F.sum(size).alias("_bytes")).select(group, "files", text.rounded(F.col("_bytes") / 1048576.0, 2).alias("mib"))


def fetch_once(rows: DataFrame, key: str, source: DataFrame) -> DataFrame:
    """rows with what the source has for their key; the source is asked for each distinct key once."""
    asked = rows.select(key).where(F.col(key).isNotNull()).distinct()
    return rows.join(asked.join(source, key), key, "left")


def fetched(rows: DataFrame, key: str, fetch, schema: str, size: int = 50) -> DataFrame:
    """rows with what fetch gives for their key, null where it gives nothing. fetch is a function of up to `size`
    keys that returns a tuple by key in the columns of schema; it may ask a remote source, so the distinct keys are written before
    it is called and its answers after, and each key is asked for once, but where a task runs again."""
    from .. import shared

    keys = shared.kept(rows.select(key).where(F.col(key).isNotNull()).distinct(), "asked")
    kind = rows.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(out_type)
        for b in batches:
            every = b.column(0).to_pylist()
            for i in range(0, len(every), size):
                got = sorted(fetch(every[i : i + size]).items())
                cols = list(zip(*((k, *v) for k, v in got), strict=True)) or [()] * (1 + len(names))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape, strict=True)], names=[key, *names])

    from pyspark.sql.types import StructType

    out_type = StructType.fromDDL(f"{key} {kind}, {schema}")
    answers = shared.kept(keys.mapInArrow(run, out_type), "answers")
    return rows.join(answers, key, "left")


def to_run(steps_: DataFrame, state: DataFrame, always: Sequence[str] = ("probe",), redo: Sequence[str] = ()) -> DataFrame:
    """step and run: whether it has to run: not done yet (code 0 in the state), one that always runs,
    or one to redo."""
    done = state.where(F.col("code") == 0).select("step", F.lit(True).alias("_done")).distinct()
    again = F.col("step").isin(*always, *redo) if (*always, *redo) else F.lit(False)
    return steps_.join(done, "step", "left").select("step", (F.col("_done").isNull() | again).alias("run"))


def heartbeats(runs: DataFrame, key: str, ts: str, every: int = 60) -> DataFrame:
    """key and beats: signs of life of a run that reports every so many seconds from first to last."""
    seconds = F.unix_seconds(F.max(F.col(ts).cast("timestamp"))) - F.unix_seconds(F.min(F.col(ts).cast("timestamp")))
    return runs.groupBy(key).agg((F.floor(seconds / every) + 1).cast("long").alias("beats"))


def verify_moves(plan: DataFrame, copies: DataFrame, key: str) -> DataFrame:
    """plan with status (ok, mismatch, missing) and may_delete: true only if every copy of the whole
    plan has the hash of its source. The number of failures joins as one row."""
    rows = plan.join(copies.select(key, F.col("sha256").alias("_copy")), key, "left")
    rows = rows.withColumn("status", F.when(F.col("_copy").isNull(), "missing").when(F.col("_copy") == F.col("sha256"), "ok").otherwise("mismatch")).drop("_copy")
    failed = rows.agg(F.count_if(F.col("status") != "ok").alias("_failed"))
    return rows.join(F.broadcast(failed)).withColumn("may_delete", F.col("_failed") == 0).drop("_failed")


def pointers(rights: DataFrame, renames: DataFrame, existing: DataFrame, census: DataFrame, key: str = "path") -> DataFrame:
    """Rows for pointer files: public files that are really there under their present name, with
    that name and the census' size and hash where it has them."""
    named = rights.join(renames.select(F.col("original").alias(key), "current"), key, "left").withColumn("now", F.coalesce("current", key)).drop("current")
    there = named.join(existing.select(F.col("path").alias("now")), "now", "left_semi")
    return there.join(census.select(key, "bytes", "sha256"), key, "left")


def at_least(rows: DataFrame, value: str, bounds: DataFrame) -> DataFrame:
    """rows with the name of the highest bound (bound, name) that the value reaches; null below all.
    Bounds are a handful of rows and become one expression."""
    some = sorted(((r["bound"], r["name"]) for r in bounds.collect()), reverse=True)
    return rows.withColumn("name", F.coalesce(*(F.when(F.col(value) >= b, F.lit(n)) for b, n in some), F.lit(None).cast("string")))


def as_of(rows: DataFrame, value: str, bounds: DataFrame, per: int = 4096, most: int = 1_000_000) -> DataFrame:
    """at_least() for any number of bounds: values and bounds are dealt into buckets of equal width with some
    `per` bounds each, and inside one the last bound passed is carried on in order; what no bound of its own bucket
    reaches takes the last of those before. A bucket with more than `most` rows is dealt into several, each with
    all of the bucket's bounds. Equal bounds give the larger name."""
    from pyspark.sql.window import Window

    v = lambda c: F.col(c).cast("double")
    bounds = bounds.where("bound is not null").groupBy(v("bound").alias("_v")).agg(F.max(F.struct("name")).alias("_name"))
    low, high, n = bounds.agg(F.min("_v"), F.max("_v"), F.count("*")).first()
    if not n:
        return rows.withColumn("name", F.lit(None).cast("string"))
    last = -(-n // per) - 1
    wide = (high - low) / (last + 1) or 1.0
    bucket = lambda c: F.when(c >= high, last).otherwise(F.greatest(F.lit(0), F.least(F.lit(last), F.floor((c - low) / wide))))
    bounds = bounds.withColumn("_bucket", bucket(F.col("_v")).cast("long"))
    ends = rows.sparkSession.range(last + 1).withColumnRenamed("id", "_bucket").join(bounds.groupBy("_bucket").agg(F.max(F.struct("_v", "_name")).alias("_end")), "_bucket", "left")
    carried = ends.select("_bucket", F.last("_end", ignorenulls=True).over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))["_name"].alias("_carry"))  # a row per `per` bounds
    row = F.struct(*rows.columns)
    inside = rows.where(v(value) >= low).select(row.alias("_row"), v(value).alias("_v")).withColumn("_bucket", bucket(F.col("_v")).cast("long"))
    deals = inside.groupBy("_bucket").agg(F.ceil(F.count("*") / most).cast("int").alias("_deals"))  # a row per bucket
    asks = inside.join(deals, "_bucket").select("_row", "_v", "_bucket", F.pmod(F.xxhash64("_v", F.monotonically_increasing_id()), F.col("_deals")).cast("int").alias("_deal"), F.lit(None).cast(bounds.schema["_name"].dataType).alias("_name"))
    given = bounds.join(deals, "_bucket").select(F.lit(None).cast(asks.schema["_row"].dataType).alias("_row"), "_v", "_bucket", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)).alias("_deal"), "_name")
    w = Window.partitionBy("_bucket", "_deal").orderBy("_v", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = asks.unionByName(given).withColumn("_found", F.last("_name", ignorenulls=True).over(w)).where("_row is not null")
    out = found.join(carried, "_bucket").select("_row.*", F.coalesce(F.col("_found"), F.col("_carry"))["name"].alias("name"))
    return out.unionByName(rows.where(~F.coalesce(v(value) >= low, F.lit(False))).withColumn("name", F.lit(None).cast("string")))


def lookup(docs: DataFrame, wanted: str, id_col: str, order: str) -> DataFrame:
    """The document with this id, else the first in order whose id holds it in any case; rows with an
    error never."""
    exact = F.col(id_col) == wanted
    part = F.contains(F.lower(F.col(id_col)), F.lit(wanted.lower()))
    return docs.where((exact | part) & F.col("error").isNull()).orderBy(F.when(exact, 0).otherwise(1), order).limit(1)


def first_of(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """Of rows with equal key the first in order."""
    names = rows.columns
    best = rows.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*names), order).alias("_row"))
    return best.select(*(F.col("_row")[c].alias(c) for c in names))


def latest(events: DataFrame, key: str, ts: str, cols: Sequence[str], tie: str) -> DataFrame:
    """The last state of every key; of equal times that with the larger tie column."""
    best = events.groupBy(key).agg(F.max_by(F.struct(ts, *cols), F.struct(ts, tie)).alias("_s"))
    return best.select(key, *(F.col("_s")[c].alias(c) for c in (ts, *cols)))


def own_state(state: DataFrame, folder: str) -> DataFrame:
    """State that was written from this folder; foreign state is as good as none."""
    return state.where(F.col("folder") == folder)


def steps(n: Column, batch: int, accum: int, epochs: int) -> Column:
    return F.ceil(F.ceil(n / float(batch * accum)) * epochs).cast("long")


def hours(steps_: Column, per_step: Column) -> Column:
    """Hours that so many steps take at this many seconds each, two decimals."""
    return text.rounded(steps_ * per_step / 3600.0, 2)


def progress(step: Column, total: Column, seconds: Column) -> dict[str, Column]:
    per = seconds / F.greatest(F.lit(1), step)
    return {"per_step": per, "left_s": per * (total - step), "percent": F.floor(100 * step / F.greatest(F.lit(1), total)).cast("long")}
