"""Queries that run as streams over the given tables until these are read to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import shared
from ..functions import rules
from ..sources import files
from ..streaming import beats, watch
from .corpus import _q, query, table


def _stream(spark, sf_dir, name):
    """A table as a stream, whether it is a file or a folder: a pattern serves both."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


_LINE = "event_id || ' ' || event_type || ' ' || coalesce(props, '-')"


@query(f"SELECT {_LINE} AS line FROM events")
def tailed_lines(spark, sf_dir):
    """Lines of log files, by a tail that remembers bytes."""
    folder = shared.fresh(spark, "logs")
    table(spark, sf_dir, "events").select(F.expr(_LINE).alias("value")).write.text(folder)
    return watch.drained(watch.tail(spark, folder, ".txt"), "tailed").select("line")


_PATH = "CASE event_type WHEN 'error' THEN 'logs/chatlog/' WHEN 'purchase' THEN 'keys/id_rsa.' ELSE 'notes/' END || event_id"


@query(f"WITH e AS (SELECT event_id, {_PATH} AS path FROM events), r AS (SELECT *, CASE {' '.join(f'WHEN regexp_matches(path, {_q(p)}) THEN {_q(n)}' for n, p in rules.PATHS)} END AS rule FROM e) SELECT event_id, rule, rule IS NOT NULL AS blocked FROM r")
def gated_events(spark, sf_dir):
    """Tool events as they come, with the rule that holds one back."""
    event = F.to_json(F.struct(F.struct(F.expr(_PATH).alias("file_path")).alias("tool_input")))
    return watch.drained(watch.gated(_stream(spark, sf_dir, "events").select("event_id", event.alias("event"))).select("event_id", "rule", "blocked"), "gated")


@query("SELECT user_id, CAST(arg_max(event_id, (ts, event_id)) AS BIGINT) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def latest_progress(spark, sf_dir):
    """The latest row of every run, kept from batch to batch."""
    path = shared.fresh(spark, "latest")
    s = _stream(spark, sf_dir, "events").where("user_id is not null").select("user_id", "ts", "event_id", "event_type")
    q = s.writeStream.foreachBatch(watch.upsert_latest(path, "user_id", "ts")).option("checkpointLocation", shared.fresh(spark, "latest-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = max((int(r["v"]) for r in files.scan(spark, path, ["parquet"]).select(F.regexp_extract("rel", r"v=(\d+)/", 1).alias("v")).distinct().collect()), default=None)  # a row per batch
    found = spark.read.schema(s.schema).parquet(f"{path}/v={last}") if last is not None else spark.createDataFrame([], s.schema)
    return found.select("user_id", "event_id", "event_type")


_EVERY, _FORGET = 6 * 3600, 30 * 3600


@query(f"""WITH e AS (SELECT user_id, date_trunc('milliseconds', arg_max(ts, (date_trunc('milliseconds', ts), event_id))) AS heard, CAST(arg_max(event_id, (date_trunc('milliseconds', ts), event_id)) AS BIGINT) AS step FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1),
w AS (SELECT date_trunc('milliseconds', max(ts)) AS mark FROM events), k AS (SELECT e.*, mark, unnest(range({_FORGET // _EVERY + 1})) AS k FROM e, w)
SELECT CAST(user_id AS VARCHAR) AS run, CASE WHEN k = 0 THEN 'progress' WHEN k * {_EVERY} >= {_FORGET} THEN 'gone' ELSE 'beat' END AS kind, epoch_ms(heard + to_seconds(k * {_EVERY})) AS at_ms, step, CAST(least(k, {(_FORGET - 1) // _EVERY}) AS BIGINT) AS beats
FROM k WHERE k = 0 OR heard + to_seconds(k * {_EVERY}) <= mark""")
def beats_of_runs(spark, sf_dir):
    """Progress, beats in silence and the end of every run (a user each), replayed in event time."""
    s = _stream(spark, sf_dir, "events").where("user_id is not null").select(F.col("user_id").cast("string").alias("run"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("step"), F.lit(None).cast("long").alias("total"), F.lit(None).cast("double").alias("loss"))
    got = watch.drained(beats.beats(s, every=_EVERY, forget=_FORGET, event_time=True), "beats")
    return got.select("run", "kind", F.unix_millis("at").alias("at_ms"), "step", "beats")


@query("""WITH p AS (SELECT user_id, date_trunc('milliseconds', ts) AS ts, CAST(trunc(value) AS BIGINT) AS size, max(CAST(trunc(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL),
r AS (SELECT user_id, max(ts) FILTER (before IS NULL OR size > before) AS last, count(*) AS seen FROM p GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS run, epoch_ms(last) AS last_ms, seen FROM r WHERE last + INTERVAL 45 SECOND <= (SELECT max(ts) FROM p)""")
def stalled_runs(spark, sf_dir):
    """Runs whose size has not grown for 45 seconds by the end of the stream."""
    s = _stream(spark, sf_dir, "events").where("user_id is not null and value is not null").select(F.col("user_id").cast("string").alias("run"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("long").alias("size"))
    return watch.drained(watch.stalls(s), "stalls").select("run", F.unix_millis("last").alias("last_ms"), "seen")
