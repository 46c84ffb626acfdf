"""Streaming forms: the gate before a write, stalls of running jobs, latest progress, log tails."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import shared
from ..operators import gate
from ..sources.tail import Tail


def gated(events: DataFrame, event_col: str = "event") -> DataFrame:
    """events with the first forbidden path rule that one of their paths meets, and blocked. Works on
    streams and tables; split by blocked into the passing and the quarantine sink."""
    paths = gate.event_paths(F.col(event_col))
    rule = F.get(F.array_compact(F.transform(paths, lambda p: gate.forbidden_path(p))), F.lit(0))
    return events.withColumn("rule", rule).withColumn("blocked", F.col("rule").isNotNull())


def stalls(progress: DataFrame, seconds: int = 45, late: str = "0 seconds") -> DataFrame:
    """run, last, seen of runs whose progress (run, ts, size) stopped growing for `seconds` of event
    time. A stalled run is reported once and forgotten; it is a new run if it speaks again."""
    span = seconds * 1000

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last, size, seen = state.get
            state.remove()
            yield pd.DataFrame({"run": [key[0]], "last": [pd.Timestamp(last, unit="ms")], "seen": [seen]})
            return
        last, size, seen = state.get if state.exists else (0, -1, 0)
        top = None  # the largest size of all rows, which Arrow deals in any order, and when it was reached first
        for b in batches:
            sizes, times = b["size"].to_numpy(), b["ts"].to_numpy()
            seen, n = seen + len(sizes), int(sizes.max())
            at = int(times[sizes == n].min().astype("datetime64[ms]").astype("int64"))
            if top is None or n > top[0] or n == top[0] and at < top[1]:
                top = n, at
        if top is not None and top[0] > size:
            last, size = max(last, top[1]), top[0]
        state.update((last, size, seen))
        at = last + span
        if at > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(at)
            return
        state.remove()
        yield pd.DataFrame({"run": [key[0]], "last": [pd.Timestamp(last, unit="ms")], "seen": [seen]})

    rows = progress.where("ts is not null and size is not null").select("run", "ts", F.col("size").cast("long").alias("size")).withWatermark("ts", late)
    return rows.groupBy("run").applyInPandasWithState(run, "run string, last timestamp, seen long", "last long, size long, seen long", "append", GroupStateTimeout.EventTimeTimeout)


def upsert_latest(path: str, key: str, ts: str):
    """A foreachBatch function that keeps the latest row per key in versioned Parquet folders under
    path; a batch that runs again writes the same version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if batch_id:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v={batch_id - 1}").unionByName(batch)
        names = batch.columns
        best = rows.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(ts, *[c for c in names if c not in (key, ts)])).alias("r"))
        best.select(*(F.col("r")[c].alias(c) for c in names)).write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return write


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What a stream gives for all that its sources hold now, as a table in the shared folder: a batch writes
    its own part, and the same one if it runs again."""
    spark, out = stream.sparkSession, shared.fresh(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    empty = spark.createDataFrame([], stream.schema)
    empty.write.parquet(f"{out}/batch=-1")
    stream.writeStream.foreachBatch(write).option("checkpointLocation", shared.fresh(spark, f"{name}-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).select(*stream.columns)


def tail(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """file, offset, line of log files as they come, whole lines only; the checkpoint remembers bytes."""
    spark.dataSource.register(Tail)
    return spark.readStream.format("marlstone_tail").option("suffix", suffix).load(folder)
