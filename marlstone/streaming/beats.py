"""Signs of life of running jobs, and their latest progress, by a state per run with timers and an end.

Progress rows (run, ts, step, total, loss) come in any order, late ones and repeated ones too: a run's state is the row
with the largest ts (then step) so far, and only a newer one changes it. A timer lets a run that says nothing
still be reported, every so many seconds, until it has been silent for `forget` seconds; then a last row says so and
its state is dropped. In event time, timers follow the watermark, so that a replay gives the same rows; in
processing time they follow the clock, and beats come while no event does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

OUT = "run string, kind string, at timestamp, ts timestamp, step long, total long, loss double, beats long"
#: What the session needs for state with timers.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Beats(StatefulProcessor):
    """kind is progress (a newer row), beat (silence so far) or gone (forgotten)."""

    def __init__(self, every: int, forget: int, event_time: bool):
        self.every, self.forget, self.event_time = every * 1000, forget * 1000, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts long, step long, total long, loss double, heard long, beats long")

    def row(self, key: tuple, kind: str, at: int) -> pd.DataFrame:
        ts, step, total, loss, _, beats = self.last.get()
        when = lambda ms: pd.Timestamp(ms, unit="ms")
        return pd.DataFrame({"run": [key[0]], "kind": [kind], "at": [when(at)], "ts": [when(ts)], "step": pd.array([step], "Int64"), "total": pd.array([total], "Int64"), "loss": [loss], "beats": [beats]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.last.get() if self.last.exists() else None
        best = (known[0], -1 if known[1] is None else known[1]) if known else None
        new = None
        for part in rows:
            for r in part.dropna(subset=["ts"]).itertuples():
                number = lambda v: None if pd.isna(v) else int(v)
                at = (int(r.ts.timestamp() * 1000), -1 if pd.isna(r.step) else int(r.step))
                if best is None or at > best:
                    best, new = at, (at[0], number(r.step), number(r.total), None if pd.isna(r.loss) else float(r.loss))
        if new is None:
            return
        heard = new[0] if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        self.last.update((*new, heard, known[5] if known else 0))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(heard + self.every)
        yield self.row(key, "progress", heard)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.last.exists():
            return
        at = expiredTimerInfo.getExpiryTimeInMs()
        ts, step, total, loss, heard, beats = self.last.get()
        now = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        made = []
        while at <= now:
            if at - heard >= self.forget:
                yield pd.concat([*made, self.row(key, "gone", at)])
                self.last.clear()
                return
            beats += 1
            self.last.update((ts, step, total, loss, heard, beats))
            made.append(self.row(key, "beat", at))
            # A replay makes each beat; a clock that has moved far makes one for all those missed.
            at = at + self.every if self.event_time else now + self.every
        self.handle.registerTimer(at)
        if made:
            yield pd.concat(made)

    def close(self) -> None:
        pass


def beats(progress: DataFrame, every: int = 60, forget: int = 600, late: str = "0 seconds", event_time: bool = False) -> DataFrame:
    """run, kind, at, ts, step, total, loss, beats, from a stream of progress rows (run, ts, step, total, loss): each
    newer state of a run at once, a beat after `every` seconds without one, and the end after `forget`."""
    progress.sparkSession.conf.set(*STORE)
    rows = progress.where("run is not null").select("run", "ts", F.col("step").cast("long").alias("step"), F.col("total").cast("long").alias("total"), F.col("loss").cast("double").alias("loss"))
    rows = rows.withWatermark("ts", late) if event_time else rows
    return rows.groupBy("run").transformWithStateInPandas(Beats(every, forget, event_time), OUT, "append", "EventTime" if event_time else "ProcessingTime")
