"""Beats of runs: timers, late and repeated rows, the end of a state."""

import json
import time
from datetime import datetime, timedelta

from marlstone.streaming import beats

SCHEMA = "run string, ts timestamp, step long, total long, loss double"
T0 = datetime(2024, 1, 1)


def put(folder, name, *rows):
    """run, seconds, step."""
    lines = [json.dumps({"run": r, "ts": (T0 + timedelta(seconds=s)).isoformat() if s is not None else None, "step": step, "total": 9, "loss": 0.5}) for r, s, step in rows]
    (folder / f"{name}.tmp").write_text("\n".join(lines))
    (folder / f"{name}.tmp").rename(folder / f"{name}.json")


def start(spark, folder, out, trigger, **more):
    def keep(batch, _):
        out.extend((r.run, r.kind, (r.at - T0).total_seconds(), r.step, r.beats) for r in batch.collect())

    s = beats.beats(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.json").json(str(folder)), **more)
    return s.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/c").trigger(**trigger).start()


def test_event_time(spark, tmp_path):
    out = []
    put(tmp_path, "1", ("a", 0, 1), ("b", 5, 1), (None, 3, 1), ("b", None, 7))
    run = lambda: start(spark, tmp_path, out, {"availableNow": True}, every=10, forget=35, event_time=True).awaitTermination()
    run()
    assert sorted(out) == [("a", "progress", 0.0, 1, 0), ("b", "progress", 5.0, 1, 0)]
    out.clear()
    put(tmp_path, "2", ("b", 27, 2), ("b", 27, 2), ("b", 25, 9), ("a", 0, 1))  # repeated, out of order, late
    run()
    assert sorted(out) == [("a", "beat", 10.0, 1, 1), ("a", "beat", 20.0, 1, 2), ("b", "progress", 27.0, 2, 0)]
    out.clear()
    put(tmp_path, "3", ("b", 28, 3))
    put(tmp_path, "4", ("b", 60, 4))
    run()
    assert [x for x in sorted(out) if x[0] == "a"] == [("a", "beat", 30.0, 1, 3), ("a", "gone", 40.0, 1, 3)]
    assert [x[1:4] for x in out if x[0] == "b" and x[1] == "progress"] == [("progress", 28.0, 3), ("progress", 60.0, 4)]
    out.clear()
    put(tmp_path, "5", ("a", 70, 1))  # a run that was forgotten is a new one
    run()
    assert ("a", "progress", 70.0, 1, 0) in out


def test_beats_while_no_event_comes(spark, tmp_path):
    out = []
    put(tmp_path, "1", ("a", 0, 3))
    q = start(spark, tmp_path, out, {"processingTime": "1 second"}, every=1, forget=4)
    end = time.time() + 90
    while time.time() < end and not any(x[1] == "gone" for x in out):
        time.sleep(0.5)
    q.stop()
    kinds = [x[1] for x in out]
    assert kinds[0] == "progress" and kinds[-1] == "gone" and 1 <= kinds.count("beat") <= 4
    assert {x[3] for x in out} == {3} and [x[4] for x in out if x[1] == "beat"] == list(range(1, kinds.count("beat") + 1))
