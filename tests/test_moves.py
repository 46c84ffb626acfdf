"""Copies that are verified before their sources go, and tails of logs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from marlstone.sources import moves, stores, tail
from marlstone.streaming import watch


def plan_of(spark, folder, n=20, **sha):
    (folder / "s").mkdir(exist_ok=True)
    for i in range(n):
        (folder / "s" / f"{i}.bin").write_bytes(b"x" * i + bytes([i]))
    rows = [(f"file://{folder}/s/{i}.bin", f"{folder}/d/sub{i % 3}/{i}.bin", sha.get(f"_{i}")) for i in range(n)]
    return spark.createDataFrame(rows, "src string, dst string, sha256 string").repartition(4)


def there(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def test_move(spark, tmp_path):
    plan, log = plan_of(spark, tmp_path), f"file://{tmp_path}/log"
    assert moves.delete_sources(spark, log) == 0 and len(there(tmp_path / "s")) == 20
    got = moves.copy(plan, log)
    assert {r.status for r in got.collect()} == {"copied"} and got.count() == 20
    assert all(r.sha256 == stores.sha256(r.dst) for r in got.collect())
    assert len(there(tmp_path / "d")) == 20 and not [f for f in there(tmp_path) if f.endswith(".part")]
    assert moves.delete_sources(spark, log) == 20 and there(tmp_path / "s") == []
    assert moves.delete_sources(spark, log) == 0
    again = moves.copy(plan, f"{tmp_path}/log2")
    assert {r.status for r in again.collect()} == {"already"} and len(there(tmp_path / "d")) == 20


def test_one_damaged_copy_keeps_all_sources(spark, tmp_path):
    plan, log = plan_of(spark, tmp_path, _7="0" * 64), f"{tmp_path}/log"
    got = {os.path.basename(r.src): r.status for r in moves.copy(plan, log).collect()}
    assert got == {f"{i}.bin": "mismatch" if i == 7 else "copied" for i in range(20)}
    assert moves.delete_sources(spark, log) == 0 and len(there(tmp_path / "s")) == 20 and len(there(tmp_path / "d")) == 19


def test_a_missing_file_keeps_all_sources(spark, tmp_path):
    plan = plan_of(spark, tmp_path)
    os.remove(tmp_path / "s" / "3.bin")
    assert sum(r.status == "missing" for r in moves.copy(plan, f"{tmp_path}/log").collect()) == 1
    assert moves.delete_sources(spark, f"{tmp_path}/log") == 0 and len(there(tmp_path / "s")) == 19


def test_a_failed_task_commits_nothing(spark, tmp_path):
    plan, log = plan_of(spark, tmp_path), f"{tmp_path}/log"
    broken = plan.withColumn("src", F.when(F.col("src").endswith("/9.bin"), "nosuchscheme://x/y").otherwise(F.col("src")))
    with pytest.raises(Exception, match="nosuchscheme|scheme"):
        moves.copy(broken, log)
    assert not os.path.exists(f"{log}/{moves.MANIFEST}") and moves.delete_sources(spark, log) == 0
    assert moves.logged(spark, log).count() == 0 and len(there(tmp_path / "s")) == 20
    assert moves.copy(plan, log).count() == 20 and moves.delete_sources(spark, log) == 20


def test_only_sources_that_are_as_they_were_go(spark, tmp_path):
    plan, log = plan_of(spark, tmp_path), f"{tmp_path}/log"
    moves.copy(plan, log)
    (tmp_path / "s" / "5.bin").write_bytes(b"written to since")
    assert moves.delete_sources(spark, log) == 19 and there(tmp_path / "s") == ["5.bin"]
    assert sum(json.load(open(f"{log}/{moves.MANIFEST}"))["totals"].values()) == 20


def test_empty_plan(spark, tmp_path):
    assert moves.copy(spark.createDataFrame([], "src string, dst string, sha256 string"), f"{tmp_path}/log").count() == 0


def test_ranges(tmp_path):
    """Parts of any size give every line once, with its place."""
    text = "".join(f"line {i} {'ä' * (i % 40)}\n" for i in range(300))
    (tmp_path / "a.log").write_text(text + "half")
    want, at = [], 0
    for line in text.split("\n")[:-1]:
        want.append((str(tmp_path / "a.log"), at, line))
        at += len(line.encode()) + 1
    for part in (1, 7, 64, 1000, 1 << 20):
        reader = tail.TailReader(str(tmp_path), ".log", part)
        assert [r for p in reader.partitions({}, reader.latestOffset()) for r in reader.read(p)] == want
    assert tail.TailReader(str(tmp_path / "none"), "", 9).latestOffset() == {}


def test_tail(spark, tmp_path):
    logs, seen = tmp_path / "logs", []
    logs.mkdir()

    def run():
        """A new reader each time, from the checkpoint."""
        got = []
        q = watch.tail(spark, str(logs), ".log").writeStream.foreachBatch(lambda b, _: got.extend((os.path.basename(r.file), r.line) for r in b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        seen.append(sorted(got))
        return seen[-1]

    (logs / "a.log").write_text("one\ntwo\nhal")
    (logs / "b.log").write_text("")
    (logs / "c.txt").write_text("not a log\n")
    assert run() == [("a.log", "one"), ("a.log", "two")]
    with open(logs / "a.log", "a") as f:
        f.write("f\nthree\n")
    (logs / "b.log").write_text("first\r\n")
    assert run() == [("a.log", "half"), ("a.log", "three"), ("b.log", "first")]
    assert run() == []
    (logs / "a.log").write_text("new\n")  # truncated
    assert run() == [("a.log", "new")]
    (logs / "a.log").write_text("other, and longer than it was\nx\n")  # replaced by a longer one
    assert run() == [("a.log", "other, and longer than it was"), ("a.log", "x")]
    os.remove(logs / "b.log")
    assert run() == []
    (logs / "b.log").write_text("first\n")
    assert run() == [("b.log", "first")]
