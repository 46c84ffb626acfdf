from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marlstone.llm import jaccard, pieces
from marlstone.llm.queries import tokenizer_file


@pytest.fixture
def sent(spark):
    """Bytes that all stages up to now have written for shuffles; joins aren't broadcast by size meanwhile."""
    gateway = spark.sparkContext._gateway
    store, bus = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def total() -> int:
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield total
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    return [" ".join(f"{draw.getrandbits(64):016x}" for _ in range(200)) for _ in range(300)]


def test_texts_that_stay_are_not_shuffled(spark, sent, texts):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, texts[7] + " and"), (1001, texts[8]), (1002, ""), (1002, "a b"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = corpus_pipeline.drop_near_duplicates(spark, docs.localCheckpoint(), "")
    mark = sent()
    got = out.collect()
    assert sent() - mark < 0.1 * sum(map(len, texts))
    want = [(i, t) for i, t in enumerate(texts)] + [(1002, ""), (None, "no id")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_texts_outside_the_sample_are_not_shuffled(spark, sent, texts, monkeypatch):
    docs = spark.createDataFrame([(i, f"{t} in all of them") for i, t in enumerate(texts)], "doc_id long, text string").repartition(4).localCheckpoint()
    sets = spark.range(len(texts)).select(F.col("id").alias("rep"), F.xxhash64("id").alias("a")).localCheckpoint()
    monkeypatch.setattr(jaccard, "SAMPLE", 200 * len(texts) // 10)
    mark = sent()
    found = jaccard.frequent(docs, sets, 200 * len(texts), 3)
    assert sent() - mark < 0.5 * sum(map(len, texts))
    assert len(found) == 2  # "in all of", "all of them"


def test_pieces_shuffle_less_than_the_texts(spark, sent):
    draw = random.Random(8)
    syllables = "ti on the er in an sh wh ing con ver ble ly de un".split()
    marks = ["", ",", ".", "$$$", "###", "***"]
    word = lambda: "".join(draw.choices(syllables, k=draw.randint(1, 4)))
    common = [word() for _ in range(500)]
    rows = [(i, " ".join((draw.choice(common) if draw.random() < 0.9 else word()) + draw.choice(marks) for _ in range(2000))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    mark = sent()
    assert pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), most=2000).select("doc_id", "ids").count() == len(rows)
    bound = sum(len(t) for _, t in rows)
    assert sent() - mark < bound
