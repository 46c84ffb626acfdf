"""From documents to packed training sequences. Every stage takes (spark, docs, sf_dir) and works on
all rows its predecessor kept; all but the last return the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import jaccard, language, packing, quality
from marlstone.llm.common import durable, labelled_texts, unused

#: Hash values of ids that tell which texts may have to go, at most so many in every task.
SLOTS = 1 << 22


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: null, empty and blank texts and those without a
    letter. All others stay as they came, repeated rows and rows without an id too; without any
    labelled row no language is known and nothing stays; an empty table stays empty."""
    found = language.samples(docs, "text", "lang", "doc_id")
    named, sure = unused("_lang", docs.columns), unused("_sure", docs.columns)
    told = language.identify(docs, found, keep=tuple(docs.columns), out=(named, sure))
    return told.where(F.col(named) != "und").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 go; a score of just 0.5 stays. Trained on the labelled
    documents of those that came in. Repeated rows share one fate, rows without an id are scored
    like others, empty texts get the model's score for them; without labels every score is 0.5 and
    all stay, with one label only all stay or go with it; an empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.train(labelled_texts(labels, docs.select("doc_id", "text"), "quality", "doc_id", quality.SAMPLE))
    scored = unused("_quality", docs.columns)
    return quality.score(docs, model, keep=tuple(docs.columns), out=scored).where(F.col(scored) >= 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays. The pipeline takes
    five-word shingles and a similarity of 0.8. Texts without words link nothing and stay. Of
    several rows with one id the one with the smallest text stays (of equal texts any). Rows without
    an id stay once for each text; they are never anyone's smallest document. An empty table stays
    empty."""
    found = jaccard.classes(docs, width=5, num=80, den=100)
    rows = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("_stays"))
    # All other ids have one row, which stays: most texts needn't travel, as a bounded number of hash values tells.
    care = durable(rows.where("not _stays or _rows > 1"), "care")
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(9)), F.lit(SLOTS)).cast("int")
    name = unused("_slot", docs.columns)
    slots = F.broadcast(care.select(slot.alias(name)).distinct())
    named = docs.where("doc_id is not null").withColumn(name, slot)
    sure = named.join(slots, name, "left_anti").select(*docs.columns)
    other = named.join(slots, name, "left_semi").select(*docs.columns)
    once = sure.unionByName(other.join(care.select("doc_id"), "doc_id", "left_anti").select(*docs.columns))
    more = other.join(care.where("_stays and _rows > 1").select("doc_id"), "doc_id", "left_semi")
    more = more.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*docs.columns), F.struct(F.col("text").isNull(), "text")).alias("_row")).select("_row.*")
    nameless = docs.where("doc_id is null").dropDuplicates(["text"])
    return once.unionByName(more).unionByName(nameless)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences. Null and empty texts are one end token; repeated rows
    and rows without an id are packed like others; an empty table gives no piece."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Trained models and hashed tokenisation have no DuckDB equivalent; tests/llm holds the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = durable(docs, f"stage-{k}")
    return docs
