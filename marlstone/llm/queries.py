"""One query per operator, over whole tables; digest columns come from the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard, language, lm, negatives, packing, pieces, quality, resample, toxicity, vectors, warc
from .common import held, labelled_texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def _labelled(spark: SparkSession, sf_dir: str, label: str, modulus: int, remainder: int, per_class: int) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held("doc_id", modulus, remainder))
    return labelled_texts(labels, table(spark, sf_dir, "documents").select("doc_id", "text"), label, "doc_id", per_class)


def op2_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.train(_labelled(spark, sf_dir, "quality", 3, 1, quality.SAMPLE))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held("doc_id", 3, 1).alias("held_out"))
    return quality.score(docs, model, keep=("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.train(_labelled(spark, sf_dir, "toxic", 4, 2, toxicity.SAMPLE))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held("doc_id", 4, 2).alias("held_out"))
    return toxicity.score(docs, model, keep=("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.samples(docs.where(~held("doc_id", 5, 0)), "text", "lang", "doc_id")
    return language.identify(docs.select("doc_id", "text", held("doc_id", 5, 0).alias("held_out")), found, keep=("held_out",))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held("doc_id", 7, 2).alias("held_out"))
    return lm.score(docs, "held_out")


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of pieces, crc32 of the ids as text, and whether decoding gives the text."""
    file = tokenizer_file("piece_bpe_32k.model")
    done = pieces.encode(table(spark, sf_dir, "documents"), file, back="back")
    return done.select("doc_id", F.size("ids").alias("n_pieces"), F.crc32(F.array_join("ids", " ")).alias("ids_crc32"), (F.col("back") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op9_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_products(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), lambda i: i % 50 == 0)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def op13_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as it came back from the archives."""
    got = warc.read(warc.write(table(spark, sf_dir, "pages")), payload=False)
    return got.select(F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


_OP9 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_rotation": chat.ORACLE, "op9_threshold_topk": _OP9, "op11_hard_negatives": negatives.ORACLE, "op13_warc_index": warc.ORACLE}
