"""Perspective rotation of dialogues: every participant in turn is the assistant.

For each conversation and each of its participants the dialogue is rendered with that speaker's
messages as the assistant's, everyone else's as a named user's, and system messages as they are.
The rendering is a row per message, in order, with its place in the whole text, and with the span
that carries loss: text and end mark of the assistant's messages. Places come from running sums
within blocks of TURNS turns and over the blocks' totals, so a conversation of any length is
spread over tasks. assemble() joins the rows of conversations that fit a row.

Messages are ordered by turn (null first), speaker, text. Defined results: null text is empty;
a null speaker counts as system; null conversation ids, and conversations in which only the system
speaks, yield nothing; repeated messages each appear; markers inside texts and names are broken
up ("<|" becomes "< |", "|>" becomes "| >"), line breaks in names become blanks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURNS = 256
SYSTEM, END = "system", "<|end|>\n"


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """conv_id, perspective, position, turn, speaker, kind, segment, seg_start, seg_end, mask_start,
    mask_end (both null where nothing carries loss)."""
    plain = lambda c: F.replace(F.replace(c, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    said = df.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(speaker).alias("speaker"), plain(F.coalesce(F.col(text), F.lit(""))).alias("body"))
    cast = said.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    kind = F.when(F.coalesce("speaker", F.lit(SYSTEM)) == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    name = plain(F.translate("speaker", "\n\r", "  "))
    head = F.when(F.col("kind") == "user", F.concat(F.lit("<|user name="), name, F.lit("|>\n"))).otherwise(F.concat(F.lit("<|"), F.col("kind"), F.lit("|>\n")))
    rows = said.join(cast, "conv_id").withColumn("kind", kind).withColumn("head", head).withColumn("segment", F.concat("head", "body", F.lit(END)))
    rows = rows.withColumn("size", F.length("segment").cast("long")).withColumn("part", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))))
    of = ["conv_id", "perspective", "part"]
    sums = rows.groupBy(*of).agg(F.sum("size").alias("chars"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*of, F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    within = Window.partitionBy(*of).orderBy(F.col("turn").asc_nulls_first(), F.col("speaker").asc_nulls_first(), "body")
    placed = rows.withColumn("at", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("row", F.row_number().over(within) - 1)
    placed = placed.join(sums, of).withColumn("seg_start", F.col("at") + F.col("chars"))
    target = F.col("kind") == "assistant"
    return placed.select(
        "conv_id", "perspective", (F.col("row") + F.col("n")).alias("position"), "turn", "speaker", "kind", "segment", "seg_start", (F.col("seg_start") + F.col("size")).alias("seg_end"),
        F.when(target, F.col("seg_start") + F.length("head")).alias("mask_start"), F.when(target, F.col("seg_start") + F.col("size") - 1).alias("mask_end"),
    )


def assemble(rows: DataFrame) -> DataFrame:
    """One text and its loss spans per conversation and perspective, for conversations that fit a row."""
    parts = F.sort_array(F.collect_list(F.struct("position", "segment", "mask_start", "mask_end")))
    spans = F.transform(F.filter("parts", lambda p: p.mask_start.isNotNull()), lambda p: F.struct(p.mask_start.alias("start"), p.mask_end.alias("end")))
    return rows.groupBy("conv_id", "perspective").agg(parts.alias("parts")).select("conv_id", "perspective", F.array_join(F.transform("parts", lambda p: p.segment), "").alias("text"), spans.alias("masks"))


ORACLE = """
WITH said AS (SELECT conv_id, turn, role AS speaker, replace(replace(coalesce(text, ''), '<|', '< |'), '|>', '| >') AS body
              FROM conversations WHERE conv_id IS NOT NULL),
parts AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
k AS (SELECT s.*, p.perspective,
             CASE WHEN coalesce(speaker, 'system') = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS kind
      FROM said s JOIN parts p USING (conv_id)),
h AS (SELECT *, CASE WHEN kind = 'user' THEN '<|user name=' || replace(replace(translate(speaker, chr(10) || chr(13), '  '), '<|', '< |'), '|>', '| >') || '|>' || chr(10)
                     ELSE '<|' || kind || '|>' || chr(10) END AS head FROM k),
g AS (SELECT *, head || body || '<|end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, row_number() OVER w - 1 AS position,
             CAST(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS seg_end
      FROM g WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker NULLS FIRST, body))
SELECT conv_id, perspective, position, turn, speaker, kind, segment, seg_end - length(segment) AS seg_start, seg_end,
       CASE WHEN kind = 'assistant' THEN seg_end - length(segment) + length(head) END AS mask_start,
       CASE WHEN kind = 'assistant' THEN seg_end - 1 END AS mask_end FROM o
"""
