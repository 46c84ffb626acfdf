"""Ordered folds: text chunks, conversation windows, page groups, prefix runs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

_LINES = re.compile("[^\n\r\v\f\x1c-\x1e\x85\u2028\u2029]*(?:\r\n|[\n\r\v\f\x1c-\x1e\x85\u2028\u2029])|[^\n\r\v\f\x1c-\x1e\x85\u2028\u2029]+")


def line_chunks(sizes: list[int], size: int, overlap: int, dedup_tail: bool = False) -> list[tuple[int, int]]:
    """First and last line of every chunk of lines with these lengths: a chunk ends with the line
    that brings it to size; the next begins with the fewest last lines that make up the overlap
    (all of the chunk, if need be) and holds one new line at least; the rest is the tail, which may
    repeat what a chunk has. With dedup_tail a tail of repeated lines only is left out."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    n, a, b, out = len(sizes), 0, -1, []
    while True:
        end = max(b + 1, int(np.searchsorted(total, total[a] + size)) - 1)
        if end >= n:
            break
        out.append((a, end))
        b = end
        a = b + 1 if overlap <= 0 else max(a, int(np.searchsorted(total, total[b + 1] - overlap, "right")) - 1)
    if a < n and not (dedup_tail and b == n - 1):
        out.append((a, n - 1))
    return out


def chunks(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), size: int = 4000, overlap: int = 400, dedup_tail: bool = False) -> DataFrame:
    """The columns in keep, chunk, line_from, line_to (from 0, inclusive) and text of the chunks of
    every text. Blank and null texts have none."""
    source = df.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("_text").to_pylist()):
                if not text or not text.strip():
                    continue
                lines = _LINES.findall(text)
                spans = line_chunks([len(x) for x in lines], size, overlap, dedup_tail)
                for lo in range(0, len(spans), 256):  # a long text goes out in parts
                    part = spans[lo : lo + 256]
                    same = [pa.concat_arrays([b.column(c).slice(i, 1)] * len(part)) for c in keep]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(range(lo, lo + len(part)), pa.int32()), pa.array([x for x, _ in part], pa.int32()), pa.array([y for _, y in part], pa.int32()), pa.array(["".join(lines[x : y + 1]) for x, y in part], pa.string())], names=[*keep, "chunk", "line_from", "line_to", "text"])

    fields = [StructField("chunk", IntegerType()), StructField("line_from", IntegerType()), StructField("line_to", IntegerType()), StructField("text", StringType())]
    return source.mapInArrow(run, StructType([*(source.schema[c] for c in keep), *fields]))


def turn_windows(df: DataFrame, max_len: int, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", length: Callable[[str], int] = lambda s: len(s.split()) + 2) -> DataFrame:
    """conv, window, first_turn, last_turn, tokens, trained of each window: the first system message
    and as many turns as fit into max_len; a turn that doesn't fit alone is cut; trained counts the
    assistant's tokens. Conversations whose system message leaves no room, and windows without a
    trained token, are dropped. Turns are sorted within their partition and folded as they pass, so
    a conversation of any length takes the memory of one window."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.coalesce(text, F.lit("")).alias("text")).where("conv is not null")
    ready = rows.withColumn("_body", (F.col("role") != "system").cast("int")).repartition("conv").sortWithinPartitions("conv", "_body", "turn", "text")
    kind = df.schema[conv].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, head, n, at = None, None, 0, None
        done: list = []

        def close() -> None:
            nonlocal at, n
            if at and at[3]:
                done.append((now, n, at[0], at[1], at[2], at[3]))
                n += 1
            at = None

        for b in batches:
            for c, t, r, body, x in zip(b["conv"], b["turn"], b["role"], b["_body"], b["text"], strict=True):
                if c != now:
                    close()
                    now, head, n = c, None, 0
                if body == 0:
                    head = length(x) if head is None else head
                    continue
                room = max_len - (head or 0)
                if room <= 0:
                    continue
                size = min(length(x), room)
                if at and at[2] + size > max_len:
                    close()
                if not at:
                    at = [t, t, head or 0, 0]
                at[1], at[2], at[3] = t, at[2] + size, at[3] + (size if r == "assistant" else 0)
            yield pd.DataFrame(done, columns=["conv", "win", "first_turn", "last_turn", "tokens", "trained"])
            done = []
        close()
        yield pd.DataFrame(done, columns=["conv", "win", "first_turn", "last_turn", "tokens", "trained"])

    schema = StructType([StructField("conv", kind), *(StructField(c, LongType()) for c in ("win", "first_turn", "last_turn", "tokens", "trained"))])
    return ready.select("conv", "turn", "role", "_body", "text").mapInPandas(run, schema).withColumnRenamed("conv", conv)


def answers(df: DataFrame, least: int = 400, role: str = "role", text: str = "text") -> DataFrame:
    """The assistant's messages of over `least` characters."""
    return df.where((F.col(role) == "assistant") & (F.length(text) > least))


def labels(ids: Column, trained: Column) -> Column:
    """ids where trained, else -100."""
    return F.transform(ids, lambda i: F.when(trained, i).otherwise(-100))


def page_groups(df: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, page, group: pages in order, each to the first group whose first page has the same
    number of columns, ink within 0.05 and a line height within 40 %. Pages of one number stand in the order of
    ink, line height and columns. Pages are sorted within their partition and folded as they pass; only the first pages of a document's groups are kept."""
    source = df.select(doc, "page", F.col("ink").cast("double"), F.col("line_h").cast("double"), F.col("cols"))
    ready = source.repartition(doc).sortWithinPartitions(doc, "page", "ink", "line_h", "cols")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = object()
        leads: list[tuple] = []
        for b in batches:
            out = []
            for d, ink, height, cols in zip(*(b.column(c).to_pylist() for c in (doc, "ink", "line_h", "cols")), strict=True):
                if d != now:
                    now, leads = d, []
                alike = (g for g, (i, h, c) in enumerate(leads) if c == cols and abs(i - ink) <= 0.05 and abs(h - height) <= 0.4 * max(h, height, 1.0))
                g = next(alike, len(leads))
                if g == len(leads):
                    leads.append((ink, height, cols))
                out.append(g)
            yield pa.RecordBatch.from_arrays([b.column(doc), b.column("page"), pa.array(out, pa.int32())], names=[doc, "page", "group"])

    return ready.mapInArrow(run, StructType([source.schema[doc], source.schema["page"], StructField("group", IntegerType())]))


def prefix_run(a: Column, b: Column) -> Column:
    """Number of equal elements before the first difference."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.when(at > 0, at - 1).otherwise(F.size(same).cast("long"))


def probes(df: DataFrame, tokens: str, prompt: int = 48, follow: int = 48, least: int = 400) -> DataFrame:
    """Answers for the leak probe: of the assistant, over `least` characters, and with tokens (an array, by
    whatever tokenizer) for the prompt and what follows it."""
    return answers(df, least).where(F.size(tokens) >= prompt + follow)


def leak(df: DataFrame, target: str, generated: str, window: int = 48) -> DataFrame:
    """n, exact share and mean verbatim run of continuations, and whether they may be published: a
    share of 1 % or less and a mean run of 8 or less, over one continuation at least."""
    run = prefix_run(F.slice(target, 1, window), F.slice(generated, 1, window))
    rows = df.select(run.alias("run"), F.least(F.lit(window), F.size(target)).alias("full"))
    out = rows.agg(F.count("*").alias("n"), F.count_if((F.col("run") >= F.col("full")) & (F.col("full") > 0)).alias("exact"), F.sum("run").alias("_runs"))
    out = out.withColumns({"share": F.col("exact") / F.greatest(F.lit(1), F.col("n")), "mean_run": F.coalesce(F.col("_runs"), F.lit(0)) / F.greatest(F.lit(1), F.col("n"))}).drop("_runs")
    return out.withColumn("ok", (F.col("n") > 0) & (F.col("share") <= 0.01) & (F.col("mean_run") <= 8))

