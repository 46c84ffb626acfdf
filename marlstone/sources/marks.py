"""Marks of executable content in PDF bytes: every stream that inflates, as it inflates, and the bytes around."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules

_STREAM, _END = re.compile(rb"(?<!end)stream\r?\n"), b"endstream"


def bodies(raw: bytes) -> Iterator[bytes]:
    """What the streams inflate to, of any length, and what lies outside of these: deflated bytes spell marks by chance.
    Streams that don't inflate are taken as they are."""
    at = kept = 0
    end = -1
    while s := _STREAM.search(raw, at):
        at = s.end()
        end = raw.find(_END, at) if end < at else end
        if end < 0:
            break
        try:
            body = zlib.decompress(memoryview(raw)[at:end])
        except zlib.error:
            continue
        yield raw[kept:at]
        yield body
        at = kept = end
    yield raw[kept:]


def marks(files: DataFrame, names: Sequence[str] = (*rules.HEAVY, *rules.ROUTINE), path: str = "path", content: str = "content") -> DataFrame:
    """path, mark, n of every mark that occurs, in bodies(). A longer
    name isn't a mark: /JS doesn't count in /JSx. Null content has no marks."""
    found = {m: re.compile(re.escape(m.encode()) + rb"(?![A-Za-z0-9])") for m in names}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, raw in zip(b["path"], b["content"], strict=True):
                if raw is None:
                    continue
                n = dict.fromkeys(names, 0)
                for body in bodies(bytes(raw)):
                    for m, r in found.items():
                        n[m] += len(r.findall(body))
                rows += [(p, m, k) for m, k in n.items() if k]
            yield pd.DataFrame(rows, columns=["path", "mark", "n"])

    return files.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "path string, mark string, n long")


def bucket(heavy: Column, routine: Column) -> Column:
    """heavy if any executable mark; routine if only ordinary ones; else null."""
    return F.when(heavy, "heavy").when(routine, "routine")


def buckets(found: DataFrame) -> DataFrame:
    """path, heavy and routine marks that occur, sorted, and the bucket."""
    got = found.groupBy("path").agg(F.collect_set("mark").alias("m"))
    pick = lambda names: F.array_sort(F.array_intersect("m", F.array(*map(F.lit, names))))
    out = got.select("path", pick(rules.HEAVY).alias("heavy"), pick(rules.ROUTINE).alias("routine"))
    return out.withColumn("bucket", bucket(F.size("heavy") > 0, F.size("routine") > 0))


def totals(rows: DataFrame, name: str = "bucket") -> DataFrame:
    """files, heavy and routine; files in neither bucket, those that don't read among them, count in
    files alone."""
    return rows.agg(F.count("*").alias("files"), F.count_if(F.col(name) == "heavy").alias("heavy"), F.count_if(F.col(name) == "routine").alias("routine"))
