"""Tables in the folder that all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one of our own in local mode, and an error on a
    cluster, whose machines would not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="marlstone-")
    return _own[app]


def fresh(spark: SparkSession, name: str) -> str:
    """A path in it that nothing has used."""
    return f"{folder(spark)}/marlstone/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written there and read again: what isn't the same each time it is computed is settled, and a lost
    executor costs a re-read."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
