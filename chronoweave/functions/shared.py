"""The folder that driver and executors share: tables computed once, and new paths in it."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets a temporary folder, a cluster an error."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="chronoweave-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """``df`` by keys in so many parts, a number that its caller lets grow with the input; without one Spark deals it as a join needs it."""
    return df if parts is None else df.repartition(parts, *keys)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
