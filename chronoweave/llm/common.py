"""Session helpers of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoweave.llm.blocks import lean, text_blocks


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names; without one a local session gets a temporary folder, a cluster an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="chronoweave-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch between Spark and Python workers. Texts are long; Spark's default of 10,000 rows would hold tens of MB several times over.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` where they are larger; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, and nothing is computed twice."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(column: str = "doc_id"):
    """Whether crc32 of an id as text is 0 modulo 5; a row without id, which can't have labels, is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of the ids that are not held out; of several labels of an id the largest counts."""
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    return usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def discard(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, when all that was made of it is stored itself."""
    jvm = df.sparkSession._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_score(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], name: str = "score") -> DataFrame:
    """Every row of ``docs`` with a number computed from its ``text``; ``score`` takes the bytes and offsets of a block of texts."""
    at = docs.columns.index("text")

    def append(batches):
        for batch in batches:
            parts = [score(data, offsets) for _, _, data, offsets in text_blocks(batch.column(at), 4 << 20)]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(lean(append), StructType([*docs.schema.fields]).add(name, "double"))
