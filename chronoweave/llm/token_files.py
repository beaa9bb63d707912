"""Token ids in ORC files, in ascending document order.

One row for each document, ids as an integer array: ORC writes them in stripes with integer run-length encoding, with a row index
every ``ROW_INDEX_STRIDE`` rows and Bloom filters on ``doc_id``, so that readers take stripes in parallel and skip those
that can't hold the ids they look for.

Null texts are empty and get the end id alone. Rows that repeat a ``doc_id`` are all written, ordered by a hash of the text.
Null ids stand first. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.llm.blocks import encode_block, lean, text_blocks
from chronoweave.llm.common import scratch, small_batches, table

ROW_INDEX_STRIDE = 2_000
FILE_SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens bigint, tokens array<int>"


def _encoder(tokenizer: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from chronoweave.llm.library import ChunkEncoder

        cache = ChunkEncoder.load(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                ids = [np.append(x, np.int32(end_id)) for x in encode_block(data, offsets, cache)]
                lengths = np.array([len(x) for x in ids], dtype=np.int64)
                ends = np.cumsum(lengths)
                bounds = np.concatenate([[0], ends]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids).astype(np.int32)))
                n = end - first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.full(n, part, dtype=np.int32)),
                        pa.array(before + ends - lengths), pa.array(lengths), tokens],
                    names=["doc_id", "part", "part_start", "n_tokens", "tokens"],
                )
                before += int(ends[-1])

    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``text`` and write ``FILE_SCHEMA`` rows as ORC, one file for each range of ``doc_id``.

    Texts are dealt out before they are encoded, so the sampling of ranges costs a scan and no encoding. ``part`` numbers the
    ranges in order and ``part_start`` counts the ids before a document in its range.
    """
    small_batches(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(lean(_encoder(tokenizer, end_id), resident=True), FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files with ``start``, the ids of all documents before them.

    The totals of the ranges come from one pruned column; their running sum has a row for each file, which bounds the broadcast.
    """
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_base"))
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("part_base") + F.col("part_start"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column(2)
        values = tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = tokens.offsets.to_numpy()
        crc = np.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(bounds).astype(np.int64)),
                pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, write the files, and digest what the files hold."""
    import public_tokenizers

    path = scratch(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "tokens").mapInArrow(lean(_digest, resident=True),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
