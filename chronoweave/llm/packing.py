"""Best-fit packing of documents into sequences of a fixed number of tokens.

Lengths are integers of at most ``capacity``, so a packing depends only on how many pieces have each length. The plan is made on
that histogram (``capacity`` numbers, however many documents): pieces above a third of the capacity pair by greedy matching, at
most two to a sequence, and smaller ones go to the tightest remaining gaps. Every piece then finds its place from its
rank among the pieces of its length, which Spark computes from counts by task. Nothing but the histogram reaches the driver.

Null and empty texts have the end id alone. Longer documents are cut at ``capacity``. Repeated ``doc_id`` are packed each for itself; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.llm.blocks import encode_block, lean, text_blocks
from chronoweave.llm.common import small_batches, stored, table

CAPACITY = 2048
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, part_rank bigint"


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from chronoweave.llm.library import ChunkEncoder

        cache = ChunkEncoder.load(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1)):
                row, piece, start, length, crc, rank = [], [], [], [], [], []
                for k, ids in enumerate(encode_block(data, offsets, cache)):
                    raw = np.append(ids, np.int32(end_id)).astype("<u4").tobytes()
                    for n, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part_of = raw[at : at + 4 * capacity]
                        size = len(part_of) // 4
                        row.append(k)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(size)
                        crc.append(zlib.crc32(part_of))
                        rank.append(seen[size])
                        seen[size] += 1
                ids = batch.column(0).slice(first, end - first).take(pa.array(row, pa.int64()))
                columns = [ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int32()),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, dtype=np.int32)),
                    pa.array(np.array(rank, dtype=np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])

    return cut


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The packing plan of a histogram: ``(length, first rank, end rank, first sequence, offset)``.

    Pieces of a length with ranks in a range go one each to consecutive sequences from the first one on, at the offset.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    large = sorted(s for s in left if 3 * s > capacity)
    groups: dict[int, list[list]] = {}  # gap -> [number of sequences, lengths inside]
    while large:
        s = large[-1]
        n = left[s]
        k = bisect_left(large, capacity - s + 1) - 1
        if k < 0:
            groups.setdefault(capacity - s, []).append([n, (s,)])
            large.pop()
            continue
        t = large[k]
        if t == s:
            if n > 1:
                groups.setdefault(capacity - 2 * s, []).append([n // 2, (s, s)])
            left[s] = n % 2
            if left[s]:  # the odd one takes the next smaller, or stays alone
                if k:
                    t = large[k - 1]
                    groups.setdefault(capacity - s - t, []).append([1, (s, t)])
                    left[t] -= 1
                    if not left[t]:
                        large.pop(k - 1)
                else:
                    groups.setdefault(capacity - s, []).append([1, (s,)])
            large.remove(s)
            continue
        pairs = min(n, left[t])
        groups.setdefault(capacity - s - t, []).append([pairs, (s, t)])
        left[s] -= pairs
        left[t] -= pairs
        if not left[t]:
            large.pop(k)
        if not left[s]:
            large.remove(s)
    gaps = sorted(groups)

    def put(gap: int, n: int, inside: tuple) -> None:
        if gap not in groups or not groups[gap]:
            groups[gap] = groups.get(gap, [])
            i = bisect_left(gaps, gap)
            if i == len(gaps) or gaps[i] != gap:
                insort(gaps, gap)
        groups[gap].append([n, inside])

    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(gaps, s)
            if i == len(gaps):
                fit = capacity // s
                if n >= fit:
                    put(capacity - fit * s, n // fit, (s,) * fit)
                if n % fit:
                    put(capacity - (n % fit) * s, 1, (s,) * (n % fit))
                break
            gap = gaps[i]
            group = groups[gap]
            have, inside = group[-1]
            fit = min(gap // s, n)
            used = min(have, n // fit)
            if used == have:
                group.pop()
                if not group:
                    gaps.pop(i)
            else:
                group[-1][0] -= used
            put(gap - fit * s, used, (*inside, *(s,) * fit))
            n -= fit * used
    rank = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    for gap in gaps:
        for n, inside in groups[gap]:
            offset = 0
            for s in inside:
                rows.append((s, rank[s], rank[s] + n, sequence, offset))
                rank[s] += n
                offset += s
            sequence += n
    return rows


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the sequence and the offset where each stands.

    Texts are encoded once, where they are read; what is stored is a few numbers for each piece.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = stored(docs.select(F.col("doc_id").cast("bigint"), "text")
        .mapInArrow(lean(_pieces(tokenizer, end_id, capacity), resident=True), PIECE_SCHEMA), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.createDataFrame(plan_sequences(counts, capacity),
        "length int, rank_from bigint, rank_to bigint, sequence_from bigint, offset bigint")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("part_rank"))
    return (
        ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & F.col("rank").between(F.col("rank_from"), F.col("rank_to") - 1))
        .select("doc_id", "piece", "start", ranked["length"].cast("bigint").alias("length"), "ids_crc32",
            (F.col("sequence_from") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
