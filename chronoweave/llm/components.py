"""Connected components of a graph of links, by union-find inside tasks and alternating stars across them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import discard, stored


#: Links of one file between rounds.
FILE_LINKS = 200_000


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's links as a forest of (node, root)."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links (u bigint, v bigint)``; the root is the smallest node reachable.

    Each round replaces the links of a node by links to its smallest neighbour, first among larger neighbours and then among
    smaller ones, until only stars are left: about log n rounds, each a few aggregations with partial sums and joins whose
    large keys Spark splits. Only two numbers a round reach the driver, one of them the links that are left, which says into how
    many files a round is written. A node linked with itself alone is its own root.
    """
    edges = stored(links.select("u", "v").mapInArrow(_local_forest, "u bigint, v bigint").distinct(), "forest")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
        kept = lambda df, name, files=-(-max(1, now[0]) // FILE_LINKS): stored(df.coalesce(files), name)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the joins by node are between plain shuffles and a hub is split.
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "large")
        small = kept(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        joined = large.join(small, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        following = kept(joined.select("e.*").filter("u <> v").distinct(), "forest")
        for done in (edges, least, large, small):
            discard(done)
        edges = following
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v")
            .alias("node"), F.col("v").alias("root")).distinct())
