"""Exact top-k search by inner product: a Voronoi join of queries and data.

Data are grouped by the nearest of some pivots. A group's summary, its pivot and radius, bounds every inner product with a query
from above: ``q.x <= q.p + |q| r``. A query is first solved in one block of its most promising group, which gives a score that its k-th best
reaches at least; then it goes only to the groups whose bound is not below that score. Groups and their queries are cut into
blocks of at most ``BLOCK`` rows, so hot groups and repeated vectors spread over tasks; blocks are solved locally as matrix
products, and their best rows are merged.

Components become ``floor(64 x)``; vectors that are null or hold null or non-finite components, and rows without id, take no part. Every
other row is a candidate, and a query's own row alone is not: rows that share an id are candidates each, and queries each, with ranks of
their own. Missing trailing components of shorter vectors count as 0. Ties go to the smaller id. An empty table gives an empty
result. Other columns are ignored. Products are exact: in doubles below 2**53, else in integers of 64 bits, which scores must fit;
components beyond 64 bits become the nearest integer of 64 bits. A vector of any length is one row of one task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.llm.common import stored, table

BLOCK = 4096
QUERIES = 2048
#: Rows of a group that are aimed at. Beyond ``FEW_PIVOTS`` pivots grow with the square root of the rows, as far as ``PIVOT_BYTES``, which
#: bounds what is collected and shipped with the code.
GROUP_ROWS = 2048
FEW_PIVOTS = 256
PIVOT_BYTES = 64 << 20
#: Most products of rows and pivots that a task holds at once.
HELD = 1 << 20
SCALE = 64
_LEAST = -(1 << 63)
_RESULT = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
_GROUPED = "row bigint, vec_id bigint, v array<bigint>, cell int, radius double, home int"
_NEEDED = "query_row bigint, query_id bigint, q array<bigint>, sure bigint, cell int"


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v array<bigint>`` of the rows that take part."""
    values = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(values, lambda x: x.isNotNull()
        & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(good).select(F.col("vec_id").cast("bigint"), F.transform(values, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"))


def pivots_for(rows: int, width: int) -> int:
    """How many pivots a table gets."""
    return max(8, min(rows // GROUP_ROWS, max(FEW_PIVOTS, math.isqrt(rows)), PIVOT_BYTES // (8 * width)))


def _slices(batches, pivots: int):
    step = max(1, HELD // max(1, pivots))
    return (batch.slice(at, step) for batch in batches for at in range(0, batch.num_rows, step))


def _matrix(column: pa.Array, width: int, kind: type = float) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=kind)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes):
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def _assign(pivots: np.ndarray):
    def assign(batches):
        squares = (pivots**2).sum(axis=1)
        for batch in _slices(batches, len(pivots)):
            x = _matrix(batch.column(2), pivots.shape[1])
            distance = (x**2).sum(axis=1)[:, None] - 2 * x @ pivots.T + squares[None, :]
            cell = distance.argmin(axis=1)
            home = (x @ pivots.T).argmax(axis=1)
            radius = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(radius), pa.array(home.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "v", "cell", "radius", "home"])

    return assign


def _reach(pivots: np.ndarray, cells: np.ndarray, radii: np.ndarray):
    def reach(batches):
        """The groups that a query needs, by its bound and the score it is sure of."""
        lengths = np.sqrt((pivots[cells] ** 2).sum(axis=1))
        for batch in _slices(batches, len(pivots)):
            q = _matrix(batch.column(2), pivots.shape[1])
            sure = batch.column(3).to_numpy(zero_copy_only=False).astype(float)
            norm = np.sqrt((q**2).sum(axis=1))[:, None]
            bound = q @ pivots[cells].T + norm * radii[None, :]
            # Rounding of the products, the norms, the radius and of components beyond 2**53 grows with their size and the width.
            slack = (8 * pivots.shape[1] + 64) * np.finfo(float).eps * norm * (2 * lengths + radii)[None, :] + 1e-6
            needed = ~(bound + slack < sure[:, None] - 4 * np.finfo(float).eps * np.abs(sure)[:, None])
            row, column = np.nonzero(needed)
            columns = [c.take(pa.array(row)) for c in batch.columns] + [pa.array(cells[column].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_row", "query_id", "q", "sure", "cell"])

    return reach


def _solve(k: int, width: int):
    def solve(key, queries: pa.Table, data: pa.Table) -> pa.Table:
        """The best ``k`` rows of one block for each of its queries, as far as they reach the score the query is sure of."""
        q_row, q_id = queries.column("query_row").to_numpy(), queries.column("query_id").to_numpy()
        rows, ids = data.column("row").to_numpy(), data.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        rows, ids, found = rows[order], ids[order], []
        if len(q_id) and len(ids):
            q, v = (_matrix(c, width) for c in (queries.column("q"), data.column("v")))
            if (q**2).sum(axis=1).max() * (v**2).sum(axis=1).max() >= 2.0**104:  # a product may not fit a double
                q, v = (_matrix(c, width, np.int64) for c in (queries.column("q"), data.column("v")))
            scores = q @ v[order].T
            sure = queries.column("sure").fill_null(_LEAST).to_numpy()
            for score, floor, own, query in zip(scores, sure, q_row, q_id, strict=True):
                good = np.flatnonzero((rows != own) & (score >= floor))
                if len(good) > k:
                    least = np.partition(score[good], len(good) - k)[len(good) - k]
                    good = good[score[good] >= least]
                best = good[np.argsort(-score[good], kind="stable")[:k]]
                found.append((np.full(len(best), own), np.full(len(best), query), ids[best], score[best].astype(np.int64)))
        columns = [np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(4)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_row", "query_id", "vec_id", "score"])

    return solve


def _joined(queries: DataFrame, data: DataFrame, blocks: DataFrame, k: int, width: int, one_block: bool) -> DataFrame:
    """Queries (with ``cell``) against the data of their groups, block by block. ``blocks`` has ``cell, blocks``: a row for each pivot."""
    load = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("queries"))
    cut = blocks.join(load, "cell").select("cell", "blocks", F.ceil(F.col("queries") / QUERIES).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("query_row"), F.col("parts")).cast("int")
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    some = F.array(F.pmod(F.xxhash64("query_row", F.lit(1)), F.col("blocks")).cast("int"))
    met = F.explode(some if one_block else all_blocks).alias("block")
    q = queries.join(F.broadcast(cut), "cell").select("cell", met, part.alias("part"), "query_row", "query_id", "q", "sure")
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    d = data.join(F.broadcast(cut), "cell").select("cell", block.alias("block"), parts, "row", "vec_id", "v")
    keys = ["cell", "block", "part"]
    return q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(_solve(k, width), _RESULT)


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row that fulfils ``is_query`` the ``k`` best others. ``vectors`` has ``vec_id, v``."""
    spark = vectors.sparkSession
    vectors = stored(vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors")
    size = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, size[1] or 1)
    chosen = vectors.orderBy(F.xxhash64("row"), "row").limit(pivots_for(size[0], width)).select("v").toArrow()
    if not chosen.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    pivots = np.unique(_matrix(chosen.column(0), width), axis=0)
    grouped = stored(vectors.mapInArrow(_assign(pivots), _GROUPED), "grouped")
    summary = grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"),
        F.max("radius").alias("radius")).orderBy("cell").collect()  # a row for each pivot
    cells, radii = np.array([r["cell"] for r in summary]), np.array([r["radius"] for r in summary])
    blocks = spark.createDataFrame([(r["cell"], -(-r["rows"] // BLOCK)) for r in summary], "cell int, blocks int")

    query = [F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q")]
    queries = grouped.filter(is_query).select(*query, F.lit(None).cast("bigint").alias("sure"), F.col("home").alias("cell"))
    tried = _joined(queries, grouped, blocks, k, width, one_block=True)
    tried = tried.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    sure = stored(tried.filter(F.col("n") >= k).select("query_row", F.col("least").alias("sure")), "sure")
    floored = queries.drop("sure").join(sure, "query_row", "left").select("query_row", "query_id", "q", "sure")
    needed = stored(floored.mapInArrow(_reach(pivots, cells, radii), _NEEDED), "needed")
    found = _joined(needed, grouped, blocks, k, width, one_block=False)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")), F.col("vec_id") % 20 == 0)
