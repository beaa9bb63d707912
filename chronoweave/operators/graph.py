"""Job graphs: outstanding work, blocked jobs, weights and depth. Loops of joins that stop when nothing is new; cycles are no trouble.

Each round is written to the shared folder (``checkpoint``), so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.shared import dealt, settled
from chronoweave.operators.state import SUCCEEDED

MOST_LISTED = 50


def batch_document(units: DataFrame, state: DataFrame, plan: DataFrame) -> DataFrame:
    """G1: outstanding jobs of each unit with planned figures; units without state, or with unplanned jobs, carry a reason.

    ``state`` has ``unit, job_id, status``; ``plan`` ``unit, job_id, cores, memory_mb``.
    """
    tracked = units.join(state, "unit", "left")
    open_jobs = tracked.filter("job_id is not null and status <> 'SUCCEEDED'").join(plan, ["unit", "job_id"], "left")
    lacking = open_jobs.groupBy("unit").agg(F.count_if(F.col("cores").isNull()).alias("unplanned"))
    reason = F.when(F.col("job_id").isNull(), "no job state").when(F.col("unplanned") > 0, "jobs without a plan")
    missing = tracked.filter("job_id is null").select("unit", "job_id", "status", F.lit(None).cast("int").alias("cores"),
        F.lit(None).cast("bigint").alias("memory_mb"))
    both = open_jobs.select("unit", "job_id", "status", F.col("cores").cast("int").alias("cores"),
        F.col("memory_mb").cast("bigint").alias("memory_mb")).unionByName(missing)
    return both.join(lacking, "unit", "left").select("unit", "job_id", "status", "cores", "memory_mb", reason.alias("reason"))


def narrowed(jobs: DataFrame) -> DataFrame:
    """Prerequisites of each unit's jobs limited to the jobs that are tracked; a unit is never gathered, however many jobs it has."""
    asked = jobs.select("unit", "prerequisites", F.explode(F.array_distinct("prerequisites")).alias("job_id"))
    there = asked.join(jobs.select("unit", "job_id").distinct(), ["unit", "job_id"], "left_semi")
    inside = there.groupBy("unit", "prerequisites").agg(F.sort_array(F.collect_set("job_id")).alias("_inside"))
    none = F.slice("prerequisites", 1, 0)
    kept = F.when(F.col("prerequisites").isNotNull(), F.coalesce("_inside", none))
    columns = [kept.alias(c) if c == "prerequisites" else F.col(c) for c in jobs.columns]
    return jobs.join(inside, ["unit", "prerequisites"], "left").select(*columns)


def together(rounds: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rounds)


def joined(rounds: list[DataFrame], fresh: DataFrame, most: int = 16) -> list[DataFrame]:
    """The results of all rounds; many small ones become one table, so that plans of deep graphs stay short."""
    rounds = [*rounds, fresh]
    return rounds if len(rounds) < most else [settled(together(rounds))]


def blocked(jobs: DataFrame, edges: DataFrame) -> DataFrame:
    """``job_id, round, unmet``: jobs blocked by a prerequisite that neither succeeded nor runs here, or is itself blocked.

    ``jobs`` has ``job_id, status, here`` (whether it runs in this batch); ``edges`` ``job_id, needs``. ``unmet`` lists the
    prerequisites that were unmet in the round that blocked the job. Jobs that don't run here aren't listed.
    """
    links = settled(edges.select("job_id", "needs").join(jobs.filter("here").select("job_id"), "job_id", "left_semi"))
    bad = jobs.filter(~F.col("here") & (F.col("status") != SUCCEEDED)).select(F.col("job_id").alias("needs"))
    unknown = links.join(jobs.select(F.col("job_id").alias("needs")), "needs", "left_anti").select("needs")
    # A job that is still free needs nothing that was unmet before, so a round looks at what the round before it blocked.
    bad, rounds = bad.unionByName(unknown).distinct(), []
    for number in count(1):
        fresh = links.join(bad, "needs", "left_semi")
        if rounds:
            fresh = fresh.join(together(rounds).select("job_id"), "job_id", "left_anti")
        fresh = settled(fresh.groupBy("job_id").agg(F.sort_array(F.collect_set("needs")).alias("unmet")).withColumn("round", F.lit(number)))
        if number > 1 and fresh.isEmpty():
            return together(rounds)
        rounds = joined(rounds, fresh)
        bad = fresh.select(F.col("job_id").alias("needs"))


def closure(edges: DataFrame) -> DataFrame:
    """``job_id, after``: every job with all jobs that need it, directly or not; each pair once. A round writes its new pairs only."""
    step = settled(edges.select(F.col("needs").alias("job_id"), F.col("job_id").alias("after")).distinct())
    rounds, fresh = [step], step
    while True:
        known = together(rounds)
        longer = fresh.select("job_id", F.col("after").alias("via")).join(step.select(F.col("job_id").alias("via"),
                "after"), "via").select("job_id", "after").distinct()
        fresh = settled(longer.join(known, ["job_id", "after"], "left_anti"))
        if fresh.isEmpty():
            return known
        rounds = joined(rounds, fresh)


#: Dependents that a task counts at once, and most edges of a unit that a task holds; larger units go through ``closure``.
COUNTED, HELD_EDGES = 4096, 2_000_000


def _groups(after: list[list[int]]) -> list[list[int]]:
    """Strongly connected groups of a graph, those that lead nowhere first; without recursion."""
    number, low, on, stack, out = [-1] * len(after), [0] * len(after), [False] * len(after), [], []
    seen = 0
    for root in range(len(after)):
        if number[root] >= 0:
            continue
        path = [(root, 0)]
        while path:
            node, at = path.pop()
            if at == 0:
                number[node] = low[node] = seen
                seen += 1
                stack.append(node)
                on[node] = True
            elif at > 0 and on[after[node][at - 1]]:
                low[node] = min(low[node], low[after[node][at - 1]])
            if at < len(after[node]):
                path.append((node, at + 1))
                follower = after[node][at]
                if number[follower] < 0:
                    path.append((follower, 0))
            elif low[node] == number[node]:
                group = []
                while not group or group[-1] != node:
                    group.append(stack.pop())
                    on[group[-1]] = False
                out.append(group)
    return out


def reached_weights(after: list[list[int]], cores: np.ndarray, first: int, end: int) -> np.ndarray:
    """For each job of a graph the cores of the jobs ``first .. end - 1`` that it leads to, itself left out: one set of bits for each group."""
    own, weights = np.asarray(cores[first:end], dtype=np.int64), np.zeros(len(after), dtype=np.int64)
    group_of, sets = [0] * len(after), []
    for index, group in enumerate(_groups(after)):
        bits = 0
        for node in group:
            group_of[node] = index
        for node in group:
            if len(group) > 1 and first <= node < end:
                bits |= 1 << (node - first)
            for follower in after[node]:
                if group_of[follower] != index:
                    bits |= sets[group_of[follower]] | (1 << (follower - first) if first <= follower < end else 0)
        sets.append(bits)
        if end - first <= 64:
            total = sum(int(own[k]) for k in range(end - first) if bits >> k & 1)
        else:
            packed = np.frombuffer(bits.to_bytes((end - first + 7) // 8, "little"), dtype=np.uint8)
            total = int(np.unpackbits(packed, bitorder="little", count=end - first) @ own)
        for node in group:
            weights[node] = total - (int(own[node - first]) if len(group) > 1 and first <= node < end else 0)
    return weights


def _unit_weights(block: int, rows: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The jobs of one unit with what they lead to inside one block of its jobs; rows are job, what it needs, and the job's cores."""
    place = {job: k for k, job in enumerate(sorted({x for row in rows for x in row[:2]}))}
    cores, after = np.zeros(len(place), dtype=np.int64), [[] for _ in place]
    for job, need, own in set(rows):
        cores[place[job]] = own
        after[place[need]].append(place[job])
    first = block * COUNTED
    if first >= len(place):
        return []
    weights = reached_weights(after, cores, first, min(first + COUNTED, len(place))).tolist()
    return [(job, weights[k]) for job, k in place.items() if weights[k]]


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come unit by unit and block by block; columns are unit, block, job_id, needs, cores."""
    now, held = None, []
    for batch in itertools.chain(batches, [None]):
        found: list[tuple[int, int]] = []
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else [(None,) * 5]
        for unit, block, *row in rows:
            if (unit, block) != now:
                found += _unit_weights(now[1], held) if held else []
                now, held = (unit, block), []
            held.append(tuple(row))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["job_id", "weight"])


def downstream_weight(jobs: DataFrame, edges: DataFrame, unit: str | None = None) -> DataFrame:
    """Cores of all distinct transitive dependents; 0 without any. A job on a cycle doesn't count itself.

    With ``unit``, a column of ``jobs`` with ids as numbers, weights stay inside a unit, and no pair of jobs is written: a task has the edges of one
    unit and counts ``COUNTED`` of its jobs as dependents of all, as bits that are merged from the last jobs to the first. A unit of
    n jobs is n / ``COUNTED`` tasks. Units of over ``HELD_EDGES`` edges, and all without ``unit``, are closed by joins, pair by pair.
    """
    if unit is None:
        found = closure(edges)
        weights = found.filter("job_id <> after").join(jobs.select(F.col("job_id").alias("after"), "cores"), "after").select("job_id", F.col("cores").alias("weight"))
    else:
        own = jobs.select("job_id", F.col(unit).alias("unit"), F.coalesce("cores", F.lit(0)).cast("bigint").alias("cores"))
        inside = edges.select("job_id", "needs").join(own, "job_id").join(own.select(F.col("job_id").alias("needs"), "unit"), ["needs", "unit"])
        inside = settled(inside.select("unit", F.col("job_id").cast("bigint"), F.col("needs").cast("bigint"), "cores"))
        sizes = settled(inside.groupBy("unit").agg(F.count(F.lit(1)).alias("_edges")))
        blocks = F.explode(F.sequence(F.lit(0), F.floor(2 * F.col("_edges") / COUNTED).cast("int"))).alias("block")
        dealt = inside.join(sizes.filter(F.col("_edges") <= HELD_EDGES).select("unit", blocks), "unit")
        dealt = dealt.select("unit", "block", "job_id", "needs", "cores").repartition("unit", "block").sortWithinPartitions("unit", "block")
        weights = dealt.mapInArrow(_reached, "job_id bigint, weight bigint")
        large = inside.join(sizes.filter(F.col("_edges") > HELD_EDGES).select("unit"), "unit", "left_semi")
        if not large.isEmpty():
            pairs = closure(large).filter("job_id <> after").join(own.select(F.col("job_id").alias("after"), "cores"), "after")
            weights = weights.unionByName(pairs.select("job_id", F.col("cores").alias("weight")))
    weights = weights.groupBy("job_id").agg(F.sum("weight").alias("weight"))
    return jobs.join(weights, "job_id", "left").select("job_id", F.coalesce("weight", F.lit(0)).cast("bigint").alias("weight"))


def submission_order(jobs: DataFrame, edges: DataFrame, most: int | None = None, parts: int | None = None) -> DataFrame:
    """``job_id, depth``: longest path of prerequisites inside the batch; rounds are at most the number of jobs.

    Round k holds the jobs at the end of a path of length k, so rounds shrink; the last one that holds a job is its depth. ``parts`` is the
    number of tasks that jobs are dealt to.
    """
    own = dealt(jobs.select("job_id"), parts, "job_id")
    needed = dealt(jobs.select(F.col("job_id").alias("needs")), parts, "needs")
    inside = settled(edges.join(own, "job_id", "left_semi").join(needed, "needs", "left_semi"))
    limit = jobs.count() if most is None else most
    rounds = [jobs.select("job_id", F.lit(0).cast("bigint").alias("depth"))]
    behind = inside  # what is needed stands in the batch, so the first round has nothing to look up
    for number in range(1, limit + 1):
        reached = settled(behind.select("job_id").distinct())
        if reached.isEmpty():
            break
        rounds = joined(rounds, reached.withColumn("depth", F.lit(number).cast("bigint")))
        behind = inside.join(reached.select(F.col("job_id").alias("needs")), "needs", "left_semi")
    return dealt(together(rounds), parts, "job_id").groupBy("job_id").agg(F.max("depth").alias("depth"))


def outcome(batch: DataFrame, edges: DataFrame) -> DataFrame:
    """``batch_id, succeeded, failed, blocked, outstanding, complete, listed``; a job is blocked if a prerequisite failed.

    ``listed`` holds the first 50 failed and blocked jobs by id.
    """
    failed = batch.filter("status = 'FAILED'").select(F.col("batch_id"), F.col("job_id").alias("needs"))
    behind = edges.join(failed, "needs").select("batch_id", "job_id").distinct().withColumn("_behind", F.lit(True))
    kind = F.when(F.col("status") == SUCCEEDED, "succeeded").when(F.col("status") == "FAILED",
        "failed").when(F.col("_behind"), "blocked").otherwise("outstanding")
    rows = batch.join(behind, ["batch_id", "job_id"], "left").withColumn("kind", kind)
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in ("succeeded", "failed", "blocked", "outstanding")]
    out = rows.groupBy("batch_id").agg(*counts).withColumn("complete", F.col("outstanding") == 0)
    # Spark keeps the first of each batch before it shuffles, so a large batch is not gathered.
    bad = rows.filter(F.col("kind").isin("failed", "blocked") & F.col("job_id").isNotNull())
    place = F.row_number().over(Window.partitionBy("batch_id").orderBy("job_id"))
    first = bad.select(F.col("batch_id").alias("_batch"), "job_id", place.alias("_place")).filter(F.col("_place") <= MOST_LISTED)
    first = first.groupBy("_batch").agg(F.sort_array(F.collect_list("job_id")).alias("listed"))
    none = F.array().cast(first.schema["listed"].dataType)
    listed = out.join(first, F.col("batch_id").eqNullSafe(F.col("_batch")), "left").withColumn("listed", F.coalesce("listed", none))
    return listed.drop("_batch")


def recorded_batches(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Prepared and settled batches: all that have a document or an outcome."""
    return documents.join(outcomes, "batch_id", "full").withColumn("state",
        F.when(F.col("complete"), "settled").when(F.col("complete").isNull(), "prepared").otherwise("running"))
