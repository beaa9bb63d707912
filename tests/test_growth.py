"""What keeps work from growing faster than the input: plans and passes of single steps."""

from __future__ import annotations

from conftest import SF
from pyspark.sql import functions as F

from chronoweave.functions import scans
from chronoweave.functions.ordering import natural_sort
from chronoweave.operators import runtime_log, scheduler
from chronoweave.plans import state_queries, stream_queries, tables


def test_natural_keys_are_made_before_the_sort(spark):
    df = spark.createDataFrame([("a10",), ("a2",), (None,), ("a02",)], "name string")
    out = natural_sort(df, "name")
    assert [r.name for r in out.collect()] == ["a02", "a2", "a10", None] and out.columns == ["name"]
    sorts = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in line]
    assert sorts and not any("regexp" in line for line in sorts)


def test_reconcile_reads_its_edges_once(spark):
    """A chain of six jobs behind a lost one takes six rounds; edges may be a long plan."""
    rows = spark.createDataFrame([(k, "running" if k == 0 else "dropped", "gone", "gone", "a", "") for k in range(7)],
        "job_id long, verdict string, scheduler_state string, claim_state string, allocation string, claim string")
    read = spark.sparkContext.accumulator(0)

    def counted(k):
        read.add(1)
        return (k, k - 1)

    edges = spark.createDataFrame(spark.sparkContext.parallelize(range(1, 7), 2).map(counted), "job_id long, needs long")
    out = {r.job_id: r.decision for r in scheduler.reconciled(rows, edges).collect()}
    assert set(out.values()) == {"withheld"} and len(out) == 7
    assert read.value == 6


def test_jobs_are_dealt_to_as_many_tasks_as_they_have_rows(spark, monkeypatch):
    rows = tables.read(spark, SF, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_OF_TASK", rows // 9)
    assert state_queries._jobs(spark, SF).rdd.getNumPartitions() == -(-rows // (rows // 9)) > 4


def test_cues_are_not_sorted_once_opened(spark):
    placed = spark.createDataFrame([(1, 0, 0, 5.0, 30.0, False), (1, 0, 1, 30.0, 42.0, True)],
        "session long, corridor long, place int, start_cm double, end_cm double, truncated boolean")
    cues = F.expr("array(named_struct('code', 7, 'length_cm', 10.0D), named_struct('code', 8, 'length_cm', cast(null as double)), "
        "named_struct('code', 9, 'length_cm', 5.0D), named_struct('code', 7, 'length_cm', 1.0D))")
    out = runtime_log.cue_onsets(placed.withColumn("cues", cues))
    assert [tuple(r) for r in out.orderBy("place", "cue_place").collect()] == [(1, 0, 0, k, c, 5.0 + at) for k, c, at in
        ((0, 7, 0.0), (1, 8, 10.0), (2, 9, 10.0), (3, 7, 15.0))] + [(1, 0, 1, k, c, 30.0 + at) for k, c, at in ((0, 7, 0.0), (1, 8, 10.0), (2, 9, 10.0))]
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_trials_are_dealt_to_as_many_tasks_as_they_have_rows(spark, monkeypatch):
    rows = tables.read(spark, SF, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_OF_TASK", rows // 9)
    assert stream_queries._placed(spark, SF).rdd.getNumPartitions() == -(-rows // (rows // 9)) > 4


def test_job_edges_are_dealt_to_as_many_tasks_as_they_have_rows(spark, monkeypatch):
    rows = tables.read(spark, SF, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_OF_TASK", rows // 9)
    parts = -(-rows // (rows // 9))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert state_queries.Q["d7_job_edges"](spark, SF).rdd.getNumPartitions() == 2 * parts > 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_groups_are_not_shuffled_for_their_median(spark, monkeypatch):
    kept = []
    plain = scans.settled
    monkeypatch.setattr(scans, "settled", lambda df: kept.append(df) or plain(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(20_003).selectExpr("cast(if(id < 3, id, 9) as long) as session", "cast(id * 7919 % 20011 as double) as v")
        found = {r.session: r.m for r in scans.medians(rows, F.col("v"), "m", ranges=8, most=100).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {r.session: r.m for r in rows.groupBy("session").agg(F.expr("median(v)").alias("m")).collect()}
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in kept]
    # Only the sessions with few values are joined by a shuffle, in the last table alone.
    assert [plan.count("SortMergeJoin") for plan in plans] == [0] * (len(plans) - 1) + [1] and len(plans) > 4


def test_depths_read_what_they_need_and_are_dealt_by_rows(spark, monkeypatch):
    rows = tables.read(spark, SF, "lineitem").count()
    monkeypatch.setattr(tables, "ROWS_OF_TASK", rows // 9)
    kept = []
    plain = state_queries.settled
    monkeypatch.setattr(state_queries, "settled", lambda df: kept.append(df.columns) or plain(df))
    assert state_queries.Q["g5_depth_order"](spark, SF).rdd.getNumPartitions() == -(-rows // (rows // 9)) > 4
    assert kept == [["job_id", "line"]]
