"""Scans in two levels, medians in ranges, weights as bits, published versions: against plain forms and models in Python."""

from __future__ import annotations

import itertools
import random
import statistics
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoweave.functions import scans
from chronoweave.functions.ordering import natural_key, with_runs
from chronoweave.operators import asof, assemble, graph, imaging
from chronoweave.sources import publishing

KINDS = {"total": scans.total, "least": scans.least, "latest": scans.latest, "previous": scans.previous, "following": scans.following}


def table(spark, seed, n=200):
    rng = random.Random(seed)
    rows = [(rng.randrange(3), rng.randrange(1000), i, rng.choice([None, *range(5)]), rng.choice(["idle", "run", "rest"])) for i in range(n)]
    return spark.createDataFrame(rows, "session int, time_us bigint, seq bigint, value int, system_state string").repartition(4)


def listed(df, name):
    return [r[0] for r in df.orderBy("session", "time_us", "seq").select(name).collect()]


@pytest.mark.parametrize("width", [1, 37, 5000])
def test_scans_in_two_levels_equal_plain_ones(spark, width):
    df = table(spark, width)
    made = {name: kind(F.col("value")) for name, kind in KINDS.items()}
    plain, cut = (scans.scanned(df, made, ["time_us", "seq"], w).orderBy("session", "time_us", "seq").collect() for w in (None, width))
    assert plain == cut and len(cut) == 200


@pytest.mark.parametrize("width", [1, 90, 5000])
def test_runs_fills_edges_and_starts_in_buckets(spark, width):
    df = table(spark, width + 1)
    framed = scans.scanned(df, {"frame": scans.total(F.lit(1))}, ["time_us", "seq"])
    train = df.withColumn("state", F.coalesce(F.col("value") % 2, F.lit(0)))
    forms = {
        "run": lambda w: with_runs(df, "value", width=w),
        "filled": lambda w: assemble.gated_fill(framed, "filled", "value", ["run"], width=w),
        "pulse_id": lambda w: imaging.edges(train, w),
        "start_us": lambda w: asof.window_starts(framed, w),
        "elapsed_min": lambda w: asof.elapsed_minutes(df, df if w else None),
        "speed": lambda w: asof.running_speed(framed.withColumn("distance", F.col("seq") / 3), 80, width=w),
        "run_pulses": lambda w: imaging.pulse_runs(framed.select("session", "time_us", "seq", "frame"), w).withColumnRenamed("run", "run_pulses"),
    }
    for name, form in forms.items():
        assert listed(form(None), name) == listed(form(width), name), name
    water = framed.withColumns({"tone_state": F.col("value"), "volume": F.col("seq") * 1.0})
    plain, cut = (assemble.reward_classes(water, width=w) for w in (None, width))
    for name in ("run", "delta", "run_volume", "reward"):
        assert listed(plain, name) == listed(cut, name)


def test_a_long_session_is_no_task_of_its_own(spark):
    """A million rows of one session are spread over the tasks, and a window of ten thousand samples is no work for each of them."""
    long = spark.range(1_000_000).select(F.floor(F.col("id") / 1e9).alias("session"), (F.col("id") * 1000).alias("time_us"), F.col("id").alias("seq"),
        (F.col("id") % 1000 < 400).alias("tone"))
    runs = with_runs(long, "tone", width=50_000_000)
    assert runs.agg(F.max("run")).first()[0] == 2000
    assert max(r["count"] for r in runs.groupBy(F.spark_partition_id()).count().collect()) < 700_000
    speed = asof.running_speed(long.filter("seq < 200000").withColumn("distance", F.col("seq") * 0.5), 10_000_000, width=50_000_000)
    assert speed.filter("seq > 10000").agg(F.min("speed"), F.max("speed")).first() == (500.0, 500.0)


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_medians_equal_sorted_values(spark, most):
    rng = random.Random(most)
    groups = {k: [rng.choice([rng.random(), rng.randrange(4), 1e12 * rng.random(), -3.0]) for _ in range(rng.choice([1, 2, 30, 31, 64]))] for k in range(12)}
    groups[20] = [7.0] * 40
    groups[21] = [2.0 ** k for k in range(-200, 200)]
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [(k, x) for k in (0, 30) for x in (None, float("nan"))]
    df = spark.createDataFrame(rows, "session int, v double").repartition(3)
    got = {r["session"]: r["m"] for r in scans.medians(df, F.col("v"), "m", ranges=4, most=most).collect()}
    assert got.keys() == groups.keys()
    assert all(np.isclose(got[k], statistics.median(v), rtol=1e-15) for k, v in groups.items())


def naive_weights(edges, cores):
    after = {}
    for job, need in edges:
        after.setdefault(need, set()).add(job)
    out = {}
    for job in cores:
        seen, todo = set(), [job]
        while todo:
            for follower in after.get(todo.pop(), ()):
                if follower not in seen:
                    seen.add(follower)
                    todo.append(follower)
        out[job] = sum(cores[j] for j in seen - {job})
    return out


@pytest.mark.parametrize("counted", [3, 4096])
def test_weights_equal_a_walk_over_the_graph(spark, monkeypatch, counted):
    rng = random.Random(counted)
    for _ in range(150):
        n = rng.randint(1, 14)
        edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 25))}
        after = [[job for job, need in edges if need == k] for k in range(n)]
        cores = np.array([rng.randint(0, 9) for _ in range(n)])
        parts = sum(graph.reached_weights(after, cores, k, min(k + counted, n)) for k in range(0, n, counted))
        assert dict(enumerate(parts.tolist())) == naive_weights(edges, dict(enumerate(cores.tolist())))
    jobs = [(u * 100 + k, u, rng.randint(1, 8)) for u in range(6) for k in range(20)]
    edges = [(u * 100 + rng.randrange(20), u * 100 + rng.randrange(20)) for u in range(6) for _ in range(40)] + [(5, 105), (999, 3)]
    jobs_df, edges_df = spark.createDataFrame(jobs, "job_id bigint, unit int, cores int"), spark.createDataFrame(edges, "job_id bigint, needs bigint")
    want = naive_weights([e for e in edges if e[0] // 100 == e[1] // 100], {j: c for j, _, c in jobs})
    assert {r["job_id"]: r["weight"] for r in graph.downstream_weight(jobs_df, edges_df, "unit").collect()} == want
    monkeypatch.setattr(graph, "HELD_EDGES", 39)  # every unit goes through the joins
    assert {r["job_id"]: r["weight"] for r in graph.downstream_weight(jobs_df, edges_df, "unit").collect()} == want


def test_a_chain_of_ten_thousand_jobs(spark):
    n = 10_000
    jobs = spark.range(n).select(F.col("id").alias("job_id"), F.lit(1).alias("unit"), F.lit(2).alias("cores"))
    edges = spark.range(1, n).select(F.col("id").alias("job_id"), (F.col("id") - 1).alias("needs"))
    got = {r["job_id"]: r["weight"] for r in graph.downstream_weight(jobs, edges, "unit").collect()}
    assert got == {k: 2 * (n - 1 - k) for k in range(n)}


def test_natural_keys_of_any_length(spark):
    rng = random.Random(8)
    names = ["a1" + "0" * 24, "a9" + "0" * 20, *["".join(rng.choice(["a", "b", "_", str(rng.randrange(10 ** rng.randint(1, 40))),
        "00" + str(rng.randrange(50))]) for _ in range(rng.randint(1, 4))) for _ in range(400)]]
    split = lambda name: [(0, int("".join(g)), "") if digit else (1, 0, "".join(g)) for digit, g in itertools.groupby(name, str.isdigit)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(3)
    assert [r["name"] for r in df.orderBy(natural_key(F.col("name")), "name").collect()] == sorted(names, key=lambda n: (split(n), n))


def test_readers_never_fail_or_mix_while_tables_are_published(spark, tmp_path):
    """A reader polls during fifty publishes of a detail table and its summary."""
    path, seen, failures = str(tmp_path / "state"), [], []
    detail = lambda n: spark.range(n, n + 3).coalesce(1)
    summary = lambda n: spark.range(1).select(F.lit(n).alias("first"))
    publishing.publish({"detail": detail(0), "summary": summary(0)}, path)
    done = threading.Event()

    def poll():
        while not done.is_set():
            try:
                version = publishing.current_version(spark, path)
                first = publishing.read_published(spark, path, "summary", version).first()["first"]
                rows = sorted(r["id"] for r in publishing.read_published(spark, path, "detail", version).collect())
                if rows != [first, first + 1, first + 2] or (seen and first < seen[-1]):
                    failures.append((first, rows))
                seen.append(first)
            except Exception as error:  # any failure of a reader counts
                failures.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for n in range(1, 51):
        publishing.publish({"detail": detail(n), "summary": summary(n)}, path)
    done.set()
    reader.join()
    assert not failures and len(set(seen)) > 3
    assert publishing.read_published(spark, path, "summary").first()["first"] == 50


def test_two_writers_conflicts_and_retired_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    assert publishing.current_version(spark, path) == 0
    with pytest.raises(FileNotFoundError):
        publishing.read_published(spark, path, "a")
    writers = [threading.Thread(target=publishing.publish, args=({name: spark.range(n)}, path)) for name, n in (("a", 3), ("b", 4), ("c", 5), ("d", 6))]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert publishing.current_version(spark, path) == 4
    assert [publishing.read_published(spark, path, name).count() for name in "abcd"] == [3, 4, 5, 6]
    with pytest.raises(publishing.Conflict):
        publishing.publish({"a": spark.range(9)}, path, expected=3)
    assert publishing.publish({"a": spark.range(9)}, path, expected=4) == 5
    publishing.retire(spark, path, keep=1)
    assert [publishing.read_published(spark, path, name).count() for name in "abcd"] == [9, 4, 5, 6]
    with pytest.raises(FileNotFoundError):
        publishing.read_published(spark, path, "a", 4)
    assert len(list((tmp_path / "state" / "data").iterdir())) == 4
