"""Small cases with known answers, and models in plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
from compare import difference, oracle
from conftest import SF
from pyspark.sql import functions as F

from chronoweave.functions import expect, registry
from chronoweave.functions.ordering import natural_places, natural_sort
from chronoweave.operators import asof, assemble, graph, imaging, pose, runtime_log, scheduler, streams, video
from chronoweave.plans import assembly_queries
from chronoweave.plans.registry import ORACLE_SQL, QUERIES
from chronoweave.sources import ingest


def series(spark, times, values, name="value", kind="double"):
    rows = [(1, t, i, v) for i, (t, v) in enumerate(zip(times, values, strict=True))]
    return spark.createDataFrame(rows, f"session int, time_us bigint, seq bigint, {name} {kind}")


def ticks(spark, times):
    return spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "session int, frame bigint, time_us bigint")


def column(df, name, order="frame"):
    return [r[name] for r in df.orderBy(order).collect()]


def random_times(rng, n, top=2000):
    return sorted(rng.sample(range(top), n))


def starts_of(times):
    """First times of the windows that end at ``times``."""
    first = times[0] - 1 if len(times) == 1 else 2 * times[0] - times[1]
    return [first, *times[:-1]]


def held(times, values, at):
    before = [v for t, v in zip(times, values, strict=True) if t <= at]
    return before[-1] if before else values[0]


@pytest.mark.parametrize("n", [1, 2, 25])
def test_window_starts(spark, n):
    times = random_times(random.Random(n), n)
    assert column(asof.window_starts(ticks(spark, times)), "start_us") == starts_of(times)


@pytest.mark.parametrize("seed", range(3))
def test_windows_equal_brute_force(spark, seed):
    """Onsets, signed peaks and maxima of random series, window by window."""
    rng = random.Random(seed)
    clock, times = random_times(rng, 30), random_times(rng, 90)
    windows = list(zip(starts_of(clock), clock, strict=True))
    states = [rng.randint(0, 2) for _ in times]
    onsets = [t for k, t in enumerate(times) if states[k] > 0 and (k == 0 or states[k - 1] <= 0)]
    got = column(asof.window_onsets(series(spark, times, states, "state", "int"), ticks(spark, clock)), "onset")
    assert got == [int(any(a < t <= b for t in onsets)) for a, b in windows]

    values = [float(rng.randint(-4, 4)) for _ in times]
    want = []
    for a, b in windows:
        inside = [held(times, values, a), *[v for t, v in zip(times, values, strict=True) if a < t <= b]]
        want.append(max(inside, key=abs))  # the first of equally strong ones
    assert column(asof.signed_peaks(series(spark, times, values), ticks(spark, clock)), "peak") == want

    gappy = [float("nan") if rng.random() < 0.4 else v for v in values]
    few, some = times[::3], gappy[::3]
    want = []
    for a, b in windows:
        inside = [v for t, v in zip(few, some, strict=True) if a < t <= b]
        known = [v for v in inside if v == v]
        want.append(max(known) if known else float("nan") if inside else np.interp(b, few, some))
    assert np.allclose(column(asof.window_maxima(series(spark, few, some), ticks(spark, clock)), "maximum"), want, equal_nan=True)


@pytest.mark.parametrize("seed", range(3))
def test_zones_equal_brute_force(spark, seed):
    """Zones that overlap, touch, lie inside one another, or end before they begin."""
    rng = random.Random(seed)
    zones = [(float(a), float(a + rng.randint(-3, 12))) for a in (rng.randrange(200) for _ in range(20))]
    places = [float(rng.randrange(-5, 220)) for _ in range(150)] + [None, float("nan")]
    rows = spark.createDataFrame([(1, i, d) for i, d in enumerate(places)] + [(2, 900, 5.0)], "session int, frame int, distance double")
    got = asof.in_zones(rows, spark.createDataFrame([(1, *z) for z in zones], "session int, start_cm double, end_cm double"))
    assert column(got, "in_zone") == [int(d is not None and any(a <= d <= b for a, b in zones)) for d in places] + [0]


@pytest.mark.parametrize("window", [7_000, 90_000, 2_000_000])
def test_running_speed_equals_brute_force(spark, window):
    rng = random.Random(window)
    times = sorted(rng.randrange(400_000) for _ in range(80))
    distance = np.cumsum([rng.choice([-1.5, 0.0, 2.25]) for _ in times]).tolist()
    want = []
    for t, d in zip(times, distance, strict=True):
        k = next(k for k, other in enumerate(times) if other >= t - window)
        want.append((d - distance[k]) / (t - times[k]) * 1e6 if t > times[k] and d > distance[k] else 0.0)
    # Rows of equal time share a window; only the last of them is compared where they differ.
    assert np.allclose(column(asof.running_speed(series(spark, times, distance, "distance"), window), "speed", "seq"), want)


def test_a_long_session_is_filled_in_one_pass(spark):
    """What comes next is filled by a frame that ends at the current row: one that begins there is read to its end for every row."""
    source, targets = series(spark, [1], [1.0]), ticks(spark, [1])
    for df in (asof.linear(source, targets, ["value"]), asof.linear(source, targets, ["value"], width=5),
            asof.align_all(targets, [(source, ["value"], "linear")])):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "currentrow$()" in plan and "unboundedfollowing$()" not in plan


def test_bucketed_equals_plain(spark):
    rng = random.Random(3)
    source = series(spark, sorted(rng.randrange(10_000) for _ in range(200)), [rng.random() for _ in range(200)])
    targets = ticks(spark, sorted(rng.randrange(10_000) for _ in range(100)))
    for f in (asof.hold, asof.linear):
        plain = column(f(source, targets, ["value"]), "value")
        for width in (1, 700, 100_000):
            assert np.allclose(column(f(source, targets.repartition(3), ["value"], width=width), "value"), plain)


def test_all_streams_at_once(spark):
    rng = random.Random(9)
    sources = [series(spark, sorted(rng.randrange(1000) for _ in range(60)), [rng.random() for _ in range(60)], name) for name in ("a", "b")]
    targets = ticks(spark, sorted(rng.randrange(1000) for _ in range(50)))
    both = asof.align_all(targets, [(sources[0], ["a"], "hold"), (sources[1], ["b"], "linear")])
    assert column(both, "a") == column(asof.hold(sources[0], targets, ["a"]), "a")
    assert np.allclose(column(both, "b"), column(asof.linear(sources[1], targets, ["b"]), "b"))


def events_of(spark, **codes):
    names = {"opened": 51, "closed": 52, "on": 54, "off": 55}
    rows = sorted((t, names[name]) for name, times in codes.items() for t in times)
    return spark.createDataFrame([(1, t, i, c, 0.0) for i, (t, c) in enumerate(rows)],
        "session int, time_us bigint, seq bigint, event int, value double")


@pytest.mark.parametrize("seed", range(3))
def test_valve_equals_brute_force(spark, seed):
    """Rows at every close and every change of the tone; a tone that is never switched off ends one step later."""
    rng = random.Random(seed)
    edges = random_times(rng, 9)
    closed, opened = edges[::2], edges[1::2]
    tone = [t + 0.0 for t in random_times(rng, 6) if t not in edges]
    tone = [int(t) for t in tone if t > closed[0]][: 4 - seed % 2]
    on, off = tone[::2], tone[1::2]
    rows = {t: 1 for t in on} | {t: 0 for t in off}
    if len(on) > len(off):
        rows[on[-1] + 1] = 0
    got = streams.valve(events_of(spark, closed=closed, opened=opened, on=on, off=off), 1.0, 1.0).orderBy("time_us").collect()
    assert [r["time_us"] for r in got] == sorted({*closed, *rows})
    changes = sorted(rows.items())
    if changes:
        assert [r["tone_state"] for r in got] == [held([t for t, _ in changes], [v for _, v in changes], r["time_us"]) for r in got]


@pytest.mark.parametrize("first", [0, 1])
def test_screen_flips_at_each_rise(spark, first):
    times = random_times(random.Random(first), 8)
    got = streams.screen(events_of(spark, opened=times[1::2], closed=times[::2]), first).orderBy("time_us").collect()
    assert [(r["time_us"], r["screen_state"]) for r in got] == [(times[0], first), *[(t, (first + k + 1) % 2) for k, t in enumerate(times[1::2])]]


def test_motifs_equal_brute_force(spark):
    """Longest motif first from the left, as a loop."""
    rng = random.Random(12)
    rows, want = [], {}
    for session in range(40):
        motifs = [list(m) for m in {tuple(rng.choices(range(1, 4), k=rng.randint(1, 3))) for _ in range(3)}]
        cues = [c for m in rng.choices(motifs, k=rng.randint(0, 5)) for c in m] + ([9] if session % 5 == 0 else [])
        order, trials, at = sorted(range(len(motifs)), key=lambda k: (-len(motifs[k]), k)), [], 0
        while at < len(cues):
            fit = next((k for k in order if cues[at : at + len(motifs[k])] == motifs[k]), None)
            if fit is None:
                break
            trials.append(fit)
            at += len(motifs[fit])
        rows.append((session, 0, cues, motifs))
        want[session] = (trials, at if at < len(cues) else None)
    got = runtime_log.decompose(spark.createDataFrame(rows, "session int, seq int, cues array<int>, motifs array<array<int>>"))
    assert {r["session"]: (r["trials"], r["stop"]) for r in got.collect()} == want


def test_run_spans_against_enumeration():
    def enumerate_plans(runs, sizes):
        best = None
        for order in itertools.permutations(range(len(sizes))):
            for cuts in itertools.combinations_with_replacement(range(len(runs) + 1), 2 * len(sizes)):
                spans = [(cuts[2 * k], cuts[2 * k + 1] - 1) for k in range(len(sizes))]
                if any(b < a for a, b in spans) or any(y <= x for (_, x), (y, _) in zip(spans, spans[1:])):
                    continue
                if any(sum(runs[a:b]) > sizes[k] for (a, b), k in zip(spans, order)):
                    continue
                plan = (sum(abs(sum(runs[a : b + 1]) - sizes[k]) for (a, b), k in zip(spans, order)), order, tuple(spans))
                best = plan if best is None or plan < best else best
        return sorted(best[2]) if best else None

    rng = random.Random(5)
    for _ in range(60):
        runs, sizes = [rng.randint(1, 9) for _ in range(rng.randint(1, 5))], [rng.randint(1, 12) for _ in range(rng.randint(1, 2))]
        if len(sizes) <= len(runs):
            assert imaging.best_spans(runs, sizes) == enumerate_plans(runs, sizes)
    assert imaging.best_spans([3], [1, 2]) is None


def test_ring_fit_against_least_squares(spark):
    rng = np.random.default_rng(2)
    frames, want = [], {}
    angles = 2 * np.pi * np.arange(8) / 8
    for frame in range(40):
        xy, likelihood = rng.normal(size=(8, 2)) * 10, rng.choice([0.9, 0.3], size=8, p=[0.7, 0.3])
        frames.append((1, frame, [(float(x), float(y), float(p)) for (x, y), p in zip(xy, likelihood)]))
        kept = np.flatnonzero(likelihood >= 0.8)
        if len(kept) >= 3:
            design = np.stack([np.ones(len(kept)), np.cos(angles[kept]), np.sin(angles[kept])], axis=1)
            if np.linalg.cond(design) <= 12:
                fit = np.linalg.lstsq(design, xy[kept], rcond=None)[0]
                rest = np.sqrt(((design @ fit - xy[kept]) ** 2).sum(axis=1).mean()) if len(kept) > 3 else np.nan
                want[frame] = (*fit[0], np.hypot(*fit[1]) + np.hypot(*fit[2]), rest)
    df = spark.createDataFrame(frames, "session int, frame int, ring array<struct<x: double, y: double, likelihood: double>>")
    rows = {r["frame"]: r for r in pose.fit_ring(df, "ring", 8, "p").collect()}
    assert {f for f, r in rows.items() if r["p_valid"]} == set(want)
    for f, w in want.items():
        assert np.allclose([rows[f]["p_cx"], rows[f]["p_cy"], rows[f]["p_semi_a"] + rows[f]["p_semi_b"], rows[f]["p_residual"]], w, equal_nan=True)


def test_motion_energy_is_the_same_for_any_chunk(spark):
    rng = np.random.default_rng(4)
    planes = rng.integers(0, 256, size=(30, 7, 8), dtype=np.uint8)
    df = spark.createDataFrame([(1, 0, i, 7, 8, p.tobytes()) for i, p in enumerate(planes)],
        "session int, camera int, frame bigint, height int, width int, pixels binary")
    means = np.stack([video.block_means(p) for p in planes])
    want = [np.nan, *np.abs(np.diff(means, axis=0)).mean(axis=(1, 2))]
    for size in (3, 7, 100):
        got = video.motion_energy(df, size)
        assert np.allclose(column(got, "motion_energy"), want,
            equal_nan=True) and np.allclose(column(got, "frame_luminance"), means.mean(axis=(1, 2)))


def test_graph_with_a_diamond_and_a_cycle(spark):
    jobs = spark.createDataFrame([(k, 2) for k in "abcdxy"], "job_id string, cores bigint")
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("x", "y"), ("y", "x")], "job_id string, needs string")
    assert {r[0]: r[1] for r in graph.downstream_weight(jobs, edges).collect()} == {"a": 6, "b": 2, "c": 2, "d": 0, "x": 2, "y": 2}
    depth = {r[0]: r[1] for r in graph.submission_order(jobs, edges.filter("job_id not in ('x', 'y')")).collect()}
    assert depth == {"a": 0, "b": 1, "c": 1, "d": 2, "x": 0, "y": 0}


def test_scheduler_sizes_and_durations(spark):
    rng = random.Random(31)
    rows = []
    for power, unit in enumerate("KMGT", start=1):
        for number in (rng.randint(1, 999), round(rng.uniform(0.1, 99), 2)):
            days, hours, minutes, seconds = rng.choice([0, 0, 3, 12]), rng.randrange(24), rng.randrange(60), rng.randrange(60)
            text = f"{days}-{hours:02}:{minutes:02}:{seconds:02}" if days else f"{hours:02}:{minutes:02}:{seconds:02}"
            rows.append((f"{number}{unit}", text, number * 1024.0**power, days * 86400.0 + hours * 3600 + minutes * 60 + seconds))
    rows += [("none", "a:b", None, None), ("", "07:09", None, 429.0)]
    got = spark.createDataFrame(rows, "size string, time string, b double, s double").select("b", "s",
        scheduler.size_bytes(F.col("size")).alias("gb"), scheduler.duration_seconds(F.col("time")).alias("gs"))
    for r in got.collect():
        assert (r["gb"] is None) == (r["b"] is None) and (r["b"] is None or abs(r["gb"] - r["b"]) <= 1) and r["gs"] == r["s"]


def test_accounting_steps_fold_into_their_job(spark):
    steps = spark.createDataFrame([(1, "77", "", "COMPLETED"), (2, "77.0", "3.00G", ""), (3, "77.1", "900.00M", "X"),
            (4, "77.extern", "40.00G", ""), (5, "78", "", "FAILED"), (6, "78.batch", "1.00K", "")],
        "line int, job_id string, rss string, state string")
    assert sorted(tuple(r) for r in scheduler.merged_accounting(steps, ["rss"], []).collect()) == [("77", "3.00G",
            "COMPLETED"), ("78", "1.00K", "FAILED")]
    names = spark.createDataFrame([("slurm:9:1",), ("box:4",), ("",), (None,)], "executor string")
    assert [r[0] for r in names.select(scheduler.allocation_of(F.col("executor"))).collect()] == ["9:1", "", "", ""]


def test_natural_order_and_places(spark):
    rng = random.Random(6)
    names = [f"run{a}_part{b}" for a in (1, 2, 9, 10, 100) for b in (3, 20)]
    mixed = spark.createDataFrame([(n,) for n in rng.sample(names, len(names))] + [(None,)], "name string").repartition(4)
    assert [r[0] for r in natural_sort(mixed, "name").collect()] == [*names, None]
    assert {r["name"]: r["place"] for r in natural_places(mixed, "name").collect()} == {n: k for k, n in enumerate([*names, None], start=1)}
    assert natural_places(mixed.limit(0), "name").count() == 0


def test_archive_round_trip(spark):
    content = ingest.pack_archive([(0, 1000, b""), (3, 5, b"ab"), (4, 7, b"")])
    files = spark.createDataFrame([("p", bytearray(content)), ("empty", bytearray(b""))], "path string, content binary")
    assert [(r["source"], r["time_us"], bytes(r["payload"])) for r in ingest.messages(files).orderBy("seq")
        .collect()] == [(3, 1005, b"ab"), (4, 1007, b"")]


def test_session_folders(spark, tmp_path):
    rows = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2)], "animal string, session string, x int")
    folder = str(tmp_path / "d")
    ingest.write_sessions(rows, folder)
    ingest.write_sessions(rows.filter("session = 's2'").withColumn("x", F.lit(7)), folder)
    assert sorted(r["x"] for r in ingest.read_sessions(spark, folder).collect()) == [1, 7]


def test_expectations_and_registry(spark):
    bad = expect.violations(spark.range(3), "small", F.col("id") > 1, F.col("id"), "too large")
    with pytest.raises(expect.ExpectationError):
        expect.require(bad)
    expect.require(bad.filter("false"))
    whole = registry.System("demo", {"lick": lambda df: df}, {"lick": (51,)}, lambda df: df, lambda *x: x[0], {"run": ("video",)}, {"a": "b"})
    registry.donate(whole)
    events = spark.createDataFrame([(51,), (52,)], "event int")
    assert registry.parsed(events, "demo", "lick").count() == 1
    with pytest.raises(ValueError):
        registry.donate(whole)
    assert registry.coverage_gaps(registry.System("x", {"a": lambda df: df}))


def test_rewards_of_empty_table(spark):
    empty = spark.createDataFrame([], "session int, frame bigint, time_us bigint, volume double, tone_state int")
    assert assemble.reward_classes(empty).count() == 0


def test_session_digests_in_two_levels(spark):
    rows = [(f"s{i % 3}" if i % 4 else None, f"p{i * 7919 % 1000}", "skip" if i % 10 == 0 else "data",
            str(i % 50).encode()) for i in range(900)] + [("only", "p", "skip", b"x")]
    files = spark.createDataFrame(rows, "session string, path string, name string, content binary").repartition(7)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    groups = {}
    for session, path, name, content in sorted(rows, key=lambda r: r[1]):
        if name != "skip":
            groups.setdefault(session, {}).setdefault(sha(path)[:3], []).append(f"{path} {hashlib.sha256(content).hexdigest()}")
    want = {session: sha("\n".join(f"{g} {sha(chr(10).join(lines))}" for g, lines in sorted(found.items()))) for session, found in groups.items()}
    got = ingest.session_digests(files, ["skip"])
    assert {r["session"]: r["digest"] for r in got.collect()} == want
    assert got.columns == ["session", "digest"] and ingest.session_digests(files.limit(0), []).count() == 0


def test_every_assembled_column_is_described(spark):
    """The names of all streams together; a table of all columns lists a meaning for each."""
    columns = [*assemble.FRAME, *assemble.BEHAVIOR, "trial", "trial_type", "cue", "in_trigger_zone", "runtime_state",
        "reinforcing_guided", "aversive_guided"]
    columns += [f"{c}_camera_{n}" for c in ("face", "body") for n in ("motion_energy",
            "frame_luminance")] + [f"{d}_day_{t}" for d in ("single", "multi")
        for t in ("cell_fluorescence", "neuropil_fluorescence", "subtracted_fluorescence", "spikes")]
    points = "array<struct<x: double, y: double, likelihood: double>>"
    columns += pose.pupil_metrics(spark.createDataFrame([],
            f"session int, frame int, reflection struct<x: double, y: double, likelihood: double>, pupil {points}, eye "
            f"{points}")).columns
    wide = spark.range(0).select(*[F.lit(None).alias(c) for c in dict.fromkeys(columns)])
    assert not expect.undescribed(wide, set(assemble.DESCRIPTIONS))
    table = {r["column"]: r["description"] for r in assemble.description_table(assemble.described(wide)).collect()}
    assert list(table) == list(dict.fromkeys(columns)) and all(table.values())
    assert assemble.described(wide).schema["lick"].metadata == {"description": table["lick"]}


def test_labels_are_strict_on_demand(spark):
    df = spark.createDataFrame([(0,), (None,), (7,)], "code int")
    assert [r["l"] for r in assemble.labelled(df, "code", {0: "idle"}, "l").collect()] == ["idle", None, None]
    with pytest.raises(Exception, match="no label of code 7"):
        assemble.labelled(df, "code", {0: "idle"}, "l", strict=True).collect()


def test_optional_streams_and_columns(spark):
    clock, one = ticks(spark, [10, 20, 30]), lambda name, value: series(spark, [5, 25], value, name, "int" if isinstance(value[0], int) else "double")
    valve = one("volume", [0.0, 2.0]).withColumn("tone_state", F.lit(1))
    tables = [clock, one("state", [1, 2]), one("lick_state", [0, 1]), valve]
    plain = assemble.behavior(*tables, labels={1: "rest", 2: "run"})
    assert plain.columns == ["session", "frame", "time_us", "elapsed_minutes", "lick", "water_uL", "reward", "system_state"]
    assert column(plain, "reward") == ["yes"] * 3 and column(plain, "lick") == [0, 0, 1] and column(plain, "system_state") == ["rest", "rest", "run"]
    whole = assemble.behavior(*tables, labels={1: "rest", 2: "run"}, encoder=one("traveled_distance_cm", [0.0, 4.0]),
        torque=one("torque", [3.0, -5.0]), brake=one("brake_torque", [0.0, 9.0]), screen=one("screen_state", [0, 1]),
        minimum_torque=1.0, drop_time=True)
    assert whole.columns == ["session", "frame", "brake", "screens", "torque_N_cm", "distance_cm", "speed_cm_s", "lick",
        "water_uL", "reward", "system_state"]
    assert column(whole, "torque_N_cm") == [3, 3, 0] and column(whole, "brake") == [0, 0, 1] and column(whole, "distance_cm") == [0, 0, 4]
    wide = assemble.behavior(*tables, labels={1: "rest", 2: "run"}, torque=one("torque", [3.0, -5.0]), width=7)
    assert column(wide, "torque_N_cm") == [3, 3, 0] and column(wide, "water_uL") == [0, 0, 2]
    assert assemble.video_table(clock, {"face_camera": None}).columns == ["session", "frame"]
    frames = spark.createDataFrame([(1, t, t, c) for c, times in (("a", [0, 10, 20]), ("b", [0, 20])) for t in times],
        "session int, time_us bigint, seq bigint, camera string")
    assert column(assemble.camera_clock(frames), "time_us") == [0, 20]


def test_archives_are_bounded(spark, monkeypatch):
    sizes, decode = [], ingest.messages
    monkeypatch.setattr(assembly_queries, "ARCHIVE", 7, raising=False)
    monkeypatch.setattr(ingest, "messages", lambda files: sizes.append(files.agg(F.max(F.length("content"))).first()[0]) or decode(files))
    got = QUERIES["s5_log_archives"](spark, SF).toPandas()
    assert not difference(got, oracle(ORACLE_SQL["s5_log_archives"], SF))
    assert sizes == [8 * 13]


def test_prerequisites_narrowed_to_tracked_jobs(spark):
    jobs = [("u", 1, [3, 2, 2, 9]), ("u", 2, []), ("u", 2, []), ("u", 3, None), ("v", 2, [1, None]), (None, 4, [4])]
    df = spark.createDataFrame([(*j, "x") for j in jobs], "unit string, job_id int, prerequisites array<int>, note string")
    got = graph.narrowed(df)
    assert got.columns == df.columns
    tracked = {u: {j for w, j, _ in jobs if w == u} for u, *_ in jobs if u is not None}
    want = [(u, j, None if p is None else sorted({x for x in p if x in tracked.get(u, ())}), "x") for u, j, p in jobs]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert graph.narrowed(df.limit(0)).count() == 0


def test_outcome_lists_the_first_of_large_batches(spark):
    states = ["SUCCEEDED", "FAILED", "SCHEDULED"]
    rows = [(None if k % 7 == 0 else "b", k, states[k % 3]) for k in range(300)] + [("done", 1000, "SUCCEEDED")]
    links = [(k, k - 1) for k in range(1, 300, 2)]
    batch = spark.createDataFrame(rows, "batch_id string, job_id int, status string")
    got = {r["batch_id"]: r for r in graph.outcome(batch, spark.createDataFrame(links, "job_id int, needs int")).collect()}
    status = {(b, k): s for b, k, s in rows}
    for name in ("b", None, "done"):
        own = [(k, s) for b, k, s in rows if b == name]
        behind = {j for j, n in links if name is not None and status.get((name, n)) == "FAILED"}
        failed = [k for k, s in own if s == "FAILED"]
        blocked = [k for k, s in own if s == "SCHEDULED" and k in behind]
        r = got[name]
        assert (r["failed"], r["blocked"]) == (len(failed), len(blocked))
        assert r["listed"] == sorted(failed + blocked)[: graph.MOST_LISTED]
        assert r["complete"] == (r["outstanding"] == 0) and sum(r[c] for c in ("succeeded", "failed", "blocked", "outstanding")) == len(own)
