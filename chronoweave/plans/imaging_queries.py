"""Queries of the imaging, pose and video operators."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from chronoweave.functions.scans import medians
from chronoweave.operators import imaging, pose, streams, video
from chronoweave.operators.assemble import PUPIL_FLAGS
from chronoweave.plans.stream_queries import TRAIN
from chronoweave.plans.tables import EV, read, stream, with_

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


EDGES = """eg AS (SELECT *, coalesce(state - lag(state) OVER (PARTITION BY session ORDER BY seq), 0) AS edge FROM tr),
 ei AS (SELECT *, CAST(count(*) FILTER (WHERE edge = 1) OVER (PARTITION BY session
    ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pulse_id FROM eg),
 pp AS (SELECT r.session, r.pulse_id, r.time_us AS pulse_start, f.time_us AS pulse_end, (f.time_us - r.time_us) / 1000 AS duration_ms
    FROM ei r JOIN ei f ON r.session = f.session AND r.pulse_id = f.pulse_id AND r.edge = 1 AND f.edge = -1)"""
LIMIT_MS, FIVE_DAYS = 36_000_000.0, 5 * 86_400_000_000
BAND = f"bd AS (SELECT session, pulse_id AS frame, pulse_start AS time_us FROM pp WHERE duration_ms BETWEEN 0 AND {2 * LIMIT_MS})"
RUNS = """pr AS (SELECT *, time_us - lag(time_us) OVER (PARTITION BY session ORDER BY frame) AS period FROM bd),
 md AS (SELECT session, median(period) AS med, count(*) AS n FROM pr GROUP BY session),
 rn AS (SELECT pr.session, frame, time_us, CAST(coalesce(sum(CASE WHEN n >= 3 AND period > med * 3 THEN 1 ELSE 0 END)
    OVER (PARTITION BY pr.session ORDER BY frame ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS run FROM pr JOIN md USING (session))"""
SHORT = "sh AS (SELECT session, pulse_id AS frame, pulse_start AS time_us FROM pp WHERE duration_ms BETWEEN 0 AND 7200000.0)"


def _train(s, d):
    return streams.states(stream(s, d), 51, 52)


def _band(s, d):
    return imaging.in_band(imaging.paired_pulses(_train(s, d)), LIMIT_MS, LIMIT_MS)


def _frames(s, d):
    """Readings as frames of an older recording: every acquisition counts from one."""
    rows = stream(s, d).filter("event = 60").withColumn("place", F.row_number().over(imaging.in_order()))
    return rows.select("session", F.lit(0).alias("acquisition"), (F.col("place") % 7).alias("number"), "time_us", "place")


@query("f1_edges_and_pulse_ids", with_(EV, TRAIN, EDGES) + "SELECT session, time_us, seq, edge, pulse_id FROM ei")
def _(s, d):
    return imaging.edges(_train(s, d)).select("session", "time_us", "seq", "edge", "pulse_id")


@query("f1_edges_bucketed", with_(EV, TRAIN, EDGES) + "SELECT session, time_us, seq, edge, pulse_id FROM ei")
def _(s, d):
    return imaging.edges(_train(s, d), FIVE_DAYS).select("session", "time_us", "seq", "edge", "pulse_id")


@query("f2_paired_pulses", with_(EV, TRAIN, EDGES) + "SELECT session, pulse_id, pulse_start, pulse_end, duration_ms FROM pp")
def _(s, d):
    return imaging.paired_pulses(_train(s, d))


@query("f3_duration_band", with_(EV, TRAIN, EDGES, BAND) + "SELECT session, frame, time_us FROM bd")
def _(s, d):
    return _band(s, d)


@query("f4_pulse_runs", with_(EV, TRAIN, EDGES, BAND, RUNS) + "SELECT session, frame, run FROM rn")
def _(s, d):
    return imaging.pulse_runs(_band(s, d)).select("session", "frame", "run")


@query("f4_pulse_runs_bucketed", with_(EV, TRAIN, EDGES, BAND, RUNS) + "SELECT session, frame, run FROM rn")
def _(s, d):
    """Cut by time, the median of the periods from counts of ranges."""
    return imaging.pulse_runs(_band(s, d), FIVE_DAYS).select("session", "frame", "run")


@query("median_in_ranges", "SELECT l_returnflag AS flag, median(l_extendedprice) AS median FROM lineitem GROUP BY 1")
def _(s, d):
    """The exact median of a few large groups, of which none is gathered."""
    return medians(read(s, d, "lineitem").withColumn("flag", F.col("l_returnflag")), F.col("l_extendedprice"), "median", ["flag"], 64, 1000)


@query(
    "f5_acquisition_sizes",
    with_("fr AS (SELECT l_suppkey AS session, CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber "
        "ELSE 0 END AS acq, l_partkey % 50 AS num FROM lineitem)",
        "own AS (SELECT session, acq, count(*) AS size FROM fr GROUP BY ALL)",
        "mn AS (SELECT session, count(*) > 1 AS ix FROM own GROUP BY session)",
          "rp AS (SELECT session, num, count(*) AS n FROM fr WHERE session IN (SELECT session FROM mn WHERE NOT ix) "
          "GROUP BY ALL)", "pe AS (SELECT session, unnest(generate_series(1, n)) AS k FROM rp)")
    + "SELECT session, size FROM own WHERE session IN (SELECT session FROM mn WHERE ix) UNION ALL SELECT session, count(*) "
    "FROM pe GROUP BY session, k",
)
def _(s, d):
    frames = read(s, d, "lineitem").select(F.col("l_suppkey").alias("session"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_linenumber")).otherwise(0).alias("acquisition"),
        (F.col("l_partkey") % 50).alias("number"))
    return imaging.acquisition_sizes(frames)


@query("f6_f7_stray_runs")
def _(s, d):
    """Solved per session by dynamic programming; tested against enumeration."""
    return imaging.drop_stray_runs(_band(s, d), _frames(s, d))


@query("f8_tail_clip", with_(EV, TRAIN, EDGES, BAND)
    + "SELECT session, frame, time_us FROM (SELECT *, row_number() OVER (PARTITION BY session ORDER BY frame DESC) AS rn "
    "FROM bd) WHERE rn <= 5")
def _(s, d):
    band = _band(s, d)
    return imaging.last_frames(band, band.select("session").distinct().withColumn("frame_count", F.lit(5)))


OFFSETS = """fm AS (SELECT session, time_us, row_number() OVER (PARTITION BY session ORDER BY time_us, seq) AS place FROM ev WHERE event = 60),
 an AS (SELECT * FROM (SELECT session, pulse_start, row_number() OVER (PARTITION BY session ORDER BY pulse_start) AS anchor
    FROM pp) WHERE anchor <= 10),
 os AS (SELECT an.session, anchor, pulse_start - fm.time_us AS offset_us FROM an JOIN fm ON fm.session = an.session AND place = 1),
 ds AS (SELECT os.session, anchor, offset_us, pp.pulse_id, min(abs(pulse_start - fm.time_us - offset_us)) AS dist FROM os
    JOIN pp ON pp.session = os.session JOIN fm ON fm.session = os.session GROUP BY ALL),
 mt AS (SELECT session, anchor, offset_us, count(*) FILTER (WHERE dist < 3600000000) AS matches FROM ds GROUP BY ALL),
 bo AS (SELECT session, offset_us, matches FROM (SELECT *, row_number() OVER (PARTITION BY session
    ORDER BY matches DESC, anchor) AS rn FROM mt) WHERE rn = 1)"""


@query("f9_clock_offset", with_(EV, TRAIN, EDGES, OFFSETS) + "SELECT session, offset_us, matches FROM bo")
def _(s, d):
    return imaging.clock_offset(imaging.paired_pulses(_train(s, d)), _frames(s, d), 3_600_000_000)


@query(
    "f10_nearest_frames",
    with_(EV, TRAIN, EDGES, OFFSETS,
        "nf AS (SELECT pp.session, pulse_id, pulse_start, place, abs(pulse_start - fm.time_us - offset_us) AS dist, "
        "row_number() OVER (PARTITION BY pp.session, pulse_id "
        "ORDER BY abs(pulse_start - fm.time_us - offset_us), fm.time_us DESC) AS rk FROM pp JOIN bo USING (session) "
        "JOIN fm USING (session))",
          "kp AS (SELECT *, row_number() OVER (PARTITION BY session, place ORDER BY dist, pulse_start) AS rn FROM nf "
          "WHERE rk = 1 AND dist < 3600000000)")
    + "SELECT session, pulse_id AS frame, pulse_start AS time_us, place FROM kp WHERE rn = 1",
)
def _(s, d):
    return imaging.align(imaging.paired_pulses(_train(s, d)), _frames(s, d), 3_600_000_000)


#: Ends with ``af``, the imaging frames of each session.
ALIGNED_FRAMES = [
        "fn AS (SELECT session, count(*) AS n FROM fm GROUP BY session)",
        "hv AS (SELECT fn.session, n, (SELECT count(*) FROM bd WHERE bd.session = fn.session) AS have FROM fn)",
          "nf AS (SELECT pp.session, pulse_id, pulse_start, place, abs(pulse_start - fm.time_us - offset_us) AS dist, "
          "row_number() OVER (PARTITION BY pp.session, pulse_id "
          "ORDER BY abs(pulse_start - fm.time_us - offset_us), fm.time_us DESC) AS rk FROM pp JOIN bo USING (session) "
          "JOIN fm USING (session))",
          "kp AS (SELECT *, row_number() OVER (PARTITION BY session, place ORDER BY dist, pulse_start) AS rn FROM nf "
          "WHERE rk = 1 AND dist < 3600000000)",
          "af AS (SELECT session, frame, time_us FROM (SELECT *, row_number() OVER (PARTITION BY session "
          "ORDER BY frame DESC) AS back FROM bd) JOIN hv USING (session) WHERE have >= n AND back <= n UNION ALL "
          "SELECT session, pulse_id, pulse_start FROM kp JOIN hv USING (session) WHERE rn = 1 AND have < n)"]  # fmt: skip


@query(
    "f11_f12_aligned_frames",
    with_(EV, TRAIN, EDGES, BAND, OFFSETS, *ALIGNED_FRAMES)
    + "SELECT session, row_number() OVER (PARTITION BY session ORDER BY frame) AS frame, time_us FROM af",
)
def _(s, d):
    pulses, frames = imaging.paired_pulses(_train(s, d)), _frames(s, d)
    counts = frames.groupBy("session").agg(F.count(F.lit(1)).alias("frame_count"))
    return imaging.aligned_frames(_band(s, d), pulses, frames, counts, 3_600_000_000)


TRACES = "tc AS (SELECT label AS session, vec_id AS frame, generate_subscripts(embedding, 1) - 1 AS roi, unnest(embedding) AS value FROM embeddings)"


def _traces(s, d):
    return read(s, d, "embeddings").select(F.col("label").alias("session"), F.col("vec_id").alias("frame"),
        F.posexplode("embedding").alias("roi", "value"))


@query("f13_f14_cell_traces", with_(TRACES)
    + "SELECT session, frame, list(value ORDER BY roi) AS cells FROM tc WHERE (roi + session) % 3 = 0 GROUP BY ALL")
def _(s, d):
    traces = _traces(s, d)
    rois = s.range(64).select(F.col("id").cast("int").alias("roi")).join(traces.select("session")
        .distinct()).withColumn("is_cell", ((F.col("roi") + F.col("session")) % 3 == 0).cast("int"))
    frames = traces.select("session", "frame").distinct()
    return imaging.attach_traces(frames, {"cells": imaging.cells_only(traces, rois)})


@query("s9_frame_arrays", with_(TRACES) + 'SELECT session, frame, list(value ORDER BY roi) AS "values" FROM tc GROUP BY ALL')
def _(s, d):
    return imaging.frame_arrays(_traces(s, d))


def _frame_points(s, d):
    """The first 39 numbers of a vector as 13 points; a third of the points is not trusted."""
    at = lambda k: F.struct((F.get("embedding", 3 * k).cast("double") * 100).alias("x"),
        (F.get("embedding", 3 * k + 1).cast("double") * 100).alias("y"),
        F.when(F.get("embedding", 3 * k + 2) > -0.05, 0.9).otherwise(0.1).alias("likelihood"))
    return read(s, d, "embeddings").select(F.col("label").alias("session"), F.col("vec_id").alias("frame"),
        at(0).alias("reflection"), F.array(*[at(k) for k in range(1, 9)]).alias("pupil"),
        F.array(*[at(k) for k in range(9, 13)]).alias("eye"))


@query(
    "p1_p2_trust_pattern",
    "SELECT label AS session, vec_id AS frame, CAST(" + " + ".join(
        f"CASE WHEN embedding[{3 * k + 3}] > -0.05::FLOAT THEN {1 << (k - 1)} ELSE 0 END" for k in range(1, 9))
    + " AS INTEGER) AS code FROM embeddings",
)
def _(s, d):
    return _frame_points(s, d).select("session", "frame", pose.pattern(F.col("pupil"), 8).alias("code"))


_FULL = "AND ".join(f"embedding[{3 * k + 3}] > -0.05::FLOAT " for k in range(1, 9))
_C = {k: (f"{__import__('math').cos(2 * 3.141592653589793 * (k - 1) / 8):.17g}",
        f"{__import__('math').sin(2 * 3.141592653589793 * (k - 1) / 8):.17g}") for k in range(1, 9)}


def _sum(axis: int, weight) -> str:
    return "(" + " + ".join(f"{weight(k)} * CAST(embedding[{3 * k + 1 + axis}] AS DOUBLE) * 100" for k in range(1, 9)) + ")"


@query(
    "p3_p5_full_ring_fit",
    f"""WITH f AS (SELECT label AS session, vec_id AS frame, {_sum(0, lambda k: '0.125')} AS cx, {_sum(1, lambda k: '0.125')} AS cy,
 {_sum(0, lambda k: '0.25 * ' + _C[k][0])} AS ax, {_sum(1, lambda k: '0.25 * ' + _C[k][0])} AS ay, {_sum(0, lambda k: '0.25 * ' + _C[k][1])} AS bx, {_sum(1, lambda k: '0.25 * ' + _C[k][1])} AS by_
    FROM embeddings WHERE {_FULL})
 SELECT session, frame, round(cx, 6) + 0.0 AS cx, round(cy, 6) + 0.0 AS cy, round(pi() * abs(ax * by_ - ay * bx), 4) AS area, round(sqrt(ax * ax + ay * ay) + sqrt(bx * bx + by_ * by_), 6) AS diameter FROM f""",
)
def _(s, d):
    fit = pose.fit_ring(_frame_points(s, d), "pupil", 8, "p").filter("p_code = 255")
    return fit.select("session", "frame", (F.round("p_cx", 6) + 0.0).alias("cx"), (F.round("p_cy", 6) + 0.0).alias("cy"),
        F.round("p_area", 4).alias("area"), F.round(F.col("p_semi_a") + F.col("p_semi_b"), 6).alias("diameter"))


def ring_sql(name: str, points: range) -> tuple[str, str, str]:
    """Least squares of a ring by its normal equations: columns of sums over trusted points, the solution, and the squared distance."""
    n = len(points)
    cos, sin = ([f"({f(2 * math.pi * k / n):.17g})" for k in range(n)] for f in (math.cos, math.sin))
    trusted = [f"CAST(embedding[{3 * p + 3}] > -0.05::FLOAT AS INTEGER)" for p in points]
    at = {axis: [f"CAST(embedding[{3 * p + 1 + i}] AS DOUBLE) * 100" for p in points] for i, axis in enumerate("xy")}
    total = lambda weight: " + ".join(f"{t} * {weight(k)}" for k, t in enumerate(trusted))
    sums = {"n": lambda k: "1", "c": lambda k: cos[k], "s": lambda k: sin[k], "cc": lambda k: f"{cos[k]} * {cos[k]}",
        "ss": lambda k: f"{sin[k]} * {sin[k]}", "cs": lambda k: f"{cos[k]} * {sin[k]}", "code": lambda k: str(1 << k)}
    for axis in "xy":
        sums |= {axis: lambda k, v=at[axis]: v[k], f"{axis}c": lambda k, v=at[axis]: f"{v[k]} * {cos[k]}",
            f"{axis}s": lambda k, v=at[axis]: f"{v[k]} * {sin[k]}"}
    columns = ", ".join(f"{total(w)} AS {name}{key}" for key, w in sums.items())
    c = {key: f"{name}{key}" for key in sums}
    minors = {"11": "{cc} * {ss} - {cs} * {cs}", "12": "{cs} * {s} - {c} * {ss}", "13": "{c} * {cs} - {cc} * {s}",
        "22": "{n} * {ss} - {s} * {s}", "23": "{c} * {s} - {n} * {cs}", "33": "{n} * {cc} - {c} * {c}"}
    m = {key: f"({text.format(**c)})" for key, text in minors.items()}
    det = f"({c['n']} * {m['11']} + {c['c']} * {m['12']} + {c['s']} * {m['13']})"
    solved = [f"({m[w[0]]} * {c[axis]} + {m[w[1]]} * {c[axis + 'c']} + {m[w[2]]} * {c[axis + 's']}) / nullif({det}, 0) AS "
        f"{name}_{part}{axis}" for axis in "xy" for part, w in (("c", ("11", "12", "13")), ("a", ("12", "22", "23")),
            ("b", ("13", "23", "33")))]
    off = lambda axis, k: f"pow({name}_c{axis} + {cos[k]} * {name}_a{axis} + {sin[k]} * {name}_b{axis} - {at[axis][k]}, 2)"
    return columns, ", ".join(solved), total(lambda k: f"({off('x', k)} + {off('y', k)})")


def fitted_sql(name: str, n: int) -> str:
    """The patterns that can be fitted, with the condition of each."""
    rows = []
    for code in range(1 << n):
        angles = [2 * math.pi * k / n for k in range(n) if code >> k & 1]
        if len(angles) >= pose.LEAST_POINTS:
            condition = float(np.linalg.cond(np.array([[1.0, math.cos(t), math.sin(t)] for t in angles])))
            if condition <= pose.MOST_CONDITION:
                rows.append(f"({code}, {condition!r}::DOUBLE)")
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(rows)}) t(code, condition))"


def pupil_sql() -> str:
    (p_sums, p_fit, p_off), (e_sums, e_fit, e_off) = ring_sql("p", range(1, 9)), ring_sql("e", range(9, 13))
    semi = lambda n, part: f"sqrt({n}_{part}x * {n}_{part}x + {n}_{part}y * {n}_{part}y)"
    masked = {
        "pupil_center_x_px": ("measured", "p_cx"), "pupil_center_y_px": ("measured", "p_cy"),
        "pupil_diameter_px": ("measured", f"{semi('p', 'a')} + {semi('p', 'b')}"),
        "pupil_area_px2": ("measured", "pi() * abs(p_ax * p_by - p_ay * p_bx)"),
        "pupil_fit_condition": ("measured", "p_condition"), "pupil_fit_residual_px": ("measured AND pn > 3",
            f"sqrt(({p_off}) / pn)"), "eye_center_x_px": ("e_valid", "e_cx"), "eye_center_y_px": ("e_valid", "e_cy"),
        "eye_width_px": ("e_valid", f"2 * {semi('e', 'a')}"), "eye_height_px": ("e_valid", f"2 * {semi('e', 'b')}"),
        "eye_openness": ("true", "openness"), "reflection_x_px": ("mirror", "rx"), "reflection_y_px": ("mirror", "ry"),
        "pupil_reflection_offset_x_px": ("measured AND mirror", "p_cx - rx"), "pupil_reflection_offset_y_px": ("measured AND mirror", "p_cy - ry"),
        "pupil_in_eye_x": (f"measured AND e_valid AND {semi('e', 'a')} >= 1e-6", f"(p_cx - e_cx) / {semi('e', 'a')}"),
        "pupil_in_eye_y": (f"measured AND e_valid AND {semi('e', 'b')} >= 1e-6", f"(p_cy - e_cy) / {semi('e', 'b')}"),
    }
    numbers = ", ".join(f"round(CAST(CAST(CASE WHEN {when} THEN {value} END AS FLOAT) AS DOUBLE), 3) + 0.0 AS {name}"
        for name, (when, value) in masked.items())
    return f"""WITH {fitted_sql('pv', 8)}, {fitted_sql('ev', 4)}, s0 AS (SELECT label AS session, vec_id AS frame, embedding, embedding[3] > -0.05::FLOAT AS mirror,
    CAST(embedding[1] AS DOUBLE) * 100 AS rx, CAST(embedding[2] AS DOUBLE) * 100 AS ry, {p_sums}, {e_sums} FROM embeddings),
 s1 AS (SELECT s0.*, pv.code IS NOT NULL AS p_valid, pv.condition AS p_condition, ev.code IS NOT NULL AS e_valid, {p_fit}, {e_fit}
    FROM s0 LEFT JOIN pv ON pv.code = pcode LEFT JOIN ev ON ev.code = ecode),
 s2 AS (SELECT *, CASE WHEN e_valid AND 2 * {semi('e', 'a')} >= 1e-6 THEN {semi('e', 'b')} / {semi('e', 'a')} END AS openness
    FROM s1), md AS (SELECT session, median(openness) AS base FROM s2 GROUP BY session),
 s3 AS (SELECT s2.*, ((NOT (e_valid AND mirror) OR openness IS NULL) AND NOT p_valid) OR
    coalesce(openness < 0.5 * base, false) AS blinking FROM s2 JOIN md USING (session)), s4 AS (SELECT *, p_valid
    AND NOT blinking AS measured FROM s3)
 SELECT session, frame, CAST(blinking AS INTEGER) AS blinking_state, CAST(NOT blinking
    AND NOT measured AS INTEGER) AS dilation_state, {numbers} FROM s4"""


@query("p12_pupil_metrics", pupil_sql())
def _(s, d):
    """All metrics, to three places; NaN is given as null."""
    found = pose.pupil_metrics(_frame_points(s, d))
    numbers = [c for c in found.columns if c not in ("session", "frame", *PUPIL_FLAGS)]
    return found.select("session", "frame", *PUPIL_FLAGS, *[F.when(~F.isnan(c), F.round(F.col(c).cast("double"), 3) + 0.0).alias(c) for c in numbers])


@query(
    "s8_points_by_frame",
    "SELECT label AS session, vec_id AS frame, CAST(embedding[1] AS DOUBLE) AS reflection_x, CAST(embedding[4] AS "
    "DOUBLE) AS first_x, CAST(embedding[28] AS DOUBLE) AS eye_x FROM embeddings",
)
def _(s, d):
    long = read(s, d, "embeddings").select(F.col("label").alias("session"), F.col("vec_id").alias("frame"),
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(12)),
                lambda k: F.struct(F.concat(F.lit("part"), k).alias("bodypart"),
                    F.get("embedding", 3 * k).cast("double").alias("x"),
                    F.get("embedding", 3 * k + 1).cast("double").alias("y"), F.lit(1.0).alias("likelihood"))))
        .alias("p")).select("session", "frame", "p.*")
    points = pose.frame_points(long, "part0", [f"part{k}" for k in range(1, 9)], [f"part{k}" for k in range(9, 13)])
    return points.select("session", "frame", F.col("reflection.x").alias("reflection_x"),
        F.get("pupil", 0)["x"].alias("first_x"), F.get("eye", 0)["x"].alias("eye_x"))


FRAMES = """fr AS (SELECT 0 AS session, label AS camera, row_number() OVER (PARTITION BY label
    ORDER BY vec_id) - 1 AS frame, list_transform(embedding[1:63], lambda v:
    CAST(floor(abs(v) * 255::FLOAT) AS INTEGER) % 256) AS px FROM embeddings),
 bn AS (SELECT session, camera, frame, [(px[3*i+1] + px[3*i+2] + px[3*i+3] + px[21+3*i+1] + px[21+3*i+2] + px[21+3*i+3] + px[42+3*i+1] + px[42+3*i+2] + px[42+3*i+3]) / 9 FOR i IN generate_series(0, 6)] AS b
    FROM fr),
 me AS (SELECT *, lag(b) OVER (PARTITION BY session, camera ORDER BY frame) AS was FROM bn)"""


def _planes(s, d):
    rows = read(s, d, "embeddings").withColumn("frame", F.row_number().over(imaging.in_order(["label"], ["vec_id"])).cast("bigint") - 1)
    byte = F.transform(F.slice("embedding", 1, 63), lambda v: F.lpad(F.hex(F.floor(F.abs(v) * F.lit(255.0).cast("float")).cast("int") % 256), 2, "0"))
    return rows.select(F.lit(0).alias("session"), F.col("label").alias("camera"), "frame", F.lit(3).alias("height"),
        F.lit(21).alias("width"), F.unhex(F.array_join(byte, "")).alias("pixels"))


@query(
    "v1_v4_motion_energy",
    with_(FRAMES) + "SELECT session, camera, frame, round(CASE WHEN was IS NULL THEN -1 "
    "ELSE list_avg([abs(b[i] - was[i]) FOR i IN generate_series(1, 7)]) END, 6) AS motion_energy, round(list_avg(b), 6) "
    "AS frame_luminance FROM me",
)
def _(s, d):
    """NaN of the first frame is shown as -1."""
    out = video.motion_energy(_planes(s, d), size=16)
    return out.select("session", "camera", "frame", F.round(F.when(F.isnan("motion_energy"), -1.0)
            .otherwise(F.col("motion_energy")), 6).alias("motion_energy"),
        F.round("frame_luminance", 6).alias("frame_luminance"))


@query("v5_truncated_chunks",
    "WITH f AS (SELECT label AS camera, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame "
    "FROM embeddings), l AS (SELECT camera, max(frame) AS last FROM f "
    "GROUP BY camera), c AS (SELECT camera, CAST(floor(frame / 16) AS BIGINT) AS chunk, count(*) FILTER (WHERE frame % 5 "
    "<> 3 OR camera <> 2) AS rows FROM f GROUP BY ALL) SELECT 0 AS session, camera, chunk, rows FROM c "
    "JOIN l USING (camera) WHERE rows < 16 AND chunk < floor(last / 16)")
def _(s, d):
    planes = _planes(s, d)
    measured = planes.filter("frame % 5 <> 3 or camera <> 2").select("session", "camera", "frame")
    return video.truncated_chunks(planes, measured, 16)


@query("v6_recording_lookup",
    "SELECT l_orderkey AS session, l_linenumber AS camera, l_orderkey || '_' || l_linenumber || '.mp4' AS file "
    "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) WHERE l_orderkey % 3 = 0")
def _(s, d):
    cameras = read(s, d, "lineitem").select(F.col("l_orderkey").alias("session"), F.col("l_linenumber").alias("camera")).distinct()
    files = cameras.filter("session % 3 = 0").select(F.concat(F.col("session"), F.lit("_"), F.col("camera"), F.lit(".mp4")).alias("file"))
    return video.recordings(files, cameras)
