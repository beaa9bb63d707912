"""Queries of the resampling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoweave.operators import asof
from chronoweave.plans.tables import CLOCK, EV, LINE, RD, WS, clock, exact_total, exact_total_sql, near, readings, stream, with_

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


HOLD_SQL = with_(EV, RD, CLOCK, near("nr", "rd", "ck", "value")) + "SELECT session, frame, time_us, coalesce(y0, y1) AS value FROM nr"


@query("a1_hold_prior", HOLD_SQL)
def _(s, d):
    return asof.hold(readings(s, d), clock(s, d), ["value"])


@query("a1_hold_prior_bucketed", HOLD_SQL)
def _(s, d):
    return asof.hold(readings(s, d), clock(s, d), ["value"], width=5 * 86_400_000_000)


LINEAR_SQL = with_(EV, RD, CLOCK, near("nr", "rd", "ck", "value")) + f"SELECT session, frame, round({LINE.format(on='time_us')}, 6) AS value FROM nr"


@query("a2_linear", LINEAR_SQL)
def _(s, d):
    return asof.linear(readings(s, d), clock(s, d), ["value"]).select("session", "frame", F.round("value", 6).alias("value"))


@query("a2_linear_bucketed", LINEAR_SQL)
def _(s, d):
    return asof.linear(readings(s, d), clock(s, d), ["value"], width=5 * 86_400_000_000).select("session", "frame",
        F.round("value", 6).alias("value"))


@query("a3_window_starts", with_(EV, CLOCK, WS) + "SELECT session, frame, time_us, start_us FROM ws")
def _(s, d):
    return asof.window_starts(clock(s, d))


STATE = "st AS (SELECT session, time_us, seq, CASE event WHEN 51 THEN 1 ELSE 0 END AS state FROM ev WHERE event IN (51, 52))"


def _state(s, d):
    return stream(s, d).filter("event in (51, 52)").select("session", "time_us", "seq", (F.col("event") == 51).cast("int").alias("state"))


@query(
    "a4_window_onsets",
    with_(EV, CLOCK, WS, STATE,
        "o AS (SELECT * FROM (SELECT *, lag(state, 1, 0) OVER (PARTITION BY session ORDER BY time_us, seq) AS was "
        "FROM st) WHERE state > 0 AND was <= 0)")
    + "SELECT session, frame, time_us, CAST(EXISTS (SELECT 1 FROM o WHERE o.session = ws.session AND o.time_us > start_us "
    "AND o.time_us <= ws.time_us) AS INTEGER) AS onset FROM ws",
)
def _(s, d):
    return asof.window_onsets(_state(s, d), clock(s, d)).select("session", "frame", "time_us", "onset")


SIGNED = "sg AS (SELECT session, time_us, seq, CASE WHEN seq % 2 = 0 THEN value ELSE -value END AS value FROM ev)"


def _signed(s, d):
    return stream(s, d).withColumn("value", F.when(F.col("seq") % 2 == 0, F.col("value")).otherwise(-F.col("value"))).drop("event")


@query(
    "a5_signed_peaks",
    with_(EV, CLOCK, WS, SIGNED, "w0 AS (SELECT session, frame, start_us AS time_us FROM ws)", near("h", "sg", "w0", "value"),
          "al AS (SELECT session, frame, -1 AS t, -1 AS seq, coalesce(y0, y1) AS value FROM h UNION ALL "
          "SELECT ws.session, frame, sg.time_us, seq, value FROM ws JOIN sg ON sg.session = ws.session "
          "AND sg.time_us > start_us AND sg.time_us <= ws.time_us)")
    + "SELECT session, frame, value AS peak FROM (SELECT *, row_number() OVER (PARTITION BY session, frame "
    "ORDER BY abs(value) DESC, t, seq) AS rn FROM al) WHERE rn = 1",
)
def _(s, d):
    return asof.signed_peaks(_signed(s, d), clock(s, d)).select("session", "frame", "peak")


GAPPY = "gp AS (SELECT session, time_us, seq, CASE WHEN seq % 3 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END AS value FROM ev)"


@query(
    "a6_window_maxima",
    with_(EV, CLOCK, WS, GAPPY, near("nr", "gp", "ws", "value"),
          "mx AS (SELECT ws.session, frame, max(CASE WHEN NOT isnan(value) THEN value END) AS m, count(*) AS n FROM ws "
          "JOIN gp ON gp.session = ws.session AND gp.time_us > start_us AND gp.time_us <= ws.time_us GROUP BY ALL)")
    + f"SELECT nr.session, nr.frame, round(CASE WHEN n IS NULL THEN {LINE.format(on='time_us')} ELSE m END, 6) AS maximum "
    f"FROM nr LEFT JOIN mx USING (session, frame) WHERE coalesce(NOT isnan(CASE WHEN n IS NULL "
    f"THEN {LINE.format(on='time_us')} ELSE m END), false)",
)
def _(s, d):
    """NaN results are left out here: engines print them differently."""
    source = stream(s, d).withColumn("value", F.when(F.col("seq") % 3 == 0, float("nan")).otherwise(F.col("value")))
    out = asof.window_maxima(source.drop("event"), clock(s, d))
    return out.filter(~F.isnan("maximum")).select("session", "frame", F.round("maximum", 6).alias("maximum"))


NEAREST = (
    "SELECT session, frame, CASE WHEN x1 IS NULL OR (x0 IS NOT NULL AND time_us - x0 < x1 - time_us) THEN y0 "
    "ELSE y1 END AS value, CASE WHEN x1 IS NULL OR (x0 IS NOT NULL AND time_us - x0 < x1 - time_us) THEN time_us - x0 "
    "ELSE x1 - time_us END AS distance_us FROM nr"
)


@query("a7_nearest", with_(EV, RD, CLOCK, near("nr", "rd", "ck", "value")) + NEAREST)
def _(s, d):
    return asof.nearest(readings(s, d), clock(s, d), ["value"]).select("session", "frame", "value", "distance_us")


@query("a8_matches_in_tolerance", with_(EV, RD, CLOCK, near("nr", "rd", "ck", "value"), f"x AS ({NEAREST})")
    + "SELECT session, count(*) FILTER (WHERE distance_us < 10800000000) AS matches FROM x GROUP BY session")
def _(s, d):
    return asof.matches_in_tolerance(readings(s, d), clock(s, d), 10_800_000_000)


ENC = f"en AS (SELECT session, time_us, seq, {exact_total_sql('value')} AS distance FROM rd)"
COR = (
    "co AS (SELECT session, time_us, seq, 100.0 * (row_number() OVER (PARTITION BY session "
    "ORDER BY time_us, seq) - 1) AS start_cm FROM ev WHERE event = 54)"
)


def _encoder(s, d):
    return readings(s, d).withColumn("distance", exact_total(F.col("value"))).drop("value")


def _corridors(s, d):
    from chronoweave.functions.ordering import in_order

    return stream(s, d).filter("event = 54").select("session", "time_us", "seq", ((F.row_number().over(in_order()) - 1) * 100.0).alias("start_cm"))


@query(
    "a9_corridor_distance",
    with_(EV, RD, CLOCK, ENC, COR, near("on1", "en", "co", "distance"),
        "os AS (SELECT session, time_us, seq, start_cm, coalesce(y0, 0.0) AS onset, lead(start_cm) "
        "OVER (PARTITION BY session ORDER BY time_us, seq) - start_cm AS len FROM on1)",
          "pk AS (SELECT session, time_us, seq, {'onset': onset, 's': start_cm, 'len': len} AS p FROM os)",
          near("tr", "en", "ck", "distance"),
          f"t2 AS (SELECT session, frame, time_us, {LINE.format(on='time_us')} AS dist FROM tr)",
          near("pl", "pk", "t2", "p"),
          "f AS (SELECT session, frame, dist, coalesce(y0, y1) AS p FROM pl)")
    + "SELECT session, frame, round(p.s + CASE WHEN p.len IS NULL THEN greatest(dist - p.onset, 0.0) "
    "ELSE least(greatest(dist - p.onset, 0.0), p.len) END, 5) AS corridor_cm FROM f WHERE p IS NOT NULL",
)
def _(s, d):
    out = asof.corridor_distance(_encoder(s, d), _corridors(s, d), clock(s, d))
    return out.filter(F.col("corridor_cm").isNotNull()).select("session", "frame", F.round("corridor_cm", 5).alias("corridor_cm"))


@query(
    "a10_zone_membership",
    with_(EV, RD, "zn AS (SELECT session, value - 1 AS a, value + 1 AS b FROM ev WHERE event = 54)")
    + "SELECT session, seq, CAST(EXISTS (SELECT 1 FROM zn WHERE zn.session = rd.session AND rd.value BETWEEN a AND b) AS INTEGER) AS in_zone FROM rd",
)
def _(s, d):
    zones = stream(s, d).filter("event = 54").select("session", (F.col("value") - 1).alias("start_cm"),
        (F.col("value") + 1).alias("end_cm"))
    return asof.in_zones(readings(s, d), zones, "value").select("session", "seq", "in_zone")


@query(
    "a11_hold_by_distance",
    with_(EV, RD, ENC, f"tr AS (SELECT session, seq, seq AS trial, {exact_total_sql('value')} AS distance FROM ev WHERE event = 54)",
        near("nr", "tr", "en", "trial", "distance"))
    + "SELECT session, seq, coalesce(y0, y1) AS trial FROM nr WHERE coalesce(y0, y1) IS NOT NULL",
)
def _(s, d):
    trials = stream(s, d).filter("event = 54").select("session", F.col("seq").alias("trial"), "seq", exact_total(F.col("value")).alias("distance"))
    return asof.hold(trials, _encoder(s, d), ["trial"], on="distance").filter("trial is not null").select("session", "seq", "trial")


@query(
    "a12_running_speed",
    with_(EV, RD, ENC, "sp AS (SELECT *, min({'t': time_us, 's': seq, 'd': distance}) OVER (PARTITION BY session "
        "ORDER BY time_us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS f FROM en)")
    + "SELECT session, seq, round(CASE WHEN time_us > f.t AND distance > f.d THEN (distance - f.d) / (time_us - f.t) * 1e6 "
    "ELSE 0.0 END, 9) AS speed FROM sp",
)
def _(s, d):
    return asof.running_speed(_encoder(s, d), 86_400_000_000).select("session", "seq", F.round("speed", 9).alias("speed"))


@query(
    "a13_slowest_clock",
    with_(EV, "g AS (SELECT session, event AS camera, count(*) AS frames, min(time_us) AS lo, max(time_us) AS hi FROM ev "
        "GROUP BY ALL HAVING count(*) >= 2 AND max(time_us) > min(time_us))",
        "r AS (SELECT *, (frames - 1) * 1e6 / (hi - lo) AS rate FROM g)")
    + "SELECT session, camera, frames, round(rate, 9) AS rate FROM (SELECT *, row_number() OVER (PARTITION BY session "
    "ORDER BY rate, camera) AS rn FROM r) WHERE rn = 1",
)
def _(s, d):
    return asof.slowest_clock(stream(s, d).withColumnRenamed("event", "camera")).select("session", "camera", "frames",
        F.round("rate", 9).alias("rate"))


@query("a14_clock_heights", with_(EV) + "SELECT session, event AS camera, count(*) AS samples FROM ev GROUP BY ALL")
def _(s, d):
    return asof.clock_heights(stream(s, d).withColumnRenamed("event", "camera"), ["session", "camera"])


@query("a15_elapsed_minutes", with_(EV)
    + "SELECT session, seq, round_even((time_us - min(time_us) OVER (PARTITION BY session)) / 6e7, 2) AS elapsed_min "
    "FROM ev")
def _(s, d):
    return asof.elapsed_minutes(stream(s, d)).select("session", "seq", "elapsed_min")


@query("running_total_bucketed", with_(EV) + "SELECT session, seq, round(sum(value) OVER (PARTITION BY session "
    "ORDER BY time_us, seq ROWS UNBOUNDED PRECEDING), 4) AS total FROM ev")
def _(s, d):
    return asof.running_total(stream(s, d), "value", "total", width=5 * 86_400_000_000).select("session", "seq", F.round("total", 4).alias("total"))
