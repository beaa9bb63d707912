"""Queries of session assembly, sources and expectations, and the flagship query."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoweave.functions import expect, registry
from chronoweave.functions.ordering import in_order
from chronoweave.functions.shared import fresh_path, settled
from chronoweave.operators import assemble, imaging, streams
from chronoweave.operators.asof import align_all
from chronoweave.plans.asof_queries import COR, ENC, SIGNED, STATE
from chronoweave.plans.imaging_queries import ALIGNED_FRAMES, BAND, EDGES, LIMIT_MS, OFFSETS
from chronoweave.plans.imaging_queries import _frames as recorded_frames
from chronoweave.plans.state_queries import MARKERS, _markers
from chronoweave.plans.stream_queries import PULSES, TONE, TRAIN, VOLUME
from chronoweave.plans.tables import CLOCK, EV, EXPONENT, LINE, RD, SCALE, clock, exact_total, exact_total_sql, near, read, readings, stream, with_
from chronoweave.sources import ingest, publishing

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


LABELS = {0: "idle", 1: "rest", 2: "run"}
ALIGNED = [EV, CLOCK, TRAIN, PULSES, VOLUME, TONE,
    "v0 AS (SELECT session, arg_min(volume, time_us) AS f FROM vo GROUP BY session)",
    "t0 AS (SELECT session, arg_min(state, time_us) AS f FROM tc GROUP BY session)",
    "a1 AS (SELECT ck.*, vo.volume FROM ck ASOF LEFT JOIN vo ON ck.session = vo.session AND ck.time_us >= vo.time_us)",
    "a2 AS (SELECT a1.*, tc.state FROM a1 ASOF LEFT JOIN tc ON a1.session = tc.session AND a1.time_us >= tc.time_us)",
    "al AS (SELECT a2.session, frame, time_us, coalesce(volume, v0.f) AS volume, coalesce(state, t0.f) AS tone FROM a2 "
    "LEFT JOIN v0 USING (session) LEFT JOIN t0 USING (session))",
    "rg AS (SELECT *, CASE WHEN (tone > 0) IS DISTINCT FROM lag(tone > 0) OVER w THEN 1 "
    "ELSE 0 END AS c, coalesce(volume - lag(volume) OVER w, 0) AS delta FROM al WINDOW w AS (PARTITION BY session "
    "ORDER BY frame))",
    "ri AS (SELECT *, sum(c) OVER (PARTITION BY session ORDER BY frame ROWS UNBOUNDED PRECEDING) AS run FROM rg)",
    "rw AS (SELECT *, CASE WHEN tone IS NULL THEN 'tone' WHEN tone <= 0 THEN 'no' WHEN sum(delta) "
    "OVER (PARTITION BY session, run) > 0 THEN 'yes' ELSE 'tone' END AS reward FROM ri)"]  # fmt: skip


#: Width of a bucket where a session is cut: five days, or so many of a running value.
FIVE_DAYS, FAR = 5 * 86_400_000_000, 500.0


def _rewarded(s, d, width=None):
    events = stream(s, d)
    rows = align_all(clock(s, d), [(streams.valve_volume(events, SCALE, EXPONENT), ["volume"], "hold"),
            (streams.tone(events), ["tone_state"], "hold")])
    return assemble.reward_classes(rows, width=width)


@query("flagship_reward_summary", with_(*ALIGNED)
    + "SELECT session, count(*) FILTER (WHERE reward = 'yes') AS rewarded, count(*) FILTER (WHERE reward = 'tone') AS "
    "tone_only, count(*) FILTER (WHERE reward = 'no') AS silent FROM rw GROUP BY session")
def _(s, d):
    """How many rewarded, tone-only and silent reference samples has each session?"""
    count = lambda kind, name: F.count_if(F.col("reward") == kind).alias(name)
    return _rewarded(s, d).groupBy("session").agg(count("yes", "rewarded"), count("tone", "tone_only"), count("no", "silent"))


REWARDS_SQL = with_(*ALIGNED) + "SELECT session, frame, round(delta, 4) + 0.0 AS delta, CAST(run AS BIGINT) AS run, reward FROM rw"


def _reward_rows(s, d, width=None):
    return _rewarded(s, d, width).select("session", "frame", (F.round("delta", 4) + 0.0).alias("delta"), "run", "reward")


@query("b3_b6_reward_classes", REWARDS_SQL)
def _(s, d):
    return _reward_rows(s, d)


@query("b3_b6_reward_classes_bucketed", REWARDS_SQL)
def _(s, d):
    """Long sessions: runs, increments and sums over runs in two levels."""
    return _reward_rows(s, d, FIVE_DAYS)


STATES = (
    "ss AS (SELECT session, time_us, seq, seq % 3 AS code, CASE seq % 3 WHEN 0 THEN 'idle' WHEN 1 THEN 'rest' "
    "ELSE 'run' END AS system_state, value FROM ev WHERE event = 60)"
)


def _states(s, d):
    return assemble.labelled(readings(s, d).withColumn("code", F.col("seq") % 3), "code", LABELS, "system_state")


@query("b1_code_labels", with_(EV, STATES) + "SELECT session, seq, system_state FROM ss")
def _(s, d):
    return _states(s, d).select("session", "seq", "system_state")


@query("b2_closed_values", with_(EV, STATES)
    + "SELECT 'system_state is known' AS \"check\", CAST(seq AS VARCHAR) AS key, 'unknown value rest' AS message FROM ss "
    "WHERE system_state = 'rest'")
def _(s, d):
    return expect.known_labels(_states(s, d), "system_state", ["idle", "run"], "seq")


_F = "PARTITION BY session ORDER BY frame ROWS UNBOUNDED PRECEDING"
NUMBERED = "nb AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY time_us, seq) AS frame FROM ss)"


def _numbered(s, d):
    return _states(s, d).withColumn("frame", F.row_number().over(in_order()))


@query("b7_state_gate", with_(EV, STATES) + "SELECT session, seq, CASE WHEN system_state = 'run' THEN value ELSE 0.0 END AS speed FROM ss")
def _(s, d):
    return _states(s, d).select("session", "seq", assemble.gated("value", ["run"]).alias("speed"))


GATED_SQL = (with_(EV, STATES, NUMBERED)
    + f"SELECT session, seq, CASE WHEN count(*) FILTER (WHERE system_state <> 'idle') OVER ({_F}) > 0 "
    f"THEN coalesce(last_value(CASE WHEN system_state = 'run' THEN value END IGNORE NULLS) OVER ({_F}), 0.0) "
    f"ELSE 0.0 END AS distance FROM nb")


@query("b8_gated_fill", GATED_SQL)
def _(s, d):
    return assemble.gated_fill(_numbered(s, d), "distance", "value", ["run"]).select("session", "seq", "distance")


@query("b8_gated_fill_bucketed", GATED_SQL)
def _(s, d):
    return assemble.gated_fill(_numbered(s, d), "distance", "value", ["run"], width=FIVE_DAYS).select("session", "seq", "distance")


@query("b9_brake_flag", with_(EV, STATES) + "SELECT session, seq, CAST(value > 40 AS INTEGER) AS brake FROM ss")
def _(s, d):
    return _states(s, d).select("session", "seq", assemble.brake_flag("value", 40.0).alias("brake"))


#: Streams of an assembled session, read straight from the events; the parsers of each stream have queries of their own.
VALVE = (
    f"va AS (SELECT session, time_us, seq, {{'w': {exact_total_sql('(CASE WHEN event = 54 THEN value ELSE 0 END)')}, "
    "'t': event = 54} AS p FROM ev WHERE event IN (54, 55))"
)
SPEED_US = 86_400_000_000
SPEED = f"""sf AS (SELECT *, min({{'t': time_us, 's': seq, 'd': distance}}) OVER (PARTITION BY session
    ORDER BY time_us RANGE BETWEEN {SPEED_US} PRECEDING AND CURRENT ROW) AS f FROM en),
 sp AS (SELECT session, time_us, seq, CASE WHEN time_us > f.t AND distance > f.d
    THEN (distance - f.d) / (time_us - f.t) * 1e6 ELSE 0.0 END AS speed FROM sf)"""
OTHERS = (
    "bk AS (SELECT session, time_us, seq, value AS torque FROM ev "
    "WHERE event = 52), sc AS (SELECT session, time_us, seq, CAST(seq % 2 AS INTEGER) AS screen FROM ev WHERE event = 51)"
)
_S = "PARTITION BY session ORDER BY frame"


def windows_of(clock: str, name: str) -> str:
    return (
        f"{name} AS (SELECT *, coalesce(lag(time_us) OVER w, 2 * time_us - lead(time_us) "
        f"OVER w, time_us - 1) AS start_us FROM {clock} WINDOW w AS ({_S}))"
    )


def behavior_sql(clock: str, whole: bool = True) -> list[str]:
    """CTEs that end with ``bh``, the behavior table on a clock; not ``whole``: without encoder, screen, brake and torque."""
    more = [near("n3", "en", clock, "distance"), near("n4", "sp", clock, "speed"), near("n5", "sc", clock, "screen"),
        near("n6", "bk", clock, "torque"), f"w0 AS (SELECT session, frame, start_us AS time_us FROM bw)",
        near("n7", "sg", "w0", "value"),
        "tq AS (SELECT session, frame, value FROM (SELECT *, row_number() OVER (PARTITION BY session, frame "
        "ORDER BY abs(value) DESC, t, seq) AS rn FROM (SELECT session, frame, -1 AS t, -1 AS seq, coalesce(y0, y1) AS "
        "value FROM n7 UNION ALL SELECT bw.session, frame, sg.time_us, seq, value FROM bw "
        "JOIN sg ON sg.session = bw.session AND sg.time_us > start_us AND sg.time_us <= bw.time_us)) WHERE rn = 1)"]  # fmt: skip
    joins = "".join(f" JOIN {n} USING (session, frame)" for n in ("n3", "n4", "n5", "n6")) + " LEFT JOIN tq USING (session, frame)" if whole else ""
    extra = f", {LINE.format(on='n3.time_us').replace('x0', 'n3.x0').replace('x1', 'n3.x1').replace('y0', 'n3.y0').replace('y1', 'n3.y1')} AS far, {LINE.format(on='n4.time_us').replace('x0', 'n4.x0').replace('x1', 'n4.x1').replace('y0', 'n4.y0').replace('y1', 'n4.y1')} AS speed, coalesce(n5.y0, n5.y1) AS screens, coalesce(n6.y0, n6.y1) AS held, tq.value AS torque" if whole else ""
    columns = (
        f"CAST(held > 40 AS INTEGER) AS brake, screens, CASE WHEN system_state = 'run' THEN 0.0 "
        f"ELSE torque END AS \"torque_N_cm\", round(CASE WHEN count(*) FILTER (WHERE system_state <> 'idle') OVER u > 0 "
        f"THEN coalesce(last_value(CASE WHEN system_state = 'run' THEN far END IGNORE NULLS) OVER u, 0.0) "
        f"ELSE 0.0 END, 4) AS distance_cm, round(CASE WHEN system_state = 'run' THEN speed "
        f"ELSE 0.0 END, 9) AS speed_cm_s, " if whole else ""
    )
    return [
        STATES, STATE, VALVE, *([RD, ENC, SPEED, OTHERS, SIGNED] if whole else []), windows_of(clock, "bw"),
        "lo AS (SELECT * FROM (SELECT *, lag(state, 1, 0) OVER (PARTITION BY session ORDER BY time_us, seq) AS was "
        "FROM st) WHERE state > 0 AND was <= 0)",
        near("n1", "ss", clock, "system_state"), near("n2", "va", clock, "p"), *(more if whole else []),
        f"b0 AS (SELECT n1.session, n1.frame, n1.time_us, coalesce(n1.y0, n1.y1) AS system_state, coalesce(n2.y0, n2.y1) "
        f"AS va, EXISTS (SELECT 1 FROM lo WHERE lo.session = bw.session AND lo.time_us > bw.start_us "
        f"AND lo.time_us <= bw.time_us) AS lick{extra} FROM n1 JOIN n2 USING (session, frame) "
        f"JOIN bw USING (session, frame){joins})",
        f"b1 AS (SELECT *, CASE WHEN va.t IS DISTINCT FROM lag(va.t) OVER w THEN 1 "
        f"ELSE 0 END AS c, coalesce(va.w - lag(va.w) OVER w, 0) AS delta FROM b0 WINDOW w AS ({_S}))",
        f"b2 AS (SELECT *, sum(c) OVER ({_S} ROWS UNBOUNDED PRECEDING) AS run FROM b1)",
        f"bh AS (SELECT session, frame, time_us, round_even((time_us - min(time_us) "
        f"OVER (PARTITION BY session)) / 6e7, 2) AS elapsed_minutes, {columns}CAST(lick AS INTEGER) AS lick, round(va.w, "
        f"4) AS \"water_uL\", CASE WHEN va.t IS NULL THEN 'tone' WHEN NOT va.t THEN 'no' WHEN sum(delta) "
        f"OVER (PARTITION BY session, run) > 0 THEN 'yes' ELSE 'tone' END AS reward, system_state "
        f"FROM b2 WINDOW u AS ({_S} ROWS UNBOUNDED PRECEDING))",
    ]


def _codes(s, d):
    return readings(s, d).select("session", "time_us", "seq", (F.col("seq") % 3).cast("int").alias("state"))


def _behavior(s, d, ticks, whole: bool = True, drop_time: bool = False, width: int | None = None):
    events = stream(s, d)
    of = lambda *codes: events.filter(F.col("event").isin(*codes))
    valve = of(54, 55).withColumn("volume", exact_total(F.when(F.col("event") == 54, F.col("value")).otherwise(0.0))).withColumn("tone_state", (F.col("event") == 54).cast("int"))
    streams_ = {
        "encoder": readings(s, d).withColumn("traveled_distance_cm", exact_total(F.col("value"))),
        "screen": of(51).withColumn("screen_state", (F.col("seq") % 2).cast("int")),
        "brake": of(52).withColumn("brake_torque", F.col("value")),
        "torque": events.withColumn("torque", F.when(F.col("seq") % 2 == 0, F.col("value")).otherwise(-F.col("value"))),
    }
    lick = of(51, 52).withColumn("lick_state", (F.col("event") == 51).cast("int"))
    return assemble.behavior(ticks, _codes(s, d), lick, valve, labels=LABELS, minimum_torque=40.0, window_us=SPEED_US,
        drop_time=drop_time, width=width, **(streams_ if whole else {}))


def _rounded(df):
    places = {"water_uL": 4, "distance_cm": 4, "speed_cm_s": 9, **{c: 6 for c in df.columns if c.startswith(("face_camera", "body_camera", "pupil"))}}
    return df.withColumns({c: F.round(c, n) for c, n in places.items() if c in df.columns})


@query("b11_behavior_table", with_(EV, CLOCK, *behavior_sql("ck")) + "SELECT * FROM bh")
def _(s, d):
    return _rounded(_behavior(s, d, clock(s, d)))


@query("b11_behavior_table_bucketed", with_(EV, CLOCK, *behavior_sql("ck")) + "SELECT * FROM bh")
def _(s, d):
    """The same with every pass over a session cut into buckets."""
    return _rounded(_behavior(s, d, clock(s, d), width=FIVE_DAYS))


@query("b10_mandatory_streams", with_(EV, CLOCK, *behavior_sql("ck", whole=False)) + "SELECT * FROM bh")
def _(s, d):
    """Sessions of a type without encoder, screen, brake and torque: their columns are absent."""
    return _rounded(_behavior(s, d, clock(s, d), whole=False))


TRIAL_TYPES, RUNTIME_STATES = {0: "ABC", 1: "ABCD", 2: "AD", 3: "B"}, {0: "idle", 1: "baseline", 2: "task", 3: "probe", 4: "rest"}
_case = lambda column, labels: f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


def runtime_sql(clock: str) -> list[str]:
    """CTEs that end with ``rt``, the runtime table on a clock."""
    return [
        COR, near("on1", "en", "co", "distance"),
        "os AS (SELECT session, time_us, seq, start_cm, coalesce(y0, 0.0) AS onset, lead(start_cm) "
        "OVER (PARTITION BY session ORDER BY time_us, seq) - start_cm AS len FROM on1)",
        "pk AS (SELECT session, time_us, seq, {'onset': onset, 's': start_cm, 'len': len} AS p FROM os)",
        near("tr", "en", clock, "distance"),
        f"t2 AS (SELECT session, frame, time_us, {LINE.format(on='time_us')} AS dist FROM tr)",
        near("pl", "pk", "t2", "p"),
        "pf AS (SELECT session, frame, time_us, dist, coalesce(y0, y1) AS p FROM pl)",
        "pc AS (SELECT session, frame, time_us, p.s + CASE WHEN p.len IS NULL THEN greatest(dist - p.onset, 0.0) "
        "ELSE least(greatest(dist - p.onset, 0.0), p.len) END AS distance FROM pf WHERE p IS NOT NULL "
        "AND dist IS NOT NULL)",
        f"mk AS (SELECT session, time_us, seq, {exact_total_sql('value')} AS distance FROM ev WHERE event = 54)",
        "tn AS (SELECT session, distance, seq, {'n': row_number() OVER (PARTITION BY session "
        "ORDER BY seq), 'i': seq % 4} AS p FROM mk)",
        "cu AS (SELECT session, distance / 3 AS distance, seq, CAST(seq % 9 AS INTEGER) AS cue FROM mk)",
        "rs AS (SELECT session, time_us, seq, seq % 5 AS state FROM ev WHERE event = 55)",
        "gd AS (SELECT session, time_us, seq, CAST(seq % 2 AS INTEGER) AS state FROM ev WHERE event = 51)",
        near("r1", "tn", "pc", "p", "distance"), near("r2", "cu", "pc", "cue", "distance"),
        near("r3", "rs", "pc", "state"), near("r4", "gd", "pc", "state"),
        f"""rt AS (SELECT r1.session, r1.frame,
    CAST(coalesce(r1.y0, r1.y1).n AS INTEGER) AS trial, {_case('coalesce(r1.y0, r1.y1).i', TRIAL_TYPES)} AS trial_type, coalesce(r2.y0, r2.y1) AS cue,
 CAST(EXISTS (SELECT 1 FROM mk WHERE mk.session = r1.session AND r1.distance BETWEEN mk.distance
    AND mk.distance + 40) AS INTEGER) AS in_trigger_zone, {_case('coalesce(r3.y0, r3.y1)', RUNTIME_STATES)} AS runtime_state,
    coalesce(r4.y0, r4.y1) AS reinforcing_guided
 FROM r1 JOIN r2 USING (session, frame) JOIN r3 USING (session, frame) JOIN r4 USING (session, frame))""",
    ]


def _runtime(s, d, ticks, width=None, width_cm=None):
    events = stream(s, d)
    encoder = readings(s, d).withColumn("traveled_distance_cm", exact_total(F.col("value")))
    marks = events.filter("event = 54")
    corridors = marks.select("session", "time_us", "seq", ((F.row_number().over(in_order()) - 1) * 100.0).alias("start_cm"))
    marks = marks.select("session", "time_us", "seq", exact_total(F.col("value")).alias("distance"))
    zones = marks.select("session", F.col("distance").alias("start_cm"), (F.col("distance") + 40).alias("end_cm"))
    trials = marks.select("session", "distance", "seq", (F.col("seq") % 4).cast("int").alias("trial_type_index"))
    cues = marks.select("session", (F.col("distance") / 3).alias("distance"), "seq", (F.col("seq") % 9).cast("int").alias("cue"))
    states = events.filter("event = 55").select("session", "time_us", "seq", (F.col("seq") % 5).cast("int").alias("state"))
    guided = events.filter("event = 51").select("session", "time_us", "seq", (F.col("seq") % 2).cast("int").alias("state"))
    return assemble.runtime(ticks, encoder, corridors, trials, cues, zones, states, trial_types=TRIAL_TYPES,
        state_labels=RUNTIME_STATES, reinforcing=guided, width=width, width_cm=width_cm)


@query("b12_runtime_table", with_(EV, RD, CLOCK, ENC, *runtime_sql("ck")) + "SELECT * FROM rt")
def _(s, d):
    return _runtime(s, d, clock(s, d))


@query("b12_runtime_table_bucketed", with_(EV, RD, CLOCK, ENC, *runtime_sql("ck")) + "SELECT * FROM rt")
def _(s, d):
    """Cut by time, and by distance where the key is a distance."""
    return _runtime(s, d, clock(s, d), FIVE_DAYS, FAR)


def video_sql(clock: str) -> list[str]:
    """CTEs that end with ``vd``, the video table on a clock."""
    out = ["fc AS (SELECT session, time_us, seq, value FROM ev WHERE event = 51)",
        "bc AS (SELECT session, time_us, seq, value FROM ev WHERE event = 52)",
        "pu AS (SELECT session, time_us, seq, value, CAST(seq % 4 = 0 AS INTEGER) AS blink FROM ev WHERE event = 60)",
        windows_of(clock, "vw")]
    for name in ("fc", "bc"):
        out += [near(f"l{name}", name, clock, "value"),
            f"m{name} AS (SELECT vw.session, frame, max({name}.value) AS m, count(*) AS n FROM vw "
            f"JOIN {name} ON {name}.session = vw.session AND {name}.time_us > start_us AND {name}.time_us <= vw.time_us "
            f"GROUP BY ALL)",
                f"v{name} AS (SELECT session, frame, CASE WHEN n IS NULL THEN line "
                f"ELSE m END AS energy, line / 2 AS light FROM (SELECT session, frame, {LINE.format(on='time_us')} AS "
                f"line FROM l{name}) LEFT JOIN m{name} USING (session, frame))"]  # fmt: skip
    out += [near("pn", "pu", clock, "value"), near("pb", "pu", clock, "blink"),
        f"pv AS (SELECT session, frame, {LINE.format(on='time_us')} AS diameter FROM pn)"]
    return [*out, "vd AS (SELECT vfc.session, vfc.frame, round(vfc.energy, 6) AS face_camera_motion_energy, round(vfc.light, 6) AS "
        "face_camera_frame_luminance, round(vbc.energy, 6) AS body_camera_motion_energy, round(vbc.light, 6) AS "
        "body_camera_frame_luminance, round(diameter, 6) AS pupil_diameter_px, coalesce(y0, y1) AS blinking_state "
        "FROM vfc JOIN vbc USING (session, frame) JOIN pv USING (session, frame) JOIN pb USING (session, frame))"]


def _video(s, d, ticks):
    events = stream(s, d)
    camera = lambda code: events.filter(F.col("event") == code).select("session", "time_us", "seq",
        F.col("value").alias("motion_energy"), (F.col("value") / 2).alias("frame_luminance"))
    pupil = readings(s, d).select("session", "time_us", "seq", F.col("value").alias("pupil_diameter_px"),
        (F.col("seq") % 4 == 0).cast("int").alias("blinking_state"))
    return _rounded(assemble.video_table(ticks, {"face_camera": camera(51), "body_camera": camera(52), "third_camera": None}, pupil))


@query("b13_video_table", with_(EV, CLOCK, *video_sql("ck")) + "SELECT * FROM vd")
def _(s, d):
    return _video(s, d, clock(s, d))


@query("b14_row_counts_agree", with_(EV)
    + "SELECT 'as many rows as the clock' AS \"check\", CAST(session AS VARCHAR) AS key, count(*) FILTER (WHERE event = "
    "51) || ' and ' || count(*) FILTER (WHERE event = 52) || ' rows' AS message FROM ev WHERE event IN (51, 52) "
    "GROUP BY session HAVING count(*) FILTER (WHERE event = 51) <> count(*) FILTER (WHERE event = 52)")
def _(s, d):
    return expect.same_heights(streams.of_code(stream(s, d), 51), streams.of_code(stream(s, d), 52), ["session"], "as many rows as the clock")


@query("b15_mask_outside_run", with_(EV, STATES)
    + "SELECT session, seq, CASE WHEN system_state = 'run' THEN CAST(seq % 9 AS INTEGER) ELSE 255 END AS cue, "
    "CASE WHEN system_state = 'run' THEN CAST(seq % 4 AS INTEGER) ELSE 65535 END AS trial FROM ss")
def _(s, d):
    rows = _states(s, d).select("session", "seq", "system_state", (F.col("seq") % 9).cast("int").alias("cue"),
        (F.col("seq") % 4).cast("int").alias("trial"))
    return assemble.masked_outside_run(rows).drop("system_state")


@query("b16_clip", with_(EV, CLOCK, STATES,
        "f AS (SELECT session, min(time_us) AS a FROM ss WHERE code <> 0 GROUP BY session)",
        "l AS (SELECT session, max(time_us) AS b FROM ev WHERE event = 55 GROUP BY session)")
    + "SELECT ck.* FROM ck LEFT JOIN f USING (session) LEFT JOIN l USING (session) WHERE coalesce(time_us >= a, true) "
    "AND coalesce(time_us <= b, true)")
def _(s, d):
    return assemble.clipped(clock(s, d), _states(s, d).withColumnRenamed("code", "state"), stream(s, d).filter("event = 55"))


@query("b17_side_by_side", with_(EV, CLOCK) + "SELECT session, frame, time_us, frame * 2 AS twice, frame * 3 AS thrice FROM ck")
def _(s, d):
    ticks = clock(s, d)
    return assemble.side_by_side(ticks, ticks.withColumn("twice", F.col("frame") * 2), ticks.withColumn("thrice", F.col("frame") * 3))


BOUNDS = (
    "fi AS (SELECT session, min(time_us) AS a FROM ss WHERE code <> 0 "
    "GROUP BY session), la AS (SELECT session, max(time_us) AS b FROM ev WHERE event = 55 GROUP BY session)"
)
_INSIDE = "LEFT JOIN fi USING (session) LEFT JOIN la USING (session) WHERE coalesce(time_us >= a, true) AND coalesce(time_us <= b, true)"


@query(
    "b18_experiment_dataset",
    with_(EV, CLOCK, *behavior_sql("ck"), *runtime_sql("ck"), *video_sql("ck"),
        "sk AS (SELECT label AS session, vec_id AS frame, embedding AS single_day_spikes FROM embeddings)", BOUNDS)
    + """SELECT ck.session, ck.frame, ck.time_us, sk.single_day_spikes, bh.* EXCLUDE (session, frame, time_us, elapsed_minutes),
    CAST(CASE WHEN system_state IN ('idle', 'rest') THEN 65535 ELSE trial END AS INTEGER) AS trial, CASE
    WHEN system_state IN ('idle', 'rest') THEN 'undefined' ELSE trial_type END AS trial_type,
 CAST(CASE WHEN system_state IN ('idle', 'rest') THEN 255
    ELSE cue END AS INTEGER) AS cue, rt.* EXCLUDE (session, frame, trial, trial_type, cue), vd.* EXCLUDE (session, frame)
    FROM ck LEFT JOIN sk ON sk.session = ck.session AND sk.frame = ck.frame
 JOIN bh ON bh.session = ck.session AND bh.frame = ck.frame JOIN rt ON rt.session = ck.session AND rt.frame = ck.frame JOIN vd ON vd.session = ck.session AND vd.frame = ck.frame LEFT JOIN fi ON fi.session = ck.session LEFT JOIN la ON la.session = ck.session WHERE coalesce(ck.time_us >= a, true) AND coalesce(ck.time_us <= b, true)""",
)
def _(s, d):
    """Traces are vectors; the tables on the clock of each session, masked and clipped."""
    ticks = settled(clock(s, d).select("session", "frame", "time_us"))
    traces = read(s, d, "embeddings").select(F.col("label").cast("bigint").alias("session"),
        F.col("vec_id").cast("bigint").alias("frame"), F.posexplode("embedding").alias("roi", "value"))
    frames = imaging.attach_traces(ticks, {"single_day_spikes": traces})
    whole = assemble.experiment(frames, _rounded(_behavior(s, d, ticks, drop_time=True)), _runtime(s, d, ticks),
        _video(s, d, ticks), _codes(s, d), stream(s, d).filter("event = 55"))
    if expect.undescribed(whole, set(assemble.DESCRIPTIONS)):
        raise expect.ExpectationError("columns without a description")
    return whole


BESIDE = " ".join(f"JOIN {t} ON {t}.session = ck.session AND {t}.frame = ck.frame" for t in ("bh", "rt", "vd"))


@query(
    "b18_imaging_dataset",
    with_(EV, f"ck AS ({with_(EV, TRAIN, EDGES, BAND, OFFSETS, *ALIGNED_FRAMES)} SELECT session, CAST(row_number() "
        "OVER (PARTITION BY session ORDER BY frame) AS BIGINT) AS frame, time_us FROM af)",
        *behavior_sql("ck"), *runtime_sql("ck"), *video_sql("ck"),
        "sk AS (SELECT label AS session, vec_id AS frame, embedding AS single_day_spikes FROM embeddings)", BOUNDS)
    + f"""SELECT ck.session, ck.frame, ck.time_us, sk.single_day_spikes, bh.* EXCLUDE (session, frame, time_us, elapsed_minutes),
 CAST(CASE WHEN system_state IN ('idle', 'rest') THEN 65535 ELSE trial END AS INTEGER) AS trial,
 CASE WHEN system_state IN ('idle', 'rest') THEN 'undefined' ELSE trial_type END AS trial_type,
 CAST(CASE WHEN system_state IN ('idle', 'rest') THEN 255 ELSE cue END AS INTEGER) AS cue,
 rt.* EXCLUDE (session, frame, trial, trial_type, cue), vd.* EXCLUDE (session, frame)
 FROM ck LEFT JOIN sk ON sk.session = ck.session AND sk.frame = ck.frame {BESIDE}
 LEFT JOIN fi ON fi.session = ck.session LEFT JOIN la ON la.session = ck.session
 WHERE coalesce(ck.time_us >= a, true) AND coalesce(ck.time_us <= b, true)""",
)
def _(s, d):
    """The clock is the imaging frames themselves: trigger pulses matched with the recorder's own frames (F11, F12), with traces."""
    train, recorded = streams.states(stream(s, d), 51, 52), settled(recorded_frames(s, d))
    pulses = settled(imaging.paired_pulses(train))
    counts = recorded.groupBy("session").agg(F.count(F.lit(1)).alias("frame_count"))
    traces = read(s, d, "embeddings").select(F.col("label").cast("bigint").alias("session"),
        F.col("vec_id").cast("bigint").alias("frame"), F.posexplode("embedding").alias("roi", "value"))
    frames = settled(assemble.fluorescence(imaging.in_band(pulses, LIMIT_MS, LIMIT_MS), pulses, recorded, counts,
            {"single_day_spikes": traces}, 3_600_000_000))
    ticks = frames.select("session", "frame", "time_us")
    return assemble.experiment(frames, _rounded(_behavior(s, d, ticks, drop_time=True)), _runtime(s, d, ticks),
        _video(s, d, ticks), _codes(s, d), stream(s, d).filter("event = 55"))


CAMERAS = {"face_camera": 51, "body_camera": 52}


@query(
    "b19_training_dataset",
    with_(EV, "cs AS (SELECT session, event, (count(*) - 1) * 1e6 / (max(time_us) - min(time_us)) AS rate FROM ev "
        "WHERE event IN (51, 52) GROUP BY ALL HAVING count(*) >= 2 AND max(time_us) > min(time_us))",
          "cp AS (SELECT session, arg_min(event, (rate, event)) AS event FROM cs GROUP BY session)",
          "cc AS (SELECT session, row_number() OVER (PARTITION BY session ORDER BY time_us, seq) AS frame, time_us "
          "FROM ev JOIN cp USING (session, event))",
          *behavior_sql("cc"), *video_sql("cc"), BOUNDS)
    + f"SELECT bh.*, vd.* EXCLUDE (session, frame) FROM bh JOIN vd USING (session, frame) {_INSIDE}",
)
def _(s, d):
    """The slowest of two cameras is the clock of each session."""
    code = F.when(F.col("event") == CAMERAS["face_camera"], "face_camera").otherwise("body_camera")
    frames = stream(s, d).filter("event in (51, 52)").select("session", "time_us", "seq", code.alias("camera"))
    ticks = settled(assemble.camera_clock(frames, {name: place for place, name in enumerate(CAMERAS)}))
    return assemble.training(_rounded(_behavior(s, d, ticks)), _video(s, d, ticks), _codes(s, d), stream(s, d).filter("event = 55"))


@query("b20_route_by_type", with_(EV, CLOCK)
    + "SELECT session, frame, CASE WHEN session % 2 = 0 THEN frame END AS imaging, CASE WHEN session % 2 = 1 "
    "THEN time_us END AS camera FROM ck WHERE session % 5 < 4")
def _(s, d):
    ticks = clock(s, d)
    sessions = ticks.select("session").distinct().withColumn("type",
        F.when(F.col("session") % 5 == 4, "other").when(F.col("session") % 2 == 0, "experiment").otherwise("training"))
    return assemble.by_type(sessions, {"experiment": ticks.select("session", "frame", F.col("frame").alias("imaging")),
            "training": ticks.select("session", "frame", F.col("time_us").alias("camera"))})


@query("b21_b22_descriptions", "SELECT user_id AS session, count(*) AS frames FROM events GROUP BY 1")
def _(s, d):
    """Described columns; the check itself looks at names only."""
    rows = assemble.described(stream(s, d).groupBy("session").agg(F.count(F.lit(1)).alias("frames")))
    if expect.undescribed(rows, {*assemble.DESCRIPTIONS, "frames"}):
        raise expect.ExpectationError("columns without a description")
    return rows


@query("s2_clock_spans", with_(EV)
    + "SELECT session, arg_min(time_us, seq) AS first_us, arg_max(time_us, seq) AS last_us, count(*) AS samples FROM ev "
    "GROUP BY session")
def _(s, d):
    return ingest.clock_spans(stream(s, d), ["session"])


@query("s3_row_counts", "SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1")
def _(s, d):
    return ingest.row_counts(read(s, d, "lineitem"), ["l_returnflag"])


@query("s4_schema_only", "SELECT column_name AS name FROM (DESCRIBE SELECT * FROM lineitem)")
def _(s, d):
    return s.createDataFrame([(c,) for c in ingest.schema_of(s, f"{d}/lineitem.parquet")], "name string")


#: Most events of one archive.
ARCHIVE = 10_000


@query("s5_log_archives", with_(EV) + "SELECT CAST(session AS VARCHAR) AS path, seq - 1 AS seq, event AS source, time_us "
    "FROM (SELECT session, event, time_us, row_number() OVER (PARTITION BY session ORDER BY time_us, seq) + 1 AS seq "
    "FROM ev)")
def _(s, d):
    """Archives are packed from the events of each session, ``ARCHIVE`` at most in one, one per row, and decoded."""
    entry = lambda source, elapsed: F.concat(F.lit("09000000"), F.lpad(F.hex(source), 2, "0"),
        F.array_join(F.reverse(F.regexp_extract_all(F.lpad(F.hex(elapsed), 16, "0"), F.lit("(..)"), F.lit(1))),
            ""))
    base = 1_600_000_000_000_000
    place = F.row_number().over(Window.partitionBy("session").orderBy("time_us", "seq", "event"))
    rows = stream(s, d).withColumn("piece", F.floor((place - 1) / ARCHIVE)).groupBy("session",
        "piece").agg(F.array_sort(F.collect_list(F.struct("time_us", "seq", "event"))).alias("e"))
    body = F.array_join(F.transform("e", lambda x: entry(x["event"], x["time_us"] - base)), "")
    files = rows.select(F.concat_ws("/", "session", "piece").alias("path"), F.unhex(F.concat(entry(F.lit(0), F.lit(base)), body)).alias("content"))
    before = F.substring_index("path", "/", -1).cast("bigint") * ARCHIVE
    return ingest.messages(files).select(F.substring_index("path", "/", 1).alias("path"), (before + F.col("seq")).alias("seq"), "source", "time_us")


@query("s6_module_messages", with_(EV) + "SELECT session, time_us, seq, CAST(event AS INTEGER) AS event FROM ev WHERE event = 60")
def _(s, d):
    return streams.of_code(stream(s, d), 60).drop("value")


@query("s10_path_markers", with_(MARKERS) + "SELECT * FROM mk")
def _(s, d):
    return _markers(s, d)


@query("s1_s12_published_table", "SELECT * FROM orders")
def _(s, d):
    """A table published twice: readers see the second one whole."""
    path, orders = fresh_path(s, "published"), read(s, d, "orders")
    publishing.publish({"orders": orders.select("o_orderkey")}, path)
    publishing.publish({"orders": orders}, path)
    return publishing.read_published(s, path, "orders")


@query("s12_m16_published_together", "SELECT o_custkey AS animal, CAST(count(*) AS BIGINT) AS sessions, max(o_orderkey) AS latest FROM orders GROUP BY 1")
def _(s, d):
    """Detail and summary become visible in one step: the summary is read and checked against the detail of the same version."""
    path, orders = fresh_path(s, "published"), read(s, d, "orders").select(F.col("o_custkey").alias("animal"), F.col("o_orderkey").alias("session"))
    summary = lambda detail: detail.groupBy("animal").agg(F.count(F.lit(1)).alias("sessions"), F.max("session").alias("latest"))
    half = orders.filter("session % 2 = 0")
    publishing.publish({"detail": half, "summary": summary(half)}, path)
    version = publishing.publish({"detail": orders, "summary": summary(orders)}, path)
    detail, found = (publishing.read_published(s, path, name, version) for name in ("detail", "summary"))
    return found.join(detail.groupBy("animal").agg(F.count(F.lit(1)).alias("sessions")), ["animal", "sessions"])


@query("s13_session_folders",
    "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS animal, c_mktsegment AS session, "
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS version FROM customer")
def _(s, d):
    """A folder for each animal and session; the sessions of a second write replace their own only."""
    path = fresh_path(s, "sessions")
    rows = read(s, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("animal"),
        F.col("c_mktsegment").alias("session"), F.lit(0).alias("version"))
    ingest.write_sessions(rows, path)
    ingest.write_sessions(rows.filter("session = 'BUILDING'").withColumn("version", F.lit(1)), path)
    return ingest.read_sessions(s, path)


@query("x2_donated_parser", with_(EV) + "SELECT session, time_us, seq, value > 50 AS loud FROM ev WHERE event IN (51, 52)")
def _(s, d):
    """A parser that a system donates, applied to the events it names."""
    if "query" not in registry.systems():
        loud = lambda df: df.select("session", "time_us", "seq", (F.col("value") > 50).alias("loud"))
        registry.donate(registry.System("query", {"sound": loud}, {"sound": (51, 52)}, lambda df: df,
                lambda *tables: tables[0], {"run": ("video",)}, {"loud": "louder than 50"}))
    return registry.parsed(stream(s, d), "query", "sound")


@query("s15_named_clocks", with_(EV)
    + "SELECT session, seq, CASE event WHEN 51 THEN 'face' ELSE 'body' END AS camera FROM ev WHERE event IN (51, 52)")
def _(s, d):
    clocks = stream(s, d).withColumnRenamed("event", "source_id")
    names = s.createDataFrame([(51, "face"), (52, "body"), (99, "absent")], "source_id int, name string")
    return ingest.named_clocks(clocks, clocks.select("session").distinct().join(names)).select("session", "seq", "camera")


@query("s16_name_collisions",
    "SELECT 'canonical names differ' AS \"check\", '0/r' || n_regionkey AS key, count(*) || ' cameras' AS message "
    "FROM nation GROUP BY n_regionkey HAVING count(*) > 1")
def _(s, d):
    return ingest.name_collisions(read(s, d, "nation").select(F.lit(0).alias("session"),
            F.col("n_nationkey").alias("source_id"), F.concat(F.lit("r"), "n_regionkey").alias("name"),
            F.col("n_name").alias("parsed")))


FILES = (
    "fl AS (SELECT source AS session, CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 10 = 0 THEN 'checksum.txt' "
    "ELSE 'data' END AS name, sha256(text) AS digest FROM documents)"
)
DIGESTS = """gr AS (SELECT session, substr(sha256(path), 1, 3) AS g, sha256(string_agg(path || ' ' || digest, chr(10)
    ORDER BY path, digest)) AS digest FROM fl WHERE name <> 'checksum.txt' GROUP BY ALL),
 dg AS (SELECT session, sha256(string_agg(g || ' ' || digest, chr(10) ORDER BY g)) AS digest FROM gr GROUP BY session)"""


def _files(s, d):
    return read(s, d, "documents").select(F.col("source").alias("session"), F.col("doc_id").cast("string").alias("path"),
        F.when(F.col("doc_id") % 10 == 0, "checksum.txt").otherwise("data").alias("name"),
        F.col("text").cast("binary").alias("content"))


@query("s17_session_digests", with_(FILES, DIGESTS) + "SELECT session, digest FROM dg")
def _(s, d):
    return ingest.session_digests(_files(s, d), ["checksum.txt"])


@query("s18_verify_digests", with_(FILES, DIGESTS)
    + "SELECT session, CASE length(session) WHEN 4 THEN 'VERIFIED' ELSE 'NO_STORED_VALUE' END AS verdict FROM dg")
def _(s, d):
    digests = ingest.session_digests(_files(s, d), ["checksum.txt"])
    return ingest.verified(digests, digests.filter(F.length("session") == 4))


@query("s19_has_data", with_(FILES) + "SELECT session, bool_or(name <> 'checksum.txt') AS has_data FROM fl GROUP BY session")
def _(s, d):
    return ingest.has_data(_files(s, d), ["checksum.txt"])


@query("x1_expectations",
    "SELECT 'price is positive' AS \"check\", CAST(o_orderkey AS VARCHAR) AS key, 'price under 2000' AS message "
    "FROM orders WHERE o_totalprice < 2000")
def _(s, d):
    return expect.violations(read(s, d, "orders"), "price is positive", F.col("o_totalprice") < 2000, F.col("o_orderkey"), "price under 2000")
