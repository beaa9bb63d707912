"""Queries of the event stream and runtime log operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoweave.functions.ordering import in_order, with_runs
from chronoweave.operators import runtime_log, streams
from chronoweave.plans.tables import CM_PER_PULSE, EV, EXPONENT, SCALE, parts_for, read, stream, with_

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


W = "PARTITION BY session ORDER BY time_us, seq"
TRAIN = f"""tr AS (SELECT session, time_us, CAST(row_number() OVER (PARTITION BY session
    ORDER BY time_us, event, seq) AS BIGINT) AS seq, CASE event WHEN 51 THEN 1 ELSE 0 END AS state
 FROM ev WHERE event IN (51, 52))"""


@query("e1_by_event_code", with_(EV) + "SELECT session, time_us, seq, event, value FROM ev WHERE event = 51")
def _(s, d):
    return streams.of_code(stream(s, d), 51)


@query("e2_payload_decode", with_(EV)
    + "SELECT seq, CASE WHEN seq % 7 = 0 THEN NULL ELSE CAST(seq % 65536 AS DOUBLE) END AS decoded, seq % 65536 AS "
    "unsigned_value FROM ev")
def _(s, d):
    word = F.lpad(F.hex(F.col("seq") % 65536), 4, "0")
    data = F.unhex(F.concat(F.substring(word, 3, 2), F.substring(word, 1, 2)))
    rows = stream(s, d).select("seq", data.alias("data"), F.when(F.col("seq") % 7 == 0, "int32").otherwise("uint16").alias("dtype"))
    return rows.select("seq", streams.decode_payload("data", "dtype").alias("decoded"),
        streams.unsigned_payload(F.col("data")).alias("unsigned_value"))


@query("e3_merge_streams", with_(EV)
    + "SELECT session, time_us, event, value, CAST(row_number() OVER (PARTITION BY session "
    "ORDER BY time_us, event, seq) AS BIGINT) AS seq FROM ev WHERE event IN (51, 52)")
def _(s, d):
    return streams.merge(streams.of_code(stream(s, d), 51), streams.of_code(stream(s, d), 52))


DIRECTIONS = "dr AS (SELECT session, time_us, seq, event, value FROM ev WHERE event IN (51, 52) AND (session % 10 <> 3 OR event = 51))"


def _directions(s, d):
    """Sessions that end in 3 have one direction only."""
    return stream(s, d).filter("event in (51, 52) and (session % 10 <> 3 or event = 51)")


MISSING = f"""ms AS (SELECT session, time_us, seq, event, value FROM dr UNION ALL
 SELECT session, min(time_us) + 1, arg_min(seq, time_us), CASE WHEN bool_or(event = 51) THEN 52 ELSE 51 END, 0.0 FROM dr
    GROUP BY session HAVING count(DISTINCT event) = 1),
 mg AS (SELECT session, time_us, event, value, row_number() OVER (PARTITION BY session ORDER BY time_us, event, seq) AS seq FROM ms)"""


@query(
    "e4_e6_encoder_distance",
    with_(EV, DIRECTIONS, MISSING)
    + f"SELECT session, time_us, round(sum(CASE WHEN event = 51 THEN value ELSE -value END * {CM_PER_PULSE}) "
    f"OVER (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING), 6) + 0.0 AS distance FROM mg",
)
def _(s, d):
    return streams.encoder(_directions(s, d), CM_PER_PULSE).select("session", "time_us", (F.round("traveled_distance_cm", 6) + 0.0).alias("distance"))


CLOSED = f"""ls AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY seq DESC) AS rn FROM tr),
 cl AS (SELECT session, time_us, seq, state FROM tr UNION ALL SELECT session, time_us + 1, seq + 1, 0 FROM ls WHERE rn = 1 AND state = 1)"""


@query("e7_ttl_train", with_(EV, TRAIN, CLOSED) + "SELECT session, time_us, seq, state FROM cl")
def _(s, d):
    return streams.ttl(stream(s, d))


@query("e8_brake_torque", with_(EV, TRAIN)
    + "SELECT session, time_us, seq, CASE state WHEN 1 THEN 11.30234233 ELSE 0.42383811 END AS brake_torque FROM tr")
def _(s, d):
    return streams.brake(stream(s, d), 11.30234233, 0.42383811)


PULSES = """ed AS (SELECT *, state - coalesce(lag(state) OVER (PARTITION BY session ORDER BY seq), state) AS edge FROM tr),
 pu AS (SELECT session, time_us, seq, edge, CASE WHEN edge < 0 THEN time_us - lag(time_us) OVER (PARTITION BY session
    ORDER BY seq) END AS pulse_us FROM ed WHERE edge <> 0)"""


@query("e9_pulse_pairs", with_(EV, TRAIN, PULSES) + "SELECT session, time_us, seq, edge, pulse_us FROM pu")
def _(s, d):
    return streams.pulses(streams.states(stream(s, d), 51, 52)).select("session", "time_us", "seq", "edge", "pulse_us")


VOLUME = f"""vo AS (SELECT session, time_us, seq, sum({SCALE} * pow(CAST(pulse_us AS DOUBLE), {EXPONENT}))
    OVER (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS volume FROM pu WHERE edge < 0 AND pulse_us IS NOT NULL
 UNION ALL SELECT session, min(time_us), 0, 0.0 FROM tr GROUP BY session)"""


@query("e10_valve_volume", with_(EV, TRAIN, PULSES, VOLUME) + "SELECT session, time_us, round(volume, 4) AS volume FROM vo")
def _(s, d):
    return streams.valve_volume(stream(s, d), SCALE, EXPONENT).select("session", "time_us", F.round("volume", 4).alias("volume"))


TONE = """tn AS (SELECT session, time_us, row_number() OVER (PARTITION BY session ORDER BY time_us, event, seq) AS seq,
    CASE event WHEN 54 THEN 1 ELSE 0 END AS state FROM ev WHERE event IN (54, 55)),
 tl AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY seq DESC) AS rn FROM tn),
 tc AS (SELECT session, time_us, state FROM tn UNION ALL SELECT session, time_us + 1, 0 FROM tl WHERE rn = 1 AND state = 1)"""


@query("e11_tone_train", with_(EV, TONE) + "SELECT session, time_us, state AS tone_state FROM tc")
def _(s, d):
    return streams.tone(stream(s, d)).select("session", "time_us", "tone_state")


@query(
    "e12_shared_clock",
    with_(EV, TRAIN, PULSES, VOLUME, TONE, "sc AS (SELECT session, time_us FROM vo UNION SELECT session, time_us FROM tc)",
          "v0 AS (SELECT session, arg_min(volume, time_us) AS f FROM vo GROUP BY session)",
          "t0 AS (SELECT session, arg_min(state, time_us) AS f FROM tc GROUP BY session)",
          "a AS (SELECT sc.session, sc.time_us, vo.volume FROM sc ASOF LEFT JOIN vo ON sc.session = vo.session "
          "AND sc.time_us >= vo.time_us)",
          "b AS (SELECT a.*, tc.state FROM a ASOF LEFT JOIN tc ON a.session = tc.session AND a.time_us >= tc.time_us)")
    + "SELECT b.session, b.time_us, round(coalesce(volume, v0.f), 4) AS volume, coalesce(state, t0.f) AS tone_state FROM b "
    "LEFT JOIN v0 USING (session) LEFT JOIN t0 USING (session)",
)
def _(s, d):
    return streams.valve(stream(s, d), SCALE, EXPONENT).select("session", "time_us", F.round("volume", 4).alias("volume"), "tone_state")


@query("e13_never_opened", with_(EV, "cl AS (SELECT * FROM ev WHERE event = 52)")
    + "SELECT session, min(time_us) AS time_us FROM cl WHERE session NOT IN (SELECT session FROM ev WHERE event = 51 "
    "AND session % 5 <> 0) GROUP BY session")
def _(s, d):
    return streams.without_primary(stream(s, d).filter("not (event = 51 and session % 5 = 0)"))


@query("e14_puff_count", with_(EV, TRAIN)
    + "SELECT session, time_us, seq, state AS puff_state, CAST(count(*) FILTER (WHERE fall) OVER (PARTITION BY session "
    "ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS puff_count FROM (SELECT *, state < lag(state) "
    "OVER (PARTITION BY session ORDER BY seq) AS fall FROM tr)")
def _(s, d):
    return streams.gas_puffs(stream(s, d))


@query("e15_lick_threshold", with_(EV)
    + "SELECT session, time_us, seq, value AS voltage, CAST(value >= 50 AS INTEGER) AS lick_state FROM ev WHERE event = 51")
def _(s, d):
    return streams.lick(stream(s, d), 50.0)


@query(
    "e16_signed_torque",
    with_(EV, DIRECTIONS, MISSING,
        "tq AS (SELECT session, time_us, seq, CASE WHEN event = 51 THEN value ELSE -value END * 0.005 AS t FROM mg)",
        "tz AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY seq DESC) AS rn FROM tq)")
    + "SELECT session, time_us, round(t, 7) + 0.0 AS torque FROM tq UNION ALL SELECT session, time_us + 1, 0.0 FROM tz "
    "WHERE rn = 1 AND round(t, 8) <> 0",
)
def _(s, d):
    return streams.torque(_directions(s, d), 0.005).select("session", "time_us", (F.round("torque", 7) + 0.0).alias("torque"))


@query(
    "e17_screen_toggles",
    with_(EV, TRAIN, "ri AS (SELECT session, time_us, seq FROM (SELECT *, lag(state, 1, 0) OVER (PARTITION BY session "
        "ORDER BY seq) AS was FROM tr) WHERE state = 1 AND was = 0)")
    + "SELECT session, time_us, CAST(row_number() OVER (PARTITION BY session ORDER BY seq) % 2 AS INTEGER) AS screen_state "
    "FROM ri UNION ALL SELECT session, min(time_us), 0 FROM tr GROUP BY session",
)
def _(s, d):
    return streams.screen(stream(s, d)).select("session", "time_us", F.col("screen_state").cast("int").alias("screen_state"))


@query(
    "e18_eligible_modules",
    "SELECT c_custkey AS session, 'encoder' AS module FROM customer WHERE c_acctbal > 0 UNION ALL "
    "SELECT c_custkey, 'valve' FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'",
)
def _(s, d):
    hardware = read(s, d, "customer").select(F.col("c_custkey").alias("session"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("cm_per_pulse"),
        (F.col("c_mktsegment") == "BUILDING").alias("has_valve"))
    return streams.eligible_modules(hardware, {"encoder": {"required": ["cm_per_pulse"]},
            "valve": {"required": ["cm_per_pulse"], "flags": ["has_valve"]}})


@query(
    "e19_parse_jobs",
    """WITH m AS (SELECT DISTINCT l_orderkey AS session, l_suppkey % 3 AS controller, CASE WHEN l_linenumber % 2 = 0
    THEN 'valve' ELSE 'lick' END AS module, l_returnflag FROM lineitem),
 f AS (SELECT DISTINCT session, controller, module FROM m WHERE (session, module) IN (SELECT (l_orderkey, CASE
    WHEN l_linenumber % 2 = 0 THEN 'valve' ELSE 'lick' END) FROM lineitem WHERE l_returnflag = 'A')),
 a AS (SELECT l_orderkey AS session, l_suppkey % 3 AS controller, count(*) AS n FROM lineitem GROUP BY ALL),
 j AS (SELECT DISTINCT session, controller, 'extract' AS job_name, CAST(controller AS VARCHAR) AS specifier FROM f UNION ALL
    SELECT session, controller, 'parse', controller || '-' || module FROM f)
 SELECT j.session, j.controller, job_name, specifier, coalesce(n, 0) = 1 AS possible FROM j LEFT JOIN a USING (session, controller)""",
)
def _(s, d):
    line = read(s, d, "lineitem").select(F.col("l_orderkey").alias("session"),
        (F.col("l_suppkey") % 3).alias("controller"), F.when(F.col("l_linenumber") % 2 == 0, "valve").otherwise("lick")
        .alias("module"), "l_returnflag")
    return streams.parse_jobs(line.select("session", "controller", "module").distinct(),
        line.filter("l_returnflag = 'A'").select("session", "module").distinct(), line.select("session", "controller"))


@query("s7_extraction_filter", with_(EV) + "SELECT session, time_us, seq, event, value FROM ev WHERE (session % 2 = 0 "
    "AND event IN (51, 52)) OR (session % 2 = 1 AND event = 60)")
def _(s, d):
    events = stream(s, d).withColumn("module", F.when(F.col("session") % 2 == 0, "valve").otherwise("lick"))
    codes = s.createDataFrame([("valve", 51), ("valve", 52), ("lick", 60)], "module string, event int")
    return streams.extracted(events, codes).drop("module")


# Messages: the first byte is event_id % 6, the second event_id % 251; every 50th message is long.
MSG = "ms AS (SELECT session, time_us, seq, seq % 6 AS first, seq % 251 AS second, seq % 50 = 0 AS long FROM ev)"


def _messages(s, d):
    byte = lambda c: F.unhex(F.lpad(F.hex(c), 2, "0"))
    payload = F.concat(byte(F.col("seq") % 6), byte(F.col("seq") % 251),
        F.when(F.col("seq") % 50 == 0, F.repeat(F.lit("x"), 600)).otherwise("").cast("binary"))
    return stream(s, d).select("session", "time_us", "seq", payload.alias("payload"))


@query("l1_route_messages", with_(EV, MSG)
    + "SELECT seq, CASE WHEN long THEN 'cue_sequence' WHEN first = 1 THEN 'system_state' WHEN first = 2 "
    "THEN 'runtime_state' WHEN first = 3 THEN 'reinforcing_guidance' WHEN first = 4 "
    "THEN 'aversive_guidance' WHEN first = 5 THEN 'distance_snapshot' END AS kind FROM ms")
def _(s, d):
    return runtime_log.routed(_messages(s, d)).select("seq", "kind")


@query("l2_state_table", with_(EV, MSG) + "SELECT session, time_us, seq, CAST(second AS INTEGER) AS state FROM ms WHERE first = 2 AND NOT long")
def _(s, d):
    return runtime_log.state_table(_messages(s, d), "runtime_state")


SNAP = "sn AS (SELECT session, time_us, seq, value AS distance_cm FROM ev WHERE event = 54)"


@query("l3_distance_snapshots", with_(EV) + "SELECT seq, CAST(seq AS DOUBLE) / 4 AS distance_cm FROM ev WHERE event = 54")
def _(s, d):
    """Snapshots with the double seq / 4, spelled byte by byte by its exponent and fraction."""
    import struct

    pack = F.udf(lambda x: b"\x05" + struct.pack("<d", x), "binary")
    rows = stream(s, d).filter("event = 54").select("session", "time_us", "seq", pack(F.col("seq").cast("double") / 4).alias("payload"))
    return runtime_log.snapshots(rows).select("seq", "distance_cm")


@query(
    "l4_corridor_starts",
    with_(EV, SNAP, f"n AS (SELECT *, row_number() OVER ({W}) AS corridor, sum(distance_cm) OVER ({W} ROWS UNBOUNDED PRECEDING) AS upto FROM sn)")
    + "SELECT session, corridor, round(upto - distance_cm, 6) + 0.0 AS start_cm FROM n UNION ALL "
    "SELECT session, max(corridor) + 1, round(max(upto), 6) FROM n GROUP BY session",
)
def _(s, d):
    return runtime_log.corridor_starts(stream(s, d).filter("event = 54").withColumnRenamed("value",
            "distance_cm")).select("session", "corridor", (F.round("start_cm", 6) + 0.0).alias("start_cm"))


@query("l5_trial_geometry",
    "WITH n AS (SELECT l_orderkey AS session, l_linenumber, l_partkey FROM lineitem), t AS (SELECT session, row_number() "
    "OVER (PARTITION BY session ORDER BY l_linenumber, l_partkey) - 1 AS trial_index, l_partkey FROM n) "
    "SELECT session, CAST(trial_index AS INTEGER) AS trial_index, l_partkey AS name, p_retailprice AS length_cm FROM t "
    "LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey")
def _(s, d):
    names = read(s, d, "lineitem").groupBy(F.col("l_orderkey")
        .alias("session")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))),
            lambda x: x["l_partkey"]).alias("names"))
    return runtime_log.trial_geometry(names, read(s, d, "part").filter("p_size > 10")
        .select(F.col("p_partkey").alias("name"), F.col("p_retailprice").alias("length_cm"))).select("session",
        "trial_index", "name", "length_cm")


MOTIFS = [[1, 2, 3], [1, 2], [3], [4, 5]]


@query(
    "l6_cue_motifs",
    """WITH c AS (SELECT l_orderkey AS session, string_agg(CAST((l_partkey + l_linenumber) % 5 + 1 AS VARCHAR), ''
    ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM lineitem GROUP BY 1),
 f AS (SELECT session, t, regexp_extract(t, '^(123|12|45|3)*', 0) AS fit FROM c)
 SELECT session, list_transform(regexp_extract_all(fit, '(123|12|45|3)', 1), lambda x: CAST(list_position(['123', '12', '3', '45'], x) - 1 AS BIGINT)) AS trials, CASE WHEN length(fit) < length(t) THEN CAST(length(fit) AS INTEGER) END AS stop FROM f""",
)
def _(s, d):
    cues = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))),
        lambda x: ((x["l_partkey"] + x["l_linenumber"]) % 5 + 1).cast("int"))
    rows = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("session")).agg(cues.alias("cues"))
    motifs = F.array(*[F.array(*map(F.lit, m)) for m in MOTIFS])
    return runtime_log.decompose(rows.withColumn("seq", F.lit(0)).withColumn("motifs", motifs)).drop("seq")


TRIALS = """tl AS (SELECT l_orderkey AS session, l_suppkey % 2 AS corridor, l_partkey % 4 AS trial, l_quantity + 1 AS length_cm, l_extendedprice,
  row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 2 ORDER BY l_linenumber, l_partkey, l_extendedprice) - 1 AS place FROM lineitem),
 sw AS (SELECT o_orderkey AS session, 0 AS corridor, 30.0 AS swap_cm FROM orders WHERE o_orderkey % 3 = 0),
 le AS (SELECT *, length_cm - CASE WHEN place = 0 THEN 0.5 ELSE 0 END AS len FROM tl),
 ra AS (SELECT *, sum(len) OVER (PARTITION BY session, corridor ORDER BY place ROWS UNBOUNDED PRECEDING) AS e FROM le),
 pl AS (SELECT ra.session, ra.corridor, place, trial, e - len AS start_cm, least(e, swap_cm) AS end_cm,
    coalesce(e > swap_cm, false) AS truncated FROM ra LEFT JOIN sw ON ra.session = sw.session AND ra.corridor = sw.corridor
    WHERE swap_cm IS NULL OR e - len < swap_cm)"""


def _placed(s, d):
    line = read(s, d, "lineitem").select(F.col("l_orderkey").alias("session"), (F.col("l_suppkey") % 2).alias("corridor"),
        (F.col("l_partkey") % 4).alias("trial"), (F.col("l_quantity") + 1).alias("length_cm"),
        F.lit(0.5).alias("offset_cm"), "l_linenumber", "l_partkey", "l_extendedprice")
    parts = parts_for(s, d, "lineitem")
    line = line.repartition(parts, "session", "corridor")
    placed = line.withColumn("place", F.row_number().over(in_order(["session", "corridor"], ["l_linenumber", "l_partkey", "l_extendedprice"])) - 1)
    swaps = read(s, d, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("session"),
        F.lit(0).cast("bigint").alias("corridor"), F.lit(30.0).alias("swap_cm")).repartition(parts, "session", "corridor")
    return runtime_log.place_trials(placed, swaps)


@query("l7_trial_placement", with_(TRIALS)
    + "SELECT session, corridor, place, trial, round(start_cm, 6) AS start_cm, round(end_cm, 6) AS end_cm, truncated "
    "FROM pl")
def _(s, d):
    return _placed(s, d).select("session", "corridor", F.col("place").cast("bigint").alias("place"), "trial",
        F.round("start_cm", 6).alias("start_cm"), F.round("end_cm", 6).alias("end_cm"), "truncated")


@query("l8_sequence_check",
    "WITH c AS (SELECT l_orderkey AS session, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE "
    "l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) SELECT session, a || ' sequences and ' || r || ' snapshots' AS "
    "message FROM c WHERE a = 0 OR (a > 1 AND r <> a - 1)")
def _(s, d):
    counts = read(s, d, "lineitem").groupBy(F.col("l_orderkey")
        .alias("session")).agg(F.count_if(F.col("l_returnflag") == "A").alias("sequences"),
        F.count_if(F.col("l_returnflag") == "R").alias("snapshots"))
    return runtime_log.check_sequences(counts)


@query(
    "l9_cue_onsets",
    with_(TRIALS, "cu AS (SELECT * FROM (VALUES (0, 7, 0.0), (1, 8, 10.0), (2, 9, 25.0)) AS t(cue_place, cue, gap))")
    + "SELECT session, corridor, place, cue_place, cue, round(start_cm + CAST(gap AS DOUBLE), 6) AS distance_cm "
    "FROM pl, cu WHERE NOT truncated OR gap < end_cm - start_cm",
)
def _(s, d):
    cues = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("length_cm")) for c, n in ((7, 10.0), (8, 15.0), (9, 5.0))])
    out = runtime_log.cue_onsets(_placed(s, d).withColumn("cues", cues))
    return out.select("session", "corridor", F.col("place").cast("bigint").alias("place"), "cue_place", "cue",
        F.round("distance_cm", 6).alias("distance_cm"))


@query(
    "l10_trigger_zones",
    with_(TRIALS) + "SELECT session, corridor, place, round(start_cm + 11.5, 6) AS start_cm, round(CASE WHEN 29.5 <= end_cm - start_cm "
    "THEN start_cm + 29.5 ELSE end_cm END, 6) AS end_cm FROM pl WHERE 11.5 <= end_cm - start_cm",
)
def _(s, d):
    zoned = _placed(s, d).withColumns({"zone_start_cm": F.lit(16.0), "zone_end_cm": F.lit(26.0), "entry_cm": F.lit(0.5)})
    return runtime_log.trigger_zones(zoned).select("session", "corridor", F.col("place").cast("bigint").alias("place"),
        F.round("start_cm", 6).alias("start_cm"), F.round("end_cm", 6).alias("end_cm"))


@query("l11_trial_table", with_(TRIALS) + "SELECT session, trial AS trial_type_index, round(start_cm, 6) AS traveled_distance_cm FROM pl")
def _(s, d):
    return runtime_log.trial_table(_placed(s, d)).select("session", "trial_type_index",
        F.round("traveled_distance_cm", 6).alias("traveled_distance_cm"))


@query("b3_run_groups", with_(EV)
    + f"SELECT session, seq, CAST(sum(c) OVER ({W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM (SELECT *, "
    f"CASE WHEN event IS DISTINCT FROM lag(event) OVER ({W}) THEN 1 ELSE 0 END AS c FROM ev)")
def _(s, d):
    return with_runs(stream(s, d), "event").select("session", "seq", "run")
