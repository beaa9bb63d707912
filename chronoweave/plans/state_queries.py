"""Queries of project state, datasets, job graphs and scheduler records."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoweave.functions.ordering import natural_places
from chronoweave.functions.shared import settled
from chronoweave.operators import datasets, graph, scheduler, state
from chronoweave.plans.tables import parts_for, read, with_
from chronoweave.sources import ingest

Q, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


PIPELINES = ["checksum", "runtime", "microcontroller", "video", "two_photon"]
#: Jobs are order lines: the line number gives the pipeline, flag and status the job's status.
JOBS = """jb AS (SELECT o_custkey AS animal, l_orderkey AS session, l_linenumber AS line, l_partkey AS part, l_suppkey AS unit_key, l_quantity, l_extendedprice,
 CASE l_linenumber % 5 WHEN 0 THEN 'checksum' WHEN 1 THEN 'runtime' WHEN 2 THEN 'microcontroller' WHEN 3 THEN 'video'
    ELSE 'two_photon' END AS pipeline,
 CASE WHEN l_returnflag = 'A' THEN 'FAILED' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'RUNNING'
    WHEN l_returnflag = 'R' THEN 'SCHEDULED' ELSE 'SUCCEEDED' END AS status
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _jobs(s, d):
    line, orders = read(s, d, "lineitem"), read(s, d, "orders").select("o_orderkey", "o_custkey")
    pipeline = F.get(F.array(*map(F.lit, PIPELINES)), F.col("l_linenumber") % 5)
    status = F.when(F.col("l_returnflag") == "A", "FAILED").when((F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "O"), "RUNNING").when(F.col("l_returnflag") == "R",
        "SCHEDULED").otherwise("SUCCEEDED")
    parts = parts_for(s, d, "lineitem")
    line, orders = line.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("animal"), F.col("l_orderkey").alias("session"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("unit_key"),
        "l_quantity", "l_extendedprice", pipeline.alias("pipeline"), status.alias("status"),
    )


def _sessions(s, d):
    return read(s, d, "orders").select(F.col("o_custkey").alias("animal"), F.col("o_orderkey").alias("session"),
        F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("system"), "o_totalprice")


ROLLUP = ", ".join(f"coalesce(CAST(bool_and(CASE WHEN pipeline = '{p}' THEN status = 'SUCCEEDED' END) AS INTEGER), 0) AS {p}" for p in PIPELINES)
MANIFEST = (
    "mf AS (SELECT o_custkey AS animal, o_orderkey AS session, o_orderstatus AS type, "
    + ", ".join(f"coalesce({p}, 0) AS {p}" for p in PIPELINES)
    + f" FROM orders LEFT JOIN (SELECT session, {ROLLUP} FROM jb GROUP BY session) r ON r.session = o_orderkey "
    f"WHERE o_totalprice > 1000)"
)


def _manifest(s, d):
    sessions = _sessions(s, d)
    return state.manifest(sessions.drop("system", "o_totalprice"), _jobs(s, d), sessions.filter("o_totalprice > 1000"), PIPELINES)


@query("m1_manifest", with_(JOBS, MANIFEST) + "SELECT * FROM mf")
def _(s, d):
    return _manifest(s, d)


@query("m2_pipeline_rollup", with_(JOBS) + f"SELECT animal, session, {ROLLUP} FROM jb GROUP BY animal, session")
def _(s, d):
    return state.pipeline_rollup(_jobs(s, d), PIPELINES)


@query("m3_job_listing_natural", with_(JOBS) + "SELECT 'job' || line AS job_name, session, status FROM jb")
def _(s, d):
    rows = _jobs(s, d).withColumn("job_name", F.concat(F.lit("job"), "line")).withColumn("name", F.col("session").cast("string"))
    return state.job_listing(rows, ["job_name", "session", "status", "name"], ["name", "job_name"]).drop("name")


@query("m4_dataset_state",
    "SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'discover' ELSE 'extract' END AS job_name, CASE WHEN n_nationkey % 2 = 0 "
    "THEN 'animal' ELSE 'session' END AS scope, CASE WHEN n_nationkey % 2 = 0 THEN n_name "
    "ELSE 'region' || n_regionkey END AS animal, CASE WHEN n_nationkey % 2 = 1 THEN n_name END AS session FROM nation")
def _(s, d):
    nation = read(s, d, "nation")
    jobs = nation.select(F.when(F.col("n_nationkey") % 2 == 0, "discover").otherwise("extract").alias("job_name"), F.col("n_name").alias("specifier"))
    scopes = s.createDataFrame([("discover", "animal"), ("extract", "session")], "job_name string, scope string")
    animals = nation.select(F.col("n_name").alias("session"), F.concat(F.lit("region"), "n_regionkey").alias("animal"))
    return state.job_rows(jobs, scopes, animals).select("job_name", "scope", "animal", "session")


@query("m5_natural_order", "SELECT 'c' || c_custkey AS name, row_number() OVER (ORDER BY c_custkey) AS place FROM customer")
def _(s, d):
    return natural_places(read(s, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("name")), "name")


MARKERS = (
    "mk AS (SELECT 'dataset' AS kind, 'd' || n_nationkey AS dataset, NULL AS animal, NULL AS session FROM nation "
    "WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'session', NULL, 'd' || (c_custkey % 25), 's' || c_custkey FROM customer "
    "WHERE c_custkey % 25 % 5 <> 0)"
)


def _markers(s, d):
    """Every nation is a folder, every fifth one with a dataset's marker; customers are sessions below animals, those below a dataset drop out."""
    marker = F.when(F.col("n_nationkey") % 5 == 0, "/dataset.yaml").otherwise("/notes.yaml")
    sets = read(s, d, "nation").select(F.concat(F.lit("d"), "n_nationkey", marker).alias("path"))
    runs = read(s, d, "customer").select(F.concat(F.lit("d"), F.col("c_custkey") % 25, F.lit("/s"), "c_custkey",
            F.lit("/raw/session.yaml")).alias("path"))
    return ingest.markers(sets.union(runs), "dataset.yaml", "session.yaml")


@query("d10_existing_datasets", with_(MARKERS) + "SELECT dataset FROM mk WHERE kind = 'dataset'")
def _(s, d):
    return datasets.existing(_markers(s, d))


UNITS = (
    "ut AS (SELECT kind AS unit_kind, dataset, animal, session, CASE WHEN kind = 'dataset' THEN dataset "
    "ELSE animal || '/' || session END AS unit_path FROM mk)"
)


@query("m26_discovery_counts", with_(MARKERS, UNITS)
    + "SELECT 'unit_kind' AS axis, unit_kind AS value, count(*) AS count FROM ut GROUP BY 2 UNION ALL "
    "SELECT 'animal', coalesce(animal, 'none'), count(*) FROM ut GROUP BY 2 UNION ALL "
    "SELECT 'dataset', coalesce(dataset, 'none'), count(*) FROM ut GROUP BY 2")
def _(s, d):
    return state.staged_read(state.discovered_units(_markers(s, d)), ["unit_kind", "animal", "dataset"])[0]


@query("m26_discovery_units", with_(MARKERS, UNITS) + "SELECT * FROM ut WHERE animal IN ('d1', 'd2', 'd3')")
def _(s, d):
    return state.staged_read(state.discovered_units(_markers(s, d)), ["unit_kind"], {"animal": ["d1", "d2", "d3"]}, ["unit_path"], length=0)[1]


BATCHES = """bj AS (SELECT animal % 50 AS batch_id, pipeline, CASE WHEN animal % 2 = 0 THEN 'local' ELSE 'remote' END AS host, unit_key AS unit,
    session * 10 + line AS job_id, status = 'SCHEDULED' AND part % 2 = 0 AS blocked, status, CAST(l_quantity AS BIGINT) AS cores,
    CAST(floor(l_extendedprice) AS BIGINT) AS memory_mb, CAST(floor(l_extendedprice / 2) AS BIGINT) AS resident_mb FROM jb),
 bo AS (SELECT batch_id, min(host) AS host, count(*) FILTER (WHERE status = 'SUCCEEDED') AS succeeded,
    count(*) FILTER (WHERE status = 'FAILED') AS failed, count(*) FILTER (WHERE blocked) AS blocked, count(*) FILTER (WHERE status NOT IN
    ('SUCCEEDED', 'FAILED') AND NOT blocked) AS outstanding FROM bj WHERE batch_id % 3 = 0 GROUP BY batch_id),
 pb AS (SELECT batch_id, host, CAST(NULL AS BIGINT) AS unit_count, succeeded + failed + blocked + outstanding AS job_count,
    blocked AS blocked_count, true AS outcome_recorded FROM bo UNION ALL SELECT batch_id, min(host), count(DISTINCT unit), count(*),
    count(*) FILTER (WHERE blocked), false FROM bj WHERE batch_id % 3 <> 0 GROUP BY batch_id)"""


def _batch_jobs(s, d):
    return _jobs(s, d).select((F.col("animal") % 50).alias("batch_id"), "pipeline",
        F.when(F.col("animal") % 2 == 0, "local").otherwise("remote").alias("host"), F.col("unit_key").alias("unit"),
        (F.col("session") * 10 + F.col("line")).alias("job_id"), ((F.col("status") == "SCHEDULED") & (F.col("part") % 2 == 0)).alias("blocked"),
        "status", F.col("l_quantity").cast("bigint").alias("cores"), F.floor("l_extendedprice").alias("memory_mb"),
        F.floor(F.col("l_extendedprice") / 2).alias("resident_mb"))


def _prepared(s, d):
    jobs = _batch_jobs(s, d)
    open_ = ~F.col("status").isin("SUCCEEDED", "FAILED") & ~F.col("blocked")
    outcomes = jobs.filter("batch_id % 3 = 0").groupBy("batch_id").agg(F.min("host").alias("host"), *[F.count_if(c).alias(n) for n, c in (
        ("succeeded", F.col("status") == "SUCCEEDED"), ("failed", F.col("status") == "FAILED"), ("blocked", F.col("blocked")), ("outstanding", open_))])
    return state.prepared_batches(jobs, outcomes)


@query("m26_prepared_batches", with_(JOBS, BATCHES) + "SELECT * FROM pb")
def _(s, d):
    """Batches that were prepared, a settled one under its outcome."""
    return _prepared(s, d)


@query("m26_prepared_counts", with_(JOBS, BATCHES) + "SELECT 'host' AS axis, host AS value, count(*) AS count FROM pb GROUP BY 2 UNION ALL "
    "SELECT 'outcome_recorded', CAST(outcome_recorded AS VARCHAR), count(*) FROM pb GROUP BY 2")
def _(s, d):
    return state.staged_read(_prepared(s, d), ["host", "outcome_recorded"])[0]


@query("m26_prepared_on_one_host", with_(JOBS, BATCHES) + "SELECT * FROM pb WHERE host = 'remote' ORDER BY batch_id LIMIT 10 OFFSET 5")
def _(s, d):
    """The second page of ten; a page is a listing by nature."""
    return state.staged_read(_prepared(s, d), ["host"], {"host": ["remote"]}, ["batch_id"], 5, 10)[1]


@query("m26_resource_totals", with_(JOBS, BATCHES) + "SELECT batch_id, count(*) AS jobs, max(cores) AS widest_job_cores, max(memory_mb) AS "
    "largest_job_memory_mb, CAST(sum(memory_mb) AS BIGINT) AS summed_memory_mb, max(resident_mb) AS largest_job_resident_mb, "
    "CAST(sum(resident_mb) AS BIGINT) AS summed_resident_mb FROM bj WHERE status <> 'SUCCEEDED' AND NOT blocked GROUP BY batch_id")
def _(s, d):
    return state.resource_totals(state.outstanding_jobs(_batch_jobs(s, d)), ["batch_id"])


@query("m26_resource_units", with_(JOBS, BATCHES) + "SELECT batch_id, unit, count(*) FILTER (WHERE status <> 'SUCCEEDED' AND NOT blocked) AS jobs "
    "FROM bj GROUP BY ALL")
def _(s, d):
    """Every named unit and how many jobs it still has to run, none too."""
    jobs = _batch_jobs(s, d)
    return state.resource_units(jobs.select("batch_id", "unit").distinct(), state.outstanding_jobs(jobs))


LOCAL = """lj AS (SELECT o_orderkey AS job_id, o_custkey % 20 AS batch_id, ['SUCCEEDED', 'FAILED', 'RUNNING', 'SCHEDULED'][o_custkey % 4 + 1] AS status,
    o_orderkey % 8 = 3 AS blocked, CAST(floor(o_totalprice) AS BIGINT) AS took FROM orders)"""


def _local(s, d):
    """Orders as jobs of batches, and what their trackers recorded: nothing of a job that is only scheduled."""
    rows = read(s, d, "orders").select(F.col("o_orderkey").alias("job_id"), (F.col("o_custkey") % 20).alias("batch_id"),
        F.get(F.array(*map(F.lit, ("SUCCEEDED", "FAILED", "RUNNING", "SCHEDULED"))), (F.col("o_custkey") % 4).cast("int")).alias("status"),
        (F.col("o_orderkey") % 8 == 3).alias("blocked"), F.floor("o_totalprice").alias("took"))
    ended = F.when(F.col("status") != "RUNNING", F.col("job_id") + F.col("took") * 1000)
    records = rows.filter("status <> 'SCHEDULED'").select("job_id", "status", F.col("job_id").alias("started_at"), ended.alias("completed_at"))
    return state.local_jobs(rows, records, 1_800_000_000_000_000)


@query("m26_local_summary", with_(LOCAL) + "SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE status = 'SUCCEEDED') AS succeeded, "
    "count(*) FILTER (WHERE status = 'FAILED') AS failed, count(*) FILTER (WHERE status = 'RUNNING') AS running, "
    "count(*) FILTER (WHERE status = 'SCHEDULED') AS scheduled, count(*) FILTER (WHERE blocked) AS blocked_jobs FROM lj GROUP BY 1")
def _(s, d):
    return state.local_summary(_local(s, d))


@query("m26_local_jobs", with_(LOCAL) + "SELECT batch_id, job_id, lower(status) AS status, CASE WHEN status = 'RUNNING' "
    "THEN round_even((1800000000000000 - job_id) / 1e6, 3) ELSE round_even(took * 1000 / 1e6, 3) END AS elapsed_seconds "
    "FROM lj WHERE status IN ('FAILED', 'RUNNING')")
def _(s, d):
    page = state.staged_read(_local(s, d), ["status"], {"status": ["failed", "running"]}, ["job_id"], length=0)[1]
    return page.select("batch_id", "job_id", "status", "elapsed_seconds")


PLAN = """pn AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'session' ELSE 'dataset' END AS unit_kind, CASE l_linenumber % 5
    WHEN 0 THEN 'checksum' WHEN 1 THEN 'runtime' WHEN 2 THEN 'microcontroller' WHEN 3 THEN 'video' ELSE 'two_photon' END AS pipeline,
 l_suppkey AS unit, CAST(l_quantity AS BIGINT) AS cores, CAST(floor(l_extendedprice) AS BIGINT) AS memory_mb,
    CAST(floor(l_extendedprice / 2) AS BIGINT) AS resident_mb, l_partkey % 3 AS model_version FROM lineitem)"""


def _plan(s, d):
    line = read(s, d, "lineitem")
    return line.select(
        F.when(F.col("l_linestatus") == "F", "session").otherwise("dataset").alias("unit_kind"),
        F.get(F.array(*map(F.lit, PIPELINES)), F.col("l_linenumber") % 5).alias("pipeline"),
        F.col("l_suppkey").alias("unit"),
        F.col("l_quantity").cast("bigint").alias("cores"), F.floor("l_extendedprice").alias("memory_mb"),
        F.floor(F.col("l_extendedprice") / 2).alias("resident_mb"), (F.col("l_partkey") % 3).alias("model_version"),
    )


@query("m6_project_plan", with_(PLAN) + "SELECT * FROM pn WHERE model_version = 2")
def _(s, d):
    plan = _plan(s, d)
    return state.project_plan([plan.filter("unit_kind = 'session'"), plan.filter("unit_kind = 'dataset'")], 2)


@query("m7_animals", "SELECT DISTINCT o_custkey AS animal FROM orders")
def _(s, d):
    return state.animals_of(_sessions(s, d))


@query("m8_sessions_of_animal", with_(JOBS, MANIFEST) + "SELECT animal, session FROM mf WHERE runtime = 1 AND video = 1")
def _(s, d):
    """Of all animals; one animal is a filter of its own, as in the summary view."""
    return state.sessions_of(_manifest(s, d), complete=["runtime", "video"])


@query("m9_point_lookup", "SELECT o_orderkey AS session, o_custkey AS animal, o_orderpriority AS system FROM orders WHERE o_orderkey = 4242")
def _(s, d):
    return state.lookup(_sessions(s, d), 4242, ["session", "animal", "system"])


@query(
    "m10_summary",
    with_(JOBS, MANIFEST) + "SELECT 'rows' AS axis, 'all' AS value, count(*) AS count FROM mf UNION ALL "
    "SELECT 'animals', 'distinct', count(DISTINCT animal) FROM mf UNION ALL SELECT 'type', type, count(*) FROM mf "
    "GROUP BY type"
    + "".join(f" UNION ALL SELECT '{p}', 'done', CAST(sum({p}) AS BIGINT) FROM mf UNION ALL "
        f"SELECT '{p}', 'open', CAST(sum(1 - {p}) AS BIGINT) FROM mf" for p in PIPELINES),
)
def _(s, d):
    return state.summary(_manifest(s, d), PIPELINES, ["type"])


@query("m11_session_index",
    "SELECT o_custkey AS animal, o_orderkey AS session, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderkey) AS index FROM orders")
def _(s, d):
    rows = _sessions(s, d).select("animal", "session", F.concat(F.lit("s"), "session").alias("name"))
    return state.ranked(rows, "name", ["animal"]).drop("name")


@query("m12_summary_view", with_(JOBS, MANIFEST) + "SELECT session, type, video FROM mf WHERE animal = 10")
def _(s, d):
    return state.view(_manifest(s, d), 10, ["session", "type", "video"])


@query("m13_breakdown", with_(JOBS)
    + "SELECT 'pipeline' AS axis, pipeline AS value, count(*) AS count FROM jb GROUP BY pipeline UNION ALL "
    "SELECT 'status', status, count(*) FROM jb GROUP BY status UNION ALL SELECT 'animal', NULL, count(DISTINCT animal) "
    "FROM jb")
def _(s, d):
    return state.breakdown(_jobs(s, d), ["pipeline", "status", "animal"])


@query("m14_unknown_values",
    "SELECT v AS value, (SELECT list(DISTINCT o_orderstatus ORDER BY o_orderstatus) FROM orders) AS known, "
    "(SELECT count(DISTINCT o_orderstatus) FROM orders) AS known_values FROM (VALUES ('X'), ('Y')) t(v)")
def _(s, d):
    return state.unknown_values(_sessions(s, d), "type", ["F", "X", "Y"])


@query("m14_unknown_values_of_many",
    "SELECT v AS value, (SELECT list(k ORDER BY k) FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders ORDER BY k LIMIT 50)) AS known, "
    "(SELECT count(DISTINCT o_orderkey) FROM orders) AS known_values FROM (VALUES ('none')) t(v)")
def _(s, d):
    """A column with as many values as rows: the first 50 are listed."""
    return state.unknown_values(_sessions(s, d), "session", ["none"])


@query("m15_page", "SELECT o_orderkey AS session FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def _(s, d):
    """A page is a listing by nature: its length is the feature."""
    return state.page(_sessions(s, d).select("session"), ["session"], 100, 50)


@query("m16_manifest_jobs", with_(JOBS, MANIFEST)
    + "SELECT mf.session, mf.type, pipeline, status, count(*) AS jobs FROM mf JOIN jb ON mf.animal = jb.animal "
    "AND mf.session = jb.session GROUP BY ALL")
def _(s, d):
    return state.with_jobs(_manifest(s, d).select("animal", "session", "type"), _jobs(s, d)).groupBy("session", "type",
        "pipeline", "status").agg(F.count(F.lit(1)).alias("jobs"))


@query("m17_without_empty",
    "SELECT CASE WHEN n_nationkey % 2 = 0 THEN '{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' "
    "ELSE '{\"key\":' || n_nationkey || '}' END AS record FROM nation")
def _(s, d):
    return state.without_empty(read(s, d, "nation").select(F.col("n_nationkey").alias("key"),
            F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("").alias("name")))


@query("m18_filtered_listing", with_(JOBS)
    + "SELECT session, line, pipeline, status FROM jb WHERE status IN ('FAILED', 'RUNNING') AND pipeline = 'video'")
def _(s, d):
    return state.listing(_jobs(s, d).select("session", "line", "pipeline", "status"),
        {"status": ["FAILED", "RUNNING"], "pipeline": ["video"]}, ["session", "line"], 0, 0)


@query("m19_dataset_listing",
    "SELECT l_suppkey AS dataset, count(DISTINCT l_orderkey) AS sessions, count(DISTINCT l_orderkey % 97) AS animals "
    "FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_orderkey % 97 = 5) GROUP BY 1")
def _(s, d):
    members = read(s, d, "lineitem").select(F.col("l_suppkey").alias("dataset"),
        (F.col("l_orderkey") % 97).alias("animal"), F.col("l_orderkey").alias("session"))
    return state.dataset_listing(members, animal=5)


@query("m20_session_date", "SELECT o_orderkey AS session, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS date FROM orders")
def _(s, d):
    name = F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd-HH-mm-ss")).otherwise("broken")
    return read(s, d, "orders").select(F.col("o_orderkey").alias("session"), state.session_date(name).cast("timestamp_ntz").alias("date"))


@query("m21_elapsed_seconds",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE round_even((CASE WHEN event_id % 3 = 0 "
    "THEN 1800000000000000 ELSE epoch_us(ts) + event_id * 1000 END - epoch_us(ts)) / 1e6, 3) END AS seconds FROM events")
def _(s, d):
    from chronoweave.plans.tables import micros

    rows = read(s, d, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, micros("ts")).alias("a"),
        F.when(F.col("event_id") % 3 != 0, micros("ts") + F.col("event_id") * 1000).alias("b"))
    return rows.select("event_id", state.elapsed_seconds(F.col("a"), F.col("b"), 1_800_000_000_000_000).alias("seconds"))


@query("m22_batch_status", "SELECT o_custkey % 20 AS batch_id, coalesce(CASE WHEN o_orderkey % 3 > 0 "
    "THEN o_orderstatus END, 'SCHEDULED') AS status, count(*) AS jobs FROM orders GROUP BY ALL")
def _(s, d):
    orders = read(s, d, "orders").select((F.col("o_custkey") % 20).alias("batch_id"), F.col("o_orderkey").alias("job_id"),
        F.col("o_orderstatus").alias("status"))
    return state.batch_status(orders.drop("status"), orders.filter("job_id % 3 > 0")).groupBy("batch_id",
        "status").agg(F.count(F.lit(1)).alias("jobs"))


@query("m23_plan_totals", with_(PLAN)
    + "SELECT count(*) AS jobs, CAST(sum(memory_mb) AS BIGINT) AS sum_memory_mb, max(memory_mb) AS max_memory_mb, "
    "CAST(sum(resident_mb) AS BIGINT) AS sum_resident_mb, max(resident_mb) AS max_resident_mb, max(cores) AS max_cores "
    "FROM pn")
def _(s, d):
    return state.plan_totals(_plan(s, d))


@query("m24_plan_breakdown", with_(PLAN)
    + "SELECT unit_kind, pipeline, count(*) AS jobs, CAST(sum(memory_mb) AS BIGINT) AS memory_mb, CAST(sum(resident_mb) AS "
    "BIGINT) AS resident_mb, max(cores) AS cores FROM pn GROUP BY ALL")
def _(s, d):
    return state.plan_breakdown(_plan(s, d))


@query("m25_planned_units", with_(PLAN)
    + "SELECT p_partkey AS unit, jobs, memory_mb, resident_mb, CASE WHEN jobs IS NULL "
    "THEN 'no job is planned for this unit' END AS reason FROM part LEFT "
    "JOIN (SELECT unit, count(*) AS jobs, CAST(sum(memory_mb) AS BIGINT) AS memory_mb, CAST(sum(resident_mb) AS BIGINT) "
    "AS resident_mb FROM pn GROUP BY unit) ON unit = p_partkey")
def _(s, d):
    return state.planned_units(read(s, d, "part").select(F.col("p_partkey").alias("unit")), _plan(s, d))


POLICY = [("F", "video"), ("F", "runtime"), ("O", "checksum")]
NEED = """po AS (SELECT * FROM (VALUES ('F', 'video'), ('F', 'runtime'), ('O', 'checksum')) t(type, pipeline)),
 ne AS (SELECT o_custkey AS animal, o_orderkey AS session, po.pipeline, (SELECT count(*) FROM jb
    WHERE jb.session = o_orderkey AND jb.pipeline = po.pipeline) AS n, (SELECT count(*) FROM jb WHERE jb.session = o_orderkey
    AND jb.pipeline = po.pipeline AND status = 'SUCCEEDED') AS k FROM orders JOIN po ON po.type = o_orderstatus),
 ou AS (SELECT animal, session, list(pipeline || ': ' || k || ' of ' || n ORDER BY pipeline) AS outstanding FROM ne
    WHERE n = 0 OR k < n GROUP BY ALL UNION ALL SELECT o_custkey, o_orderkey, NULL FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))"""


@query("d1_admission", with_(JOBS, NEED) + "SELECT * FROM ou")
def _(s, d):
    return datasets.outstanding(_sessions(s, d).select("animal", "session", "type"),
        s.createDataFrame(POLICY, "type string, pipeline string"), _jobs(s, d))


@query("d1_admitted", with_(JOBS, NEED)
    + "SELECT o_custkey AS animal, o_orderkey AS session, o_orderstatus AS type FROM orders "
    "WHERE o_orderkey NOT IN (SELECT session FROM ou)")
def _(s, d):
    return datasets.admitted(_sessions(s, d).select("animal", "session", "type"),
        s.createDataFrame(POLICY, "type string, pipeline string"), _jobs(s, d))


@query("d2_homogeneous", "WITH m AS (SELECT o_custkey AS dataset, o_orderkey AS session, o_orderstatus AS type, o_orderpriority AS system "
    "FROM orders), f AS (SELECT dataset, arg_min(type, session) AS t, arg_min(system, session) AS s FROM m GROUP BY 1) "
    "SELECT m.dataset, session, type, system FROM m JOIN f USING (dataset) WHERE type <> t OR system <> s")
def _(s, d):
    members = _sessions(s, d).select(F.col("animal").alias("dataset"), "session", "type", "system", F.col("session").alias("position"))
    return datasets.unlike_first(members).drop("position")


@query("d3_name_resolution",
    "WITH r AS (SELECT 'p' || (l_partkey % 500) AS name, min(l_orderkey * 10 + l_linenumber) AS position FROM lineitem "
    "GROUP BY 1), f AS (SELECT 'p' || (p_partkey % 700) AS name, count(*) AS n, min(p_name) AS path FROM part "
    "GROUP BY 1) SELECT name, position, coalesce(n, 0) AS matches, CASE WHEN n = 1 THEN path END AS path FROM r LEFT "
    "JOIN f USING (name)")
def _(s, d):
    requests = read(s, d, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey") % 500).alias("name"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"))
    found = read(s, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey") % 700).alias("name"), F.col("p_name").alias("path"))
    return datasets.resolved_names(requests, found)


@query("d4_membership_changes",
    "SELECT o_custkey AS animal, o_orderkey AS session, CASE WHEN o_custkey % 4 = 0 THEN 'refused' "
    "ELSE 'add' END AS change FROM orders WHERE o_orderkey % 3 <> 0")
def _(s, d):
    sessions = _sessions(s, d).select("animal", "session")
    return datasets.membership_changes(sessions.filter("session % 3 = 0"), sessions, sessions.filter("animal % 4 = 0"))


@query("d4_repeated_requests", "SELECT o_custkey AS animal, count(*) AS times FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(s, d):
    return datasets.repeated(_sessions(s, d), "animal")


@query("d5_latest_session", "SELECT o_custkey AS animal, 's' || max(o_orderkey) AS session FROM orders GROUP BY 1")
def _(s, d):
    return datasets.latest_per_animal(_sessions(s, d).select("animal", F.concat(F.lit("s"), "session").alias("session")))


MEMBERS = (
    "mb AS (SELECT DISTINCT l_suppkey AS dataset, o_custkey AS animal, l_orderkey AS session FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey)"
)
UNIVERSE = (
    "un AS (SELECT DISTINCT dataset, animal, CAST(NULL AS BIGINT) AS session, 'discover' AS job_name FROM mb UNION ALL "
    "SELECT dataset, animal, session, unnest(['extract', 'assemble']) FROM mb)"
)


def _members(s, d):
    return _jobs(s, d).select(F.col("unit_key").alias("dataset"), "animal", "session").distinct()


@query("d6_universe", with_(MEMBERS, UNIVERSE) + "SELECT * FROM un")
def _(s, d):
    return datasets.universe(_members(s, d), parts_for(s, d, "lineitem"))


@query("d7_job_edges", with_(MEMBERS, UNIVERSE)
    + "SELECT dataset, animal, session, job_name, CASE job_name WHEN 'extract' THEN 'discover' ELSE 'extract' END AS needs "
    "FROM un WHERE job_name <> 'discover'")
def _(s, d):
    parts = parts_for(s, d, "lineitem")
    return datasets.job_edges(datasets.universe(settled(_members(s, d)), parts), parts).select("dataset", "animal", "session", "job_name", "needs")


@query("d8_outstanding_jobs", with_(JOBS)
    + "SELECT DISTINCT session, line FROM jb WHERE (session, line) NOT IN (SELECT (session, line) FROM jb "
    "WHERE status = 'SUCCEEDED')")
def _(s, d):
    jobs = _jobs(s, d)
    return datasets.not_succeeded(jobs.select("session", "line").distinct(), jobs, ["session", "line"])


@query("d9_reset", with_(JOBS) + "SELECT session, line, part, CASE WHEN animal % 10 = 0 THEN 'SCHEDULED' ELSE status END AS status FROM jb")
def _(s, d):
    jobs = _jobs(s, d)
    return datasets.reset(jobs, jobs.filter("animal % 10 = 0"), ["animal"]).select("session", "line", "part", "status")


@query("d11_camera_jobs", "WITH c AS (SELECT DISTINCT l_orderkey AS session, l_linenumber AS camera "
    "FROM lineitem), a AS (SELECT l_orderkey AS session, l_linenumber AS camera, count(*) AS n FROM lineitem "
    "WHERE l_returnflag <> 'A' GROUP BY ALL), p AS (SELECT DISTINCT l_orderkey AS session, l_linenumber AS camera "
    "FROM lineitem WHERE l_linestatus = 'F') SELECT c.session, c.camera, 'clock' AS job_name, coalesce(n, 0) = 1 AS "
    "possible FROM c LEFT JOIN a USING (session, camera) UNION ALL "
    "SELECT c.session, c.camera, 'pose', p.session IS NOT NULL FROM c LEFT JOIN p USING (session, camera)")
def _(s, d):
    line = read(s, d, "lineitem").select(F.col("l_orderkey").alias("session"), F.col("l_linenumber").alias("camera"), "l_returnflag", "l_linestatus")
    return datasets.camera_jobs(line.select("session", "camera").distinct(), line.filter("l_returnflag <> 'A'"), line.filter("l_linestatus = 'F'"))


@query("d12_merged_membership",
    "SELECT o_custkey AS animal, o_orderkey AS session, o_custkey IN (SELECT o_custkey FROM orders "
    "WHERE o_orderkey % 5 IN (1, 3) UNION SELECT o_custkey FROM orders WHERE o_orderkey % 50 = 2) AS build FROM orders")
def _(s, d):
    rows = _sessions(s, d).select("animal", "session")
    return datasets.merged_membership(rows.filter("session % 5 in (0, 2, 4)"), rows, rows.filter("session % 50 = 2"))


@query("s14_first_file", "SELECT o_custkey AS animal, 'f' || min(o_orderkey) AS path FROM orders GROUP BY 1")
def _(s, d):
    return datasets.first_in_order(_sessions(s, d).select("animal", F.concat(F.lit("f"), "session").alias("path")), ["animal"])


# Job n of an order needs the jobs n - 1 and n - 2.
LINES = (
    "ln AS (SELECT l_orderkey * 10 + l_linenumber AS job_id, l_orderkey AS unit, min(l_linenumber) AS line, max(CASE "
    "WHEN l_returnflag = 'N' THEN 'SUCCEEDED' WHEN l_returnflag = 'A' THEN 'FAILED' "
    "ELSE 'SCHEDULED' END) AS status, CAST(sum(l_quantity) AS BIGINT) AS cores FROM lineitem GROUP BY ALL)"
)
EDGES = "ed AS (SELECT job_id, job_id - k AS needs FROM ln, (VALUES (1), (2)) t(k) WHERE line - k >= 1)"


def _lines(s, d):
    status = F.when(F.col("l_returnflag") == "N", "SUCCEEDED").when(F.col("l_returnflag") == "A", "FAILED").otherwise("SCHEDULED")
    rows = read(s, d, "lineitem")
    # Grouped by what makes the id, which is half as wide.
    lines = rows.groupBy(F.col("l_orderkey").alias("unit"), F.col("l_linenumber").alias("line")).agg(F.max(status).alias("status"),
        F.sum("l_quantity").cast("bigint").alias("cores"))
    return lines.select((F.col("unit") * 10 + F.col("line")).alias("job_id"), "unit", "line", "status", "cores")


def _edges(jobs):
    return jobs.select("job_id", "line", F.explode(F.array(F.lit(1), F.lit(2)))
        .alias("k")).filter("line - k >= 1").select("job_id", (F.col("job_id") - F.col("k")).alias("needs"))


@query(
    "g1_batch_document",
    with_(LINES) + """, u AS (SELECT DISTINCT o_orderkey AS unit FROM orders), t AS (SELECT u.unit, job_id, status FROM u
    LEFT JOIN ln USING (unit)), op AS (SELECT t.unit, t.job_id, t.status, CASE WHEN ln.line <= 4 THEN
    CAST(ln.cores AS INTEGER) END AS cores, CASE WHEN ln.line <= 4 THEN ln.cores * 100 END AS memory_mb FROM t
    JOIN ln ON t.job_id = ln.job_id WHERE t.status <> 'SUCCEEDED'),
 un AS (SELECT unit, count(*) FILTER (WHERE cores IS NULL) AS n FROM op GROUP BY unit)
 SELECT op.*, CASE WHEN n > 0 THEN 'jobs without a plan' END AS reason FROM op JOIN un USING (unit) UNION ALL SELECT unit, NULL, NULL, NULL, NULL, 'no job state' FROM t WHERE job_id IS NULL""",
)
def _(s, d):
    jobs = _lines(s, d)
    units = read(s, d, "orders").select(F.col("o_orderkey").alias("unit"))
    plan = jobs.filter("line <= 4").select("unit", "job_id", F.col("cores").cast("int").alias("cores"), (F.col("cores") * 100).alias("memory_mb"))
    return graph.batch_document(units, jobs.select("unit", "job_id", "status"), plan)


@query("g2_narrowed_edges", with_(LINES, EDGES)
    + "SELECT unit, ln.job_id, coalesce((SELECT list(needs ORDER BY needs) FROM ed WHERE ed.job_id = ln.job_id "
    "AND needs IN (SELECT job_id FROM ln)), []) AS prerequisites FROM ln")
def _(s, d):
    jobs = _lines(s, d)
    return graph.narrowed(jobs.select("unit", "job_id", F.array(F.col("job_id") - 1, F.col("job_id") - 2).alias("prerequisites")))


HERE = "hr AS (SELECT *, status <> 'FAILED' AND line < 7 AS here FROM ln)"
BLOCKED = """RECURSIVE_MARK bk(job_id) AS (SELECT ed.job_id FROM ed JOIN hr ON hr.job_id = ed.job_id AND hr.here LEFT
    JOIN hr n ON n.job_id = needs WHERE n.job_id IS NULL OR (NOT n.here AND n.status <> 'SUCCEEDED')
 UNION SELECT ed.job_id FROM bk JOIN ed ON ed.needs = bk.job_id JOIN hr ON hr.job_id = ed.job_id AND hr.here)"""


@query("g3_blocked_jobs", ("WITH RECURSIVE " + ",\n".join([LINES, EDGES, HERE, BLOCKED.replace("RECURSIVE_MARK ", "")]))
    + " SELECT DISTINCT job_id FROM bk")
def _(s, d):
    jobs = settled(_lines(s, d))
    return graph.blocked(jobs.withColumn("here", (F.col("status") != "FAILED") & (F.col("line") < 7)), _edges(jobs)).select("job_id")


WEIGHT_SQL = ("WITH RECURSIVE " + ",\n".join([LINES, EDGES,
            "cl(job_id, behind) AS (SELECT needs, job_id FROM ed UNION SELECT cl.job_id, ed.job_id FROM cl "
            "JOIN ed ON ed.needs = cl.behind)"])
    + " SELECT ln.job_id, CAST(coalesce((SELECT sum(b.cores) FROM cl JOIN ln b ON b.job_id = behind "
    "WHERE cl.job_id = ln.job_id), 0) AS BIGINT) AS weight FROM ln")


@query("g4_downstream_weight", WEIGHT_SQL)
def _(s, d):
    jobs = settled(_lines(s, d))
    return graph.downstream_weight(jobs, _edges(jobs), "unit")


@query("g4_downstream_weight_by_joins", WEIGHT_SQL)
def _(s, d):
    """The way of units that are too large for one task: all pairs of the closure."""
    jobs = settled(_lines(s, d).select("job_id", "line", "cores"))
    return graph.downstream_weight(jobs, _edges(jobs))


@query("g5_depth_order", "WITH RECURSIVE " + ",\n".join([LINES, EDGES,
            "inn AS (SELECT * FROM ed WHERE needs IN (SELECT job_id FROM ln))",
            "dp(job_id, depth) AS (SELECT job_id, 0 FROM ln UNION SELECT inn.job_id, depth + 1 FROM dp "
            "JOIN inn ON inn.needs = dp.job_id)"])
    + " SELECT job_id, CAST(max(depth) AS BIGINT) AS depth FROM dp GROUP BY job_id")
def _(s, d):
    jobs = settled(_lines(s, d).select("job_id", "line"))
    return graph.submission_order(jobs, _edges(jobs), parts=parts_for(s, d, "lineitem"))


@query(
    "g6_batch_outcome",
    with_(LINES, EDGES, "kd AS (SELECT unit % 70 AS batch_id, ln.job_id, CASE WHEN status = 'SUCCEEDED' "
        "THEN 'succeeded' WHEN status = 'FAILED' THEN 'failed' WHEN EXISTS (SELECT 1 FROM ed "
        "JOIN ln f ON f.job_id = needs AND f.status = 'FAILED' AND f.unit % 70 = ln.unit % 70 "
        "WHERE ed.job_id = ln.job_id) THEN 'blocked' ELSE 'outstanding' END AS kind FROM ln)")
    + "SELECT batch_id, count(*) FILTER (WHERE kind = 'succeeded') AS succeeded, count(*) FILTER (WHERE kind = 'failed') "
    "AS failed, count(*) FILTER (WHERE kind = 'blocked') AS blocked, count(*) FILTER (WHERE kind = 'outstanding') AS "
    "outstanding, coalesce(list(job_id ORDER BY job_id) FILTER (WHERE kind IN ('failed', 'blocked')), [])[1:50] AS "
    "listed, count(*) FILTER (WHERE kind = 'outstanding') = 0 AS complete FROM kd GROUP BY batch_id",
)
def _(s, d):
    jobs = _lines(s, d)
    return graph.outcome(jobs.select((F.col("unit") % 70).alias("batch_id"), "job_id", "status"), _edges(jobs))


@query("g7_recorded_batches",
    "WITH a AS (SELECT o_custkey % 100 AS batch_id, count(*) AS jobs FROM orders WHERE o_custkey % 100 > 20 "
    "GROUP BY 1), b AS (SELECT o_custkey % 100 AS batch_id, bool_and(o_totalprice < 499000) AS complete FROM orders "
    "WHERE o_custkey % 100 < 60 GROUP BY 1) SELECT batch_id, jobs, complete, CASE WHEN complete "
    "THEN 'settled' WHEN complete IS NULL THEN 'prepared' ELSE 'running' END AS state FROM a FULL JOIN b USING (batch_id)")
def _(s, d):
    rows = _sessions(s, d).withColumn("batch_id", F.col("animal") % 100)
    return graph.recorded_batches(rows.filter("batch_id > 20").groupBy("batch_id").agg(F.count(F.lit(1)).alias("jobs")),
        rows.filter("batch_id < 60").groupBy("batch_id").agg(F.bool_and(F.col("o_totalprice") < 499000)
            .alias("complete")))


# Submissions: orders; executors and scheduler states by remainders.
SUBS = """sb AS (SELECT o_custkey AS batch_id, o_orderkey AS job_id, 'u' || o_custkey AS unit, CASE WHEN o_orderkey % 11 = 0
    THEN '' ELSE 'a' || (o_orderkey % 5000) END AS allocation,
 CASE WHEN o_orderkey % 13 > 0 THEN CASE o_orderstatus WHEN 'F' THEN 'RUNNING' WHEN 'O' THEN 'SUCCEEDED'
    ELSE 'FAILED' END END AS tracked, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 3 = 0
    THEN 'slurm:a' || (o_orderkey % 4000) WHEN o_orderkey % 3 = 1 THEN 'host:1' ELSE '' END AS executor FROM orders),
 sc AS (SELECT *, CASE WHEN executor LIKE 'slurm:%' THEN substr(executor, 7) ELSE '' END AS claim FROM sb),
 rd AS (SELECT 'a' || k AS allocation, CASE k % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'UNRESOLVED'
    ELSE 'BLOCKED' END AS status, k % 9 = 2 AS queued, k % 31 = 0 AS canceled FROM (SELECT unnest(generate_series(0, 4499)) AS k)),
 ss AS (SELECT sc.*, {A} AS scheduler_state, CASE WHEN claim = '' THEN '' ELSE {C} END AS claim_state FROM sc LEFT
    JOIN rd a ON a.allocation = sc.allocation LEFT JOIN rd c ON c.allocation = sc.claim),
 rs AS (SELECT *, CASE WHEN scheduler_state = 'held' OR claim_state = 'held' THEN 'running' WHEN tracked = 'SUCCEEDED'
    THEN 'finished' WHEN tracked = 'FAILED' THEN 'failed' WHEN tracked = 'RUNNING' THEN CASE WHEN executor <> ''
    AND claim = '' THEN 'running' ELSE 'stranded' END ELSE 'abandoned' END AS verdict FROM ss)"""
_STATE = (
    "CASE WHEN sc.{n} = '' THEN 'gone' WHEN {t}.canceled THEN 'settled' WHEN {t}.status = 'BLOCKED' "
    "THEN 'settled' WHEN {t}.queued THEN 'held' WHEN coalesce({t}.status, 'UNRESOLVED') = 'UNRESOLVED' "
    "THEN 'gone' WHEN {t}.status = 'COMPLETED' THEN 'settled' ELSE 'held' END"
)
SUBS = SUBS.replace("{A}", _STATE.format(n="allocation", t="a")).replace("{C}", _STATE.format(n="claim", t="c"))


def _claimed(s, d):
    o, k = read(s, d, "orders"), F.col("o_orderkey")
    submissions = o.select(F.col("o_custkey").alias("batch_id"), k.alias("job_id"),
        F.concat(F.lit("u"), "o_custkey").alias("unit"), F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("a"), k % 5000))
        .alias("allocation"))
    status = F.when(F.col("o_orderstatus") == "F", "RUNNING").when(F.col("o_orderstatus") == "O", "SUCCEEDED").otherwise("FAILED")
    tracked = o.filter(k % 13 > 0).select(k.alias("job_id"), F.concat(F.lit("u"), "o_custkey").alias("unit"),
        status.alias("status"), F.when(k % 3 == 0, F.concat(F.lit("slurm:a"), k % 4000)).when(k % 3 == 1, "host:1")
        .otherwise("").alias("executor"), F.lit(1).alias("at"))
    return scheduler.claims(submissions, tracked)


def _reading(s):
    k = F.col("k")
    status = F.get(F.array(*map(F.lit, ["COMPLETED", "PENDING", "UNRESOLVED", "BLOCKED"])), (k % 4).cast("int"))
    return s.range(4500).withColumnRenamed("id", "k").select(F.concat(F.lit("a"), k).alias("allocation"),
        status.alias("status"), (k % 9 == 2).alias("queued"), (k % 31 == 0).alias("canceled"))


def _resolved(s, d):
    return scheduler.resolved(_claimed(s, d), _reading(s))


@query("q1_q8_claims", with_(SUBS) + "SELECT batch_id, job_id, tracked, claim FROM sc")
def _(s, d):
    return _claimed(s, d).select("batch_id", "job_id", "tracked", "claim")


@query("q8_queried_allocations", with_(SUBS) + "SELECT allocation FROM sc WHERE allocation <> '' UNION SELECT claim FROM sc WHERE claim <> ''")
def _(s, d):
    return scheduler.queried(_claimed(s, d))


@query("q2_q3_verdicts", with_(SUBS)
    + "SELECT job_id, scheduler_state, claim_state, verdict, CASE verdict WHEN 'running' THEN 'none' WHEN 'stranded' "
    "THEN 'reset_and_drop' ELSE 'drop' END AS remediation FROM rs")
def _(s, d):
    return _resolved(s, d).select("job_id", "scheduler_state", "claim_state", "verdict", "remediation")


@query("q4_batch_verdicts", with_(SUBS) + "SELECT batch_id, " + ", ".join(
        f"count(*) FILTER (WHERE verdict = '{v}') AS {v}" for v in scheduler.REMEDIATION)
    + ", CASE WHEN bool_or(verdict = 'running') THEN 'progressing' WHEN bool_or(scheduler_state = 'gone') THEN 'stalled' "
    "ELSE 'awaiting_closure' END AS batch_verdict FROM rs GROUP BY batch_id")
def _(s, d):
    return scheduler.batch_verdicts(_resolved(s, d))


@query("q5_live_allocations", with_(SUBS)
    + "SELECT allocation FROM rs WHERE scheduler_state = 'held' UNION SELECT claim FROM rs WHERE claim_state = 'held'")
def _(s, d):
    return scheduler.live_allocations(_resolved(s, d))


@query("q6_closable_batches", with_(SUBS)
    + "SELECT c_custkey AS batch_id FROM customer WHERE c_custkey NOT IN (SELECT batch_id FROM rs "
    "WHERE verdict IN ('running', 'stranded'))")
def _(s, d):
    return scheduler.closable(read(s, d, "customer").select(F.col("c_custkey").alias("batch_id")), _resolved(s, d))


@query("q7_stranded_targets", with_(SUBS) + "SELECT DISTINCT unit, job_id FROM rs WHERE verdict = 'stranded'")
def _(s, d):
    return scheduler.stranded_targets(_resolved(s, d))


@query(
    "q9_reconcile",
    "WITH RECURSIVE " + SUBS + """, de AS (SELECT job_id, CASE WHEN verdict = 'running' THEN CASE WHEN claim_state = 'held'
    THEN claim WHEN scheduler_state = 'held' THEN allocation END END AS adopted, verdict = 'running'
    AND NOT (claim_state = 'held' OR scheduler_state = 'held') AS lost FROM rs),
 wh(job_id) AS (SELECT job_id FROM de WHERE lost UNION SELECT de.job_id FROM wh JOIN de ON de.job_id = wh.job_id + 1
    AND de.job_id % 10 > 0 AND de.adopted IS NULL)
 SELECT job_id, CASE WHEN adopted IS NOT NULL THEN 'adopted' WHEN job_id IN (SELECT job_id FROM wh) THEN 'withheld' ELSE 'dispatchable' END AS decision, adopted AS allocation FROM de""",
)
def _(s, d):
    """Every job needs the one before it, in groups of ten."""
    rows = _resolved(s, d)
    return scheduler.reconciled(rows, rows.filter("job_id % 10 > 0").select("job_id", (F.col("job_id") - 1).alias("needs")))


ACCOUNTING = """ac AS (SELECT l_orderkey * 10 + l_linenumber AS line, l_orderkey || CASE WHEN l_linenumber = 1 THEN ''
    WHEN l_linenumber = 2 THEN '.extern' ELSE '.' || l_linenumber END AS job_id,
 CASE WHEN l_partkey % 7 = 0 THEN '' ELSE (l_partkey % 90) || '.50' || CASE l_suppkey % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'M'
    ELSE 'G' END END AS max_rss, CASE WHEN l_linenumber % 2 = 0 THEN (l_partkey % 3) || '-'
    ELSE '' END || lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':05:00' AS elapsed, CASE WHEN l_linenumber > 1 THEN ''
    ELSE l_returnflag END AS state, l_partkey, l_suppkey, l_linenumber FROM lineitem)"""


def _accounting(s, d):
    line, k = read(s, d, "lineitem"), F.col("l_linenumber")
    step = F.when(k == 1, "").when(k == 2, ".extern").otherwise(F.concat(F.lit("."), k))
    rss = F.when(F.col("l_partkey") % 7 == 0, "").otherwise(F.concat(F.col("l_partkey") % 90, F.lit(".50"),
            F.get(F.array(F.lit("K"), F.lit("M"), F.lit("G")), (F.col("l_suppkey") % 3).cast("int"))))
    elapsed = F.concat(F.when(k % 2 == 0, F.concat(F.col("l_partkey") % 3, F.lit("-"))).otherwise(""),
        F.lpad((F.col("l_partkey") % 24).cast("string"), 2, "0"), F.lit(":05:00"))
    fields = F.concat_ws("|", F.concat("l_orderkey", step), rss, elapsed, F.when(k > 1, "").otherwise(F.col("l_returnflag")))
    lines = line.select((F.col("l_orderkey") * 10 + k).alias("line"), fields.alias("value"))
    return scheduler.accounting_rows(lines, ["job_id", "max_rss", "elapsed", "state"])


@query("s11_accounting_text", with_(ACCOUNTING) + "SELECT line, job_id, max_rss, elapsed, state FROM ac")
def _(s, d):
    return _accounting(s, d)


@query("q11_sizes_and_durations", with_(ACCOUNTING)
    + "SELECT line, max_rss, CASE WHEN l_partkey % 7 <> 0 THEN (l_partkey % 90 + 0.5)::DOUBLE * CASE l_suppkey % 3 WHEN 0 "
    "THEN 1024 WHEN 1 THEN 1048576 ELSE 1073741824 END END AS bytes, CASE WHEN l_linenumber % 2 = 0 "
    "THEN (l_partkey % 3) * 86400.0 ELSE 0.0 END + (l_partkey % 24) * 3600.0 + 300.0 AS seconds FROM ac")
def _(s, d):
    return _accounting(s, d).select("line", "max_rss", scheduler.size_bytes(F.col("max_rss")).alias("bytes"),
        scheduler.duration_seconds(F.col("elapsed")).alias("seconds"))


@query(
    "q10_accounting_merge",
    with_(ACCOUNTING, "p AS (SELECT *, split_part(job_id, '.', 1) AS j, CASE WHEN l_partkey % 7 <> 0 "
        "THEN (l_partkey % 90 + 0.5)::DOUBLE * CASE l_suppkey % 3 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 "
        "ELSE 1073741824 END END AS b, CASE WHEN l_linenumber % 2 = 0 THEN (l_partkey % 3) * 86400.0 "
        "ELSE 0.0 END + (l_partkey % 24) * 3600.0 AS sec FROM ac WHERE l_linenumber <> 2)",
          "u AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY l_partkey) AS rn FROM p)")
    + "SELECT j AS job_id, max(b) AS bytes, max(sec) + 300.0 AS seconds, coalesce(min(CASE WHEN state <> '' "
    "THEN state END), '') AS state FROM p GROUP BY j",
)
def _(s, d):
    merged = scheduler.merged_accounting(_accounting(s, d), ["max_rss"], ["elapsed"])
    return merged.select("job_id", scheduler.size_bytes(F.col("max_rss")).alias("bytes"),
        scheduler.duration_seconds(F.col("elapsed")).alias("seconds"), "state")


@query(
    "q12_allocation_status",
    "SELECT CAST(c_custkey AS VARCHAR) AS allocation, CASE WHEN c_custkey % 20 = 0 "
    "THEN 'BLOCKED' WHEN c_custkey % 3 = 2 THEN 'UNRESOLVED' WHEN c_custkey % 20 = 0 "
    "THEN 'BLOCKED' WHEN c_custkey % 5 = 0 THEN 'CANCELLED' WHEN c_custkey % 5 = 1 THEN 'PENDING' WHEN c_custkey % 5 = 2 "
    "THEN 'UNKNOWN' ELSE 'COMPLETED' END AS status FROM customer",
)
def _(s, d):
    k = F.col("c_custkey")
    state_of = F.get(F.array(*map(F.lit, ["CANCELLED by 1234", "PENDING", "STRANGE", "COMPLETED", "COMPLETED+"])), (k % 5).cast("int"))
    customers = read(s, d, "customer")
    rows = customers.filter(k % 3 < 2).select(k.cast("string").alias("job_id"), state_of.alias("state"), k.alias("line"))
    steps = rows.withColumn("job_id", F.concat("job_id", F.lit(".0")))
    return scheduler.allocation_statuses(customers.select(k.cast("string").alias("allocation")), rows.unionByName(steps),
        customers.filter(k % 20 == 0).select(k.cast("string").alias("allocation")))


@query("q13_ledger_upsert", "SELECT o_custkey AS batch_id, 'u' || (o_orderkey % 9) AS unit, o_orderkey AS job_id, "
    "CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 4 = 0 AND o_orderkey % 2 = 0) "
    "THEN 0 WHEN o_orderkey % 2 = 1 THEN 1 ELSE 2 END AS part FROM orders")
def _(s, d):
    rows = _sessions(s, d).select(F.col("animal").alias("batch_id"),
        F.concat(F.lit("u"), F.col("session") % 9).alias("unit"), F.col("session").alias("job_id"))
    return scheduler.upsert(rows, rows.filter("batch_id % 4 = 0 and job_id % 2 = 0"))


@query("q13_ledger_drop", "SELECT o_custkey AS batch_id, o_orderkey AS job_id FROM orders WHERE o_custkey % 4 <> 0")
def _(s, d):
    rows = _sessions(s, d).select(F.col("animal").alias("batch_id"), F.col("session").alias("job_id"))
    return scheduler.dropped(rows, rows.filter("batch_id % 4 = 0").select("batch_id").distinct())


@query("q14_allocation_listing", with_(SUBS)
    + "SELECT batch_id, job_id, allocation, verdict FROM rs WHERE verdict IN ('stranded', 'failed') "
    "AND scheduler_state = 'gone'")
def _(s, d):
    return scheduler.allocation_listing(_resolved(s, d), {"verdict": ["stranded", "failed"],
            "scheduler_state": ["gone"]}).select("batch_id", "job_id", "allocation", "verdict")
