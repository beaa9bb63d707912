"""Project state: manifests, job tables, plans; rollups, breakdowns, paging and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.ordering import natural_key, natural_sort

SUCCEEDED = "SUCCEEDED"
#: More distinct values than this are only counted in a breakdown (fixed value).
MOST_VALUES = 50


def pipeline_rollup(jobs: DataFrame, pipelines: list[str], keys: list[str] | None = None) -> DataFrame:
    """M2: a 0/1 column for each pipeline: it has jobs and all succeeded. One aggregation, no pivot pass."""
    keys = keys or ["animal", "session"]
    done = lambda p: F.coalesce(F.bool_and(F.when(F.col("pipeline") == p, F.col("status") == SUCCEEDED)),
        F.lit(False)).cast("int").alias(p)
    return jobs.groupBy(*keys).agg(*[done(p) for p in pipelines])


def manifest(sessions: DataFrame, jobs: DataFrame, raw: DataFrame, pipelines: list[str]) -> DataFrame:
    """M1: a row for each session that has raw data, with its pipelines' state."""
    keys = ["animal", "session"]
    there = sessions.join(raw.select(*keys).distinct(), keys, "left_semi")
    rolled = there.join(pipeline_rollup(jobs, pipelines), keys, "left")
    return rolled.withColumns({p: F.coalesce(p, F.lit(0)) for p in pipelines})


def session_date(name: Column, form: str = "yyyy-MM-dd-HH-mm-ss") -> Column:
    """The time in a session's name, null if it doesn't parse."""
    return F.try_to_timestamp(name, F.lit(form))


def job_rows(jobs: DataFrame, scopes: DataFrame, animals: DataFrame) -> DataFrame:
    """M4: scope, animal and session of each forging job; animal jobs have no session, ``scope`` stays null for an unknown job name.

    ``scopes`` has ``job_name, scope``; ``animals`` maps ``session`` to ``animal``. The specifier names the session or the animal.
    """
    scoped = jobs.join(scopes, "job_name", "left").join(animals.select(F.col("session").alias("specifier"),
            F.col("animal").alias("_animal")), "specifier", "left")
    by_animal = F.col("scope") == "animal"
    return scoped.withColumns({"session": F.when(by_animal, None).otherwise(F.col("specifier")),
            "animal": F.when(by_animal, F.col("specifier")).otherwise(F.col("_animal"))}).drop("_animal")


def project_plan(plans: list[DataFrame], version: int) -> DataFrame:
    """M6: all unit plans that the current sizing model made."""
    whole = plans[0]
    for plan in plans[1:]:
        whole = whole.unionByName(plan, allowMissingColumns=True)
    return whole.filter(F.col("model_version") == version)


def ranked(df: DataFrame, by: str, within: list[str], name: str = "index") -> DataFrame:
    """1-based place in natural order inside a group; ``ordering.natural_places`` numbers a whole table."""
    w = Window.partitionBy(*within).orderBy(natural_key(F.col(by)), by)
    return df.withColumn(name, F.row_number().over(w))


def summary(table: DataFrame, flags: list[str], axes: list[str]) -> DataFrame:
    """``axis, value, count``: totals, one axis after the other, and done and open per pipeline; one pass over the table."""
    counts = [("rows", "all", F.count(F.lit(1))), ("animals", "distinct", F.count_distinct("animal"))]
    for flag in flags:
        counts += [(flag, "done", F.sum(F.col(flag).cast("bigint"))), (flag, "open", F.sum(1 - F.col(flag).cast("bigint")))]
    totals = table.agg(*[c.alias(f"c{k}") for k, (_, _, c) in enumerate(counts)])
    long = totals.select(F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(v).alias("value"),
                        F.coalesce(f"c{k}", F.lit(0)).cast("bigint").alias("count"))
                    for k, (a, v, _) in enumerate(counts)])).alias("r")).select("r.*")
    return long.unionByName(value_counts(table, axes))


def value_counts(table: DataFrame, axes: list[str]) -> DataFrame:
    """``axis, value, count`` of every value of several columns, null as ``none``."""
    pairs = table.select(F.explode(F.array(*[F.struct(F.lit(a).alias("axis"),
                        F.coalesce(F.col(a).cast("string"), F.lit("none")).alias("value")) for a in axes])).alias("p"))
    return pairs.groupBy("p.axis", "p.value").agg(F.count(F.lit(1)).alias("count"))


def breakdown(table: DataFrame, axes: list[str], most: int = MOST_VALUES) -> DataFrame:
    """Counts per value and axis; an axis with more than ``most`` values has one row, ``value`` null and the number of values."""
    counted = value_counts(table, axes)
    sizes = counted.groupBy("axis").agg(F.count(F.lit(1)).alias("_n"))
    few = counted.join(sizes.filter(F.col("_n") <= most).select("axis"), "axis", "left_semi")
    many = sizes.filter(F.col("_n") > most).select("axis", F.lit(None).cast("string").alias("value"), F.col("_n").alias("count"))
    return few.unionByName(many)


def page(table: DataFrame, order: list, start: int = 0, length: int = 200) -> DataFrame:
    """Rows of a page in a total order; a length of 0 or less lifts the cap."""
    rows = table.orderBy(*order).offset(start)
    return rows.limit(length) if length > 0 else rows


def unknown_values(table: DataFrame, column: str, wanted: list[str], most: int = 50) -> DataFrame:
    """Requested values that the table lacks, with the first ``most`` of those it has, and how many there are.

    The first values are taken before they are put into one row: each task keeps its own first ones and no row holds all.
    """
    asked = table.sparkSession.createDataFrame([(w,) for w in wanted], "value string")
    known = table.select(F.col(column).cast("string").alias("value")).filter("value is not null").distinct()
    have = known.orderBy("value").limit(most).agg(F.sort_array(F.collect_list("value")).alias("known"))
    count = known.agg(F.count(F.lit(1)).alias("known_values"))
    return asked.join(known, "value", "left_anti").crossJoin(F.broadcast(have)).crossJoin(F.broadcast(count))


def listing(table: DataFrame, filters: dict[str, list], order: list, start: int = 0, length: int = 200) -> DataFrame:
    """Equality and membership filters, then a page."""
    for column, values in filters.items():
        table = table.filter(F.col(column).isin(values))
    return page(table, order, start, length)


def without_empty(df: DataFrame) -> DataFrame:
    """Each row as JSON without null and empty fields."""
    kept = [F.when((F.col(c) != "") if t == "string" else F.lit(True), F.col(c)).alias(c) for c, t in df.dtypes]
    return df.select(F.to_json(F.struct(*kept)).alias("record"))


def dataset_listing(membership: DataFrame, session: str | None = None, animal: str | None = None) -> DataFrame:
    """Datasets with their session and animal counts, optionally those that hold a session or an animal."""
    out = membership.groupBy("dataset").agg(F.count_distinct("animal", "session").alias("sessions"), F.count_distinct("animal").alias("animals"))
    for column, value in (("session", session), ("animal", animal)):
        if value is not None:
            out = out.join(membership.filter(F.col(column) == value).select("dataset").distinct(), "dataset", "left_semi")
    return out


def elapsed_seconds(started: Column, completed: Column, now_us: int) -> Column:
    """Run time in seconds to three places; null if it hasn't started."""
    return F.bround((F.coalesce(completed, F.lit(now_us)) - started) / 1e6, 3)


def batch_status(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Status of each job of a batch, ``SCHEDULED`` where none is known."""
    return batch.join(state.select("job_id", "status"), "job_id", "left").withColumn("status", F.coalesce("status", F.lit("SCHEDULED")))


def plan_totals(plan: DataFrame) -> DataFrame:
    """Jobs, sums and largest of both memory figures, widest cores; zeros if there are none."""
    figure = lambda f, c: F.coalesce(f(c), F.lit(0)).alias(f"{f.__name__}_{c}")
    return plan.agg(F.count(F.lit(1)).alias("jobs"), *[figure(f, c) for c in ("memory_mb", "resident_mb")
            for f in (F.sum, F.max)], figure(F.max, "cores"))


def plan_breakdown(plan: DataFrame) -> DataFrame:
    """The same by kind of unit and pipeline."""
    return plan.groupBy("unit_kind", "pipeline").agg(F.count(F.lit(1)).alias("jobs"),
        F.sum("memory_mb").alias("memory_mb"), F.sum("resident_mb").alias("resident_mb"), F.max("cores").alias("cores"))


def planned_units(units: DataFrame, plan: DataFrame) -> DataFrame:
    """Jobs and memory of each named unit, or the reason why there are none."""
    sums = plan.groupBy("unit").agg(F.count(F.lit(1)).alias("jobs"), F.sum("memory_mb").alias("memory_mb"), F.sum("resident_mb").alias("resident_mb"))
    return units.join(sums, "unit", "left").withColumn("reason", F.when(F.col("jobs").isNull(), "no job is planned for this unit"))


def job_listing(jobs: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """M3: one row for each tracked job, in natural order, nulls last."""
    return natural_sort(jobs.select(*columns), *by)


def animals_of(manifest_table: DataFrame) -> DataFrame:
    """M7: the animals of a project, each once."""
    return manifest_table.select("animal").distinct()


def sessions_of(manifest_table: DataFrame, animal: object | None = None, complete: list[str] = ()) -> DataFrame:
    """M8: sessions of an animal or of all, only those in which the named pipelines are done."""
    rows = manifest_table if animal is None else manifest_table.filter(F.col("animal") == F.lit(animal))
    for pipeline in complete:
        rows = rows.filter(F.col(pipeline) == 1)
    return rows.select("animal", "session")


def lookup(sessions: DataFrame, session: object, columns: list[str]) -> DataFrame:
    """M9: fields of one session; an unknown session gives no row."""
    return sessions.filter(F.col("session") == F.lit(session)).select(*columns)


def view(manifest_table: DataFrame, animal: object, columns: list[str]) -> DataFrame:
    """Some columns of an animal's sessions."""
    return manifest_table.filter(F.col("animal") == F.lit(animal)).select(*columns)


def with_jobs(manifest_table: DataFrame, jobs: DataFrame) -> DataFrame:
    """The manifest with a row for each job; sessions without jobs drop out."""
    return manifest_table.join(jobs, ["animal", "session"])


def discovered_units(found: DataFrame) -> DataFrame:
    """``unit_kind, dataset, animal, session, unit_path`` of a project's path markers."""
    path = F.when(F.col("kind") == "dataset", F.col("dataset")).otherwise(F.concat_ws("/", "animal", "session"))
    return found.select(F.col("kind").alias("unit_kind"), "dataset", "animal", "session", path.alias("unit_path"))


def staged_read(table: DataFrame, axes: list[str], filters: dict[str, list] | None = None, order: list | None = None,
        start: int = 0, length: int = 200) -> tuple[DataFrame, DataFrame | None]:
    """How every listing is read: counts by axis for all rows, and a page once a filter is named."""
    return breakdown(table, axes), listing(table, filters, order or table.columns, start, length) if filters else None


def prepared_batches(jobs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``batch_id, host, unit_count, job_count, blocked_count, outcome_recorded`` of every batch that was prepared.

    ``jobs`` has ``batch_id, host, unit, job_id, blocked``, ``outcomes`` ``batch_id, host`` and its four counts. A settled batch carries the counts of
    its outcome and no units.
    """
    done = outcomes.select("batch_id", "host", F.lit(None).cast("bigint").alias("unit_count"),
        (F.col("succeeded") + F.col("failed") + F.col("blocked") + F.col("outstanding")).alias("job_count"),
        F.col("blocked").alias("blocked_count"), F.lit(True).alias("outcome_recorded"))
    waiting = jobs.join(outcomes.select("batch_id"), "batch_id", "left_anti")
    counted = waiting.groupBy("batch_id").agg(F.min("host").alias("host"), F.count_distinct("unit").alias("unit_count"),
        F.count(F.lit(1)).alias("job_count"), F.count_if("blocked").alias("blocked_count"), F.lit(False).alias("outcome_recorded"))
    return done.unionByName(counted)


def outstanding_jobs(jobs: DataFrame) -> DataFrame:
    """What a batch would dispatch: jobs that haven't succeeded and are not blocked."""
    return jobs.filter((F.col("status") != SUCCEEDED) & ~F.col("blocked"))


def resource_totals(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs, widest cores, largest and summed memory of both kinds."""
    kinds = ("memory_mb", "resident_mb")
    figures = [f(F.col(k)).alias(f"{name}_{k}") for k in kinds for name, f in (("largest_job", F.max), ("summed", F.sum))]
    return jobs.groupBy(*keys).agg(F.count(F.lit(1)).alias("jobs"), F.max("cores").alias("widest_job_cores"), *figures)


def resource_units(units: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every named unit of a batch with the number of its jobs, 0 too."""
    counted = jobs.groupBy("batch_id", "unit").agg(F.count(F.lit(1)).alias("jobs"))
    return units.join(counted, ["batch_id", "unit"], "left").select("batch_id", "unit", F.coalesce("jobs", F.lit(0)).alias("jobs"))


STATUSES = ("succeeded", "failed", "running", "scheduled")


def local_jobs(jobs: DataFrame, records: DataFrame, now_us: int) -> DataFrame:
    """The jobs of a batch with what their trackers recorded: ``status`` (scheduled if nothing), times and ``elapsed_seconds``."""
    known = records.select("job_id", "status", "started_at", "completed_at")
    entries = jobs.drop("status").join(known, "job_id", "left")
    return entries.withColumns({"status": F.lower(F.coalesce("status", F.lit("SCHEDULED"))),
        "elapsed_seconds": elapsed_seconds(F.col("started_at"), F.col("completed_at"), now_us)})


def local_summary(entries: DataFrame) -> DataFrame:
    """Jobs of each batch in total, by status, and those that are blocked."""
    counts = [F.count_if(F.col("status") == name).alias(name) for name in STATUSES]
    return entries.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total"), *counts, F.count_if("blocked").alias("blocked_jobs"))
