"""The provided tables read as recordings: sessions, streams, clocks, jobs; and the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.functions.ordering import so_far

STEP_US = 6 * 3600 * 1_000_000
CM_PER_PULSE, SCALE, EXPONENT = 0.0058, 2.0e-12, 1.2


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task joins or groups.
ROWS_OF_TASK = 200_000


def parts_for(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many tasks deal with a table that is shuffled by key: they grow in number with its rows, not each in size. Counts come from footers."""
    return max(1, -(-read(spark, sf_dir, name).count() // ROWS_OF_TASK))


def micros(ts: str):
    """Microseconds since 1970 of a time without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({ts} as timestamp_ntz))")


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as module messages: a user is a session, event types are codes."""
    code = F.when(F.col("event_type") == "click", 51).when(F.col("event_type") == "view",
        52).when(F.col("event_type") == "signup", 54).when(F.col("event_type") == "error", 55).otherwise(60)
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("session"), micros("ts").alias("time_us"),
        F.col("event_id").alias("seq"), code.alias("event"), "value")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir).filter("event = 60").drop("event")


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regular reference clock over each session."""
    spans = stream(spark, sf_dir).groupBy("session").agg(F.min("time_us").alias("lo"), F.max("time_us").alias("hi"))
    ticks = spans.select("session", F.posexplode(F.sequence("lo", "hi", F.lit(STEP_US))).alias("frame", "time_us"))
    return ticks.select("session", F.col("frame").cast("bigint").alias("frame"), "time_us")


def exact_total(value: Column) -> Column:
    """Running sum of a session, added as decimals: sums of doubles depend on how they are grouped, and equal sums then differ in the
    last place. From a value on that no decimal holds (NaN, infinity) it is the sum of doubles."""
    exact = F.sum(value.try_cast("decimal(28,6)")).over(so_far()).cast("double")
    return F.when(F.max(F.abs(value) >= 1e21).over(so_far()), F.sum(value).over(so_far())).otherwise(exact)


def exact_total_sql(value: str) -> str:
    line = "OVER (PARTITION BY session ORDER BY time_us, seq ROWS UNBOUNDED PRECEDING)"
    return (f"CASE WHEN bool_or(abs({value}) >= 1e21) {line} THEN sum({value}) {line} "
        f"ELSE CAST(sum(TRY_CAST({value} AS DECIMAL(28,6))) {line} AS DOUBLE) END")


#: The same as common table expressions.
EV = """ev AS (SELECT user_id AS session, epoch_us(ts) AS time_us, event_id AS seq,
 CASE event_type WHEN 'click' THEN 51 WHEN 'view' THEN 52 WHEN 'signup' THEN 54 WHEN 'error' THEN 55 ELSE 60 END AS event, value FROM events)"""
RD = "rd AS (SELECT session, time_us, seq, value FROM ev WHERE event = 60)"
CLOCK = f"""ck AS (SELECT session, CAST((time_us - lo) / {STEP_US} AS BIGINT) AS frame, time_us FROM (
 SELECT session, lo, unnest(generate_series(lo, hi, {STEP_US})) AS time_us FROM (SELECT session, min(time_us) AS lo, max(time_us) AS hi FROM ev GROUP BY session)))"""
WS = """ws AS (SELECT *, coalesce(lag(time_us) OVER w, 2 * time_us - lead(time_us) OVER w, time_us - 1) AS start_us FROM ck
 WINDOW w AS (PARTITION BY session ORDER BY frame))"""


def near(name: str, source: str, target: str, value: str, on: str = "time_us") -> str:
    """CTE: targets with ``x0, y0`` at or before and ``x1, y1`` at or after. Of sources at one place the last by ``seq`` stands for what is
    at or before, the first for what is behind; a source at the target's own place is both."""
    one = lambda order: f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY session, {on} ORDER BY {order}) = 1)"
    return f"""{name} AS (SELECT a.*, n.{on} AS x1, CASE WHEN a.x0 = a.{on} THEN a.y0 ELSE n.{value} END AS y1 FROM (
 SELECT t.*, p.{on} AS x0, p.{value} AS y0 FROM {target} t ASOF LEFT JOIN {one("seq DESC")} p ON t.session = p.session AND t.{on} >= p.{on}) a
 ASOF LEFT JOIN {one("seq")} n ON a.session = n.session AND a.{on} <= n.{on})"""


LINE = "CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x0 = {on} THEN y0 ELSE y0 + (y1 - y0) / (x1 - x0) * ({on} - x0) END"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
