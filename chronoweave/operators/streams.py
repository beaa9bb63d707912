"""Module event streams to typed tables. Codes: 51 primary, 52 secondary, 54 tone on, 55 tone off."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from chronoweave.functions.ordering import close_open_end, in_order, no_negative_zero, so_far
from chronoweave.operators.asof import hold

PRIMARY, SECONDARY, TONE_ON, TONE_OFF = 51, 52, 54, 55


def of_code(events: DataFrame, code: int) -> DataFrame:
    """The rows of one event code."""
    return events.filter(F.col("event") == code)


#: Payload types and how their bytes are read, little endian (fixed values).
_TYPES = {"uint8": "u1", "int8": "i1", "uint16": "<u2", "int16": "<i2", "uint32": "<u4", "int32": "<i4", "uint64": "<u8",
    "int64": "<i8", "float32": "<f4", "float64": "<f8", "bool": "?"}


@F.pandas_udf(DoubleType())
def decode_payload(data: pd.Series, dtype: pd.Series) -> pd.Series:
    """Bytes and a type name to a number; null for an empty or null payload, an unknown type or a wrong length."""
    import numpy as np

    out = np.full(len(data), np.nan)
    valid = np.zeros(len(data), dtype=bool)
    for name, kind in _TYPES.items():
        rows = np.flatnonzero((dtype == name).to_numpy() & data.notna().to_numpy())
        size = np.dtype(kind).itemsize
        rows = np.array([r for r in rows if len(data.iloc[r]) == size], dtype=np.int64)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(data.iloc[rows]), dtype=kind).astype(float)
            valid[rows] = True
    return pd.Series(out).astype(object).where(pd.Series(valid), None)


def unsigned_payload(data: Column) -> Column:
    """E2 for unsigned integers of up to seven bytes, without leaving the JVM."""
    swapped = F.array_join(F.reverse(F.regexp_extract_all(F.hex(data), F.lit("(..)"), F.lit(1))), "")
    return F.conv(swapped, 16, 10).cast("bigint")


def merge(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stable merge of two streams; at the same time the first one's rows come first. ``seq`` is numbered anew."""
    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)))
    return both.withColumn("seq", F.row_number().over(in_order(order=["time_us", "_rank", "seq"])).cast("bigint")).drop("_rank")


def states(events: DataFrame, on: int, off: int) -> DataFrame:
    """Two codes as one train of ``time_us, seq, state``."""
    keep = lambda code, state: of_code(events, code).select("session", "time_us", "seq", F.lit(state).alias("state"))
    return merge(keep(on, 1), keep(off, 0))


def with_missing_direction(events: DataFrame, value: str = "value") -> DataFrame:
    """A session with one direction only gets one zero sample of the other, at the first time + 1."""
    both = events.filter(F.col("event").isin(PRIMARY, SECONDARY))
    seen = both.groupBy("session").agg(F.min("time_us").alias("time_us"),
        F.min_by("seq", F.struct("time_us", "seq")).alias("seq"), F.collect_set("event").alias("codes"))
    lone = seen.filter(F.size("codes") == 1).select("session", (F.col("time_us") + 1).alias("time_us"), "seq",
        F.when(F.array_contains("codes", PRIMARY), SECONDARY).otherwise(PRIMARY).alias("event"), F.lit(0.0).alias(value))
    return both.select("session", "time_us", "seq", "event", value).unionByName(lone)


def encoder(events: DataFrame, cm_per_pulse: float) -> DataFrame:
    """Signed running distance; primary counts are positive."""
    rows = with_missing_direction(events)
    signed = rows.withColumn("step", F.when(F.col("event") == PRIMARY, F.col("value")).otherwise(-F.col("value")) * cm_per_pulse)
    merged = merge(signed.filter(F.col("event") == PRIMARY), signed.filter(F.col("event") == SECONDARY))
    return merged.select("session", "time_us", "seq", no_negative_zero(F.bround(F.sum("step").over(so_far()), 8)).alias("traveled_distance_cm"))


def ttl(events: DataFrame) -> DataFrame:
    """On and off as a state train that ends at 0."""
    return close_open_end(states(events, PRIMARY, SECONDARY), "state")


def brake(events: DataFrame, maximum: float, minimum: float) -> DataFrame:
    """Engaged rows carry the largest torque, released rows the smallest."""
    return states(events, PRIMARY, SECONDARY).select("session", "time_us", "seq",
        F.when(F.col("state") == 1, maximum).otherwise(minimum).alias("brake_torque"))


def pulses(train: DataFrame) -> DataFrame:
    """State changes with their edge (1 rising, -1 falling), the first value counting as no change; falling edges have the pulse's length."""
    edges = train.withColumn("edge", F.col("state") - F.coalesce(F.lag("state").over(in_order()), F.col("state"))).filter("edge <> 0")
    return edges.withColumn("pulse_us", F.when(F.col("edge") < 0, F.col("time_us") - F.lag("time_us").over(in_order())))


def valve_volume(events: DataFrame, scale: float, exponent: float) -> DataFrame:
    """Running dispensed volume, a power law of pulse lengths; a 0 row at the first time of the session."""
    train = states(events, PRIMARY, SECONDARY)
    done = pulses(train).filter("edge < 0 and pulse_us is not null")
    volume = done.select("session", "time_us", "seq", F.bround(F.sum(scale * F.pow(F.col("pulse_us").cast("double"),
                    F.lit(exponent))).over(so_far()), 8).alias("volume"))
    seed = train.groupBy("session").agg(F.min("time_us").alias("time_us")).select("session", "time_us",
        F.lit(0).cast("bigint").alias("seq"), F.lit(0.0).alias("volume"))
    return seed.unionByName(volume)


def tone(events: DataFrame) -> DataFrame:
    """The tone's state train, closed at the end."""
    return close_open_end(states(events, TONE_ON, TONE_OFF), "state").withColumnRenamed("state", "tone_state")


def on_shared_clock(first: DataFrame, first_value: str, second: DataFrame, second_value: str) -> DataFrame:
    """Both series held onto the sorted union of their times."""
    clock = first.select("session", "time_us").union(second.select("session", "time_us")).distinct()
    both = hold(second, hold(first, clock, [first_value]), [second_value])
    return both.withColumn("seq", F.row_number().over(in_order(order=["time_us"])).cast("bigint"))


def valve(events: DataFrame, scale: float, exponent: float) -> DataFrame:
    return on_shared_clock(valve_volume(events, scale, exponent), "volume", tone(events), "tone_state")


def gas_puffs(events: DataFrame) -> DataFrame:
    """State train with the running count of finished puffs."""
    train = states(events, PRIMARY, SECONDARY)
    fall = train.withColumn("_fall", (F.col("state") < F.lag("state").over(in_order())).cast("bigint"))
    return fall.select("session", "time_us", "seq", F.col("state").alias("puff_state"),
        F.coalesce(F.sum("_fall").over(so_far()), F.lit(0)).alias("puff_count"))


def lick(events: DataFrame, threshold: float) -> DataFrame:
    """Voltage and whether it reaches the threshold."""
    return of_code(events, PRIMARY).select("session", "time_us", "seq", F.col("value").alias("voltage"),
        (F.col("value") >= threshold).cast("int").alias("lick_state"))


def torque(events: DataFrame, per_unit: float) -> DataFrame:
    """Signed torque; a stream that doesn't end at 0 gets a closing 0."""
    rows = with_missing_direction(events)
    merged = merge(rows.filter(F.col("event") == PRIMARY), rows.filter(F.col("event") == SECONDARY))
    signed = F.when(F.col("event") == PRIMARY, F.col("value")).otherwise(-F.col("value")) * per_unit
    out = merged.select("session", "time_us", "seq", no_negative_zero(F.bround(signed, 8)).alias("torque"))
    return close_open_end(out, "torque", 0.0)


def screen(events: DataFrame, initially_on: int = 0) -> DataFrame:
    """Each rising edge flips the state from the configured start; the first row stands at the first time of the session."""
    train = states(events, PRIMARY, SECONDARY)
    rising = train.withColumn("_was", F.lag("state", 1, 0).over(in_order())).filter("state = 1 and _was = 0")
    flips = rising.select("session", "time_us", "seq", F.pmod(F.lit(initially_on) + F.row_number().over(in_order()), F.lit(2)).alias("screen_state"))
    seed = train.groupBy("session").agg(F.min("time_us").alias("time_us")).select("session", "time_us",
        F.lit(0).cast("bigint").alias("seq"), F.lit(initially_on).alias("screen_state"))
    return seed.unionByName(flips)


def without_primary(events: DataFrame) -> DataFrame:
    """For sessions that never opened, the row of the first close."""
    opened = of_code(events, PRIMARY).select("session").distinct()
    closed = of_code(events, SECONDARY).join(opened, "session", "left_anti")
    return closed.groupBy("session").agg(F.min("time_us").alias("time_us"))


def eligible_modules(hardware: DataFrame, modules: dict[str, dict[str, list[str]]]) -> DataFrame:
    """``session, module``; all required fields are there (false is a value) and all usage flags are true."""
    out = None
    for name, spec in modules.items():
        good = F.lit(True)
        for field in spec.get("required", []):
            good = good & F.col(field).isNotNull()
        for flag in spec.get("flags", []):
            good = good & F.coalesce(F.col(flag), F.lit(False))
        rows = hardware.filter(good).select("session", F.lit(name).alias("module"))
        out = rows if out is None else out.unionByName(rows)
    return out


def parse_jobs(modules: DataFrame, eligible: DataFrame, archives: DataFrame) -> DataFrame:
    """An extraction job for each controller with an eligible module, a parse job for each such module; ``possible`` if it has one archive."""
    fit = modules.join(eligible, ["session", "module"], "left_semi")
    count = archives.groupBy("session", "controller").agg(F.count(F.lit(1)).alias("_n"))
    extract = fit.select("session", "controller").distinct().select("session", "controller",
        F.lit("extract").alias("job_name"), F.col("controller").cast("string").alias("specifier"))
    parse = fit.select("session", "controller", F.lit("parse").alias("job_name"),
        F.concat_ws("-", F.col("controller").cast("string"), "module").alias("specifier"))
    return extract.unionByName(parse).join(count, ["session", "controller"], "left").select("session", "controller",
        "job_name", "specifier", (F.coalesce("_n", F.lit(0)) == 1).alias("possible"))


def extracted(messages: DataFrame, module_codes: DataFrame) -> DataFrame:
    """Only the messages whose module is eligible and whose event that module reads; ``module_codes`` has a row for each."""
    return messages.join(module_codes, [c for c in ("session", "module", "event") if c in module_codes.columns])
