"""Resampling: every stream on one reference clock per session.

A source row has ``time_us, seq`` and value columns, a target row ``time_us`` and whatever it carries. Both are united and sorted by
session and time, once forwards and once backwards, and filled from both sides: one shuffle, no rows multiplied, and every row is
passed once, where an inequality join or a frame that ends behind the current row would be quadratic. A source at the time
of a target stands before it. ``width`` cuts long sessions into time buckets, so that no task holds one whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.ordering import in_order
from chronoweave.functions.scans import following, previous, scanned, total


def _filled(both: DataFrame, keys: list[str], points: list[str], width: int | None) -> DataFrame:
    """The targets (``_tag = 1``) with ``_prev<p>`` and ``_next<p>`` of each point: the last one up to them, the first one behind them.

    What comes next is the last one before in descending order: a frame that ends at the current row grows by a row a step, one that
    begins there would be read to its end for every row.
    """
    parts = list(keys)
    if width is not None:
        both = both.withColumn("_bucket", F.floor(F.col("_at") / width))
        parts.append("_bucket")
    order = [F.col(c) for c in ("_at", "_tag", "_seq")]
    up, down = (Window.partitionBy(*parts).orderBy(*o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for o in (order, [c.desc() for c in order]))
    filled = both.select("*", *[F.last(p, ignorenulls=True).over(w).alias(f"{n}{p}")
            for n, w in (("_prev", up), ("_next", down)) for p in points]).filter("_tag = 1")
    if width is None:
        return filled
    at = F.struct("_at", "_seq")
    ends = [f(F.col(p), F.when(F.col(p).isNotNull(), at)).alias(f"{n}{p}") for n, f in (("_last", F.max_by), ("_first", F.min_by)) for p in points]
    every = both.groupBy(*parts).agg(*ends)
    line = Window.partitionBy(*keys)
    before, behind = (line.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_bucket"), F.col("_bucket").desc()))
    carried = [F.last(f"{n}{p}", ignorenulls=True).over(w).alias(f"_carried{n}{p}")
        for n, w in (("_last", before), ("_first", behind)) for p in points]
    joined = filled.join(every.select(*parts, *carried), parts)
    return joined.withColumns({f"{n}{p}": F.coalesce(f"{n}{p}", f"_carried{o}{p}")
            for n, o in (("_prev", "_last"), ("_next", "_first")) for p in points})


def _united(targets: DataFrame, sources: list[tuple[DataFrame, list[str]]], keys: list[str], on: str) -> DataFrame:
    """Targets and all sources as rows of one table: each source has a point column ``_p<k>``, targets have ``_row``."""
    kinds = [s.select(F.struct(F.col(on), *v).alias("p")).schema["p"].dataType for s, v in sources]
    row = targets.select(F.struct("*").alias("r")).schema["r"].dataType

    def part(df: DataFrame, own: int | None) -> DataFrame:
        points = [(F.struct(F.col(on), *sources[k][1]) if k == own else F.lit(None).cast(kind)).alias(f"_p{k}") for k, kind in enumerate(kinds)]
        carried = F.struct(*targets.columns) if own is None else F.lit(None).cast(row)
        return df.select(*keys, F.col(on).alias("_at"), F.lit(int(own is None)).alias("_tag"),
            (F.lit(0).cast("bigint") if own is None else F.col("seq").cast("bigint")).alias("_seq"), *points,
            carried.alias("_row"))

    both = part(targets, None)
    for k, (source, _) in enumerate(sources):
        both = both.unionByName(part(source, k))
    return both


def neighbours(source: DataFrame, targets: DataFrame, values: list[str], keys: list[str] | None = None,
        on: str = "time_us", width: int | None = None) -> DataFrame:
    """Targets with ``prev`` and ``next``: structs of ``on`` and the values of the last source at or before, and the first at or after."""
    keys = keys or ["session"]
    filled = _filled(_united(targets, [(source, values)], keys, on), keys, ["_p0"], width)
    exact = F.col("_prev_p0").getField(on) == F.col("_at")
    return filled.select("_row.*", F.col("_prev_p0").alias("prev"), F.when(exact, F.col("_prev_p0")).otherwise(F.col("_next_p0")).alias("next"))


def hold(source: DataFrame, targets: DataFrame, values: list[str], keys: list[str] | None = None, on: str = "time_us",
        width: int | None = None) -> DataFrame:
    """The last value at or before each target; before the first source, its first value."""
    near = neighbours(source, targets, values, keys, on, width)
    return near.select(*targets.columns, *[F.coalesce(F.when(F.col("prev").isNotNull(), F.col("prev"))
                .otherwise(F.col("next")).getField(v)).alias(v) for v in values])


def line_between(prev: Column, following: Column, at: Column, value: str, on: str = "time_us") -> Column:
    """A2 for one target: linear between neighbours, held at both ends."""
    x0, x1, y0, y1 = prev.getField(on), following.getField(on), prev.getField(value), following.getField(value)
    return F.when(prev.isNull(), y1).when(following.isNull() | (x0 == at), y0).otherwise(y0 + (y1 - y0) / (x1 - x0) * (at - x0))


def linear(source: DataFrame, targets: DataFrame, values: list[str], keys: list[str] | None = None, on: str = "time_us",
        width: int | None = None) -> DataFrame:
    """A2: linear between the neighbours, clamped at both ends; NaN spreads to the samples it brackets."""
    near = neighbours(source, targets, values, keys, on, width)
    return near.select(*targets.columns, *[line_between(F.col("prev"), F.col("next"), F.col(on), v, on).alias(v) for v in values])


def align_all(targets: DataFrame, sources: list[tuple[DataFrame, list[str], str]], keys: list[str] | None = None,
        on: str = "time_us", width: int | None = None) -> DataFrame:
    """A1 and A2 for many streams at once: ``(source, values, "hold" or "linear")``, with one shuffle for all of them."""
    keys = keys or ["session"]
    filled = _filled(_united(targets, [(s, v) for s, v, _ in sources], keys, on), keys, [f"_p{k}" for k in range(len(sources))], width)
    out = []
    for k, (_, values, kind) in enumerate(sources):
        prev, following = F.col(f"_prev_p{k}"), F.col(f"_next_p{k}")
        for v in values:
            held = F.when(prev.isNotNull(), prev.getField(v)).otherwise(following.getField(v))
            out.append((line_between(prev, following, F.col("_at"), v, on) if kind == "linear" else held).alias(v))
    return filled.select("_row.*", *out)


def window_starts(clock: DataFrame, width: int | None = None) -> DataFrame:
    """A3: frame i covers ``(start_us, time_us]``; the first opens one interval early, or 1 us for a single frame."""
    t = F.col("time_us")
    near = scanned(clock, {"_before": previous(t), "_behind": following(t)}, ["frame"], width, "time_us")
    return near.withColumn("start_us", F.coalesce("_before.v", 2 * t - F.col("_behind.v"), t - 1)).drop("_before", "_behind")


def in_windows(source: DataFrame, clock: DataFrame, values: list[str], width: int | None = None) -> DataFrame:
    """``session, frame, time_us, seq`` and values of the source rows that fall in the window of some frame."""
    bounded = window_starts(clock, width).withColumn("seq", F.lit(0).cast("bigint"))
    near = neighbours(bounded, source, ["frame", "start_us"], width=width)
    inside = near.filter(F.col("next").isNotNull() & (F.col("time_us") > F.col("next.start_us")))
    return inside.select("session", F.col("next.frame").alias("frame"), "time_us", "seq", *values)


def onsets_of(source: DataFrame, state: str = "state", width: int | None = None) -> DataFrame:
    """The engaged readings that follow a disengaged one, or none."""
    near = scanned(source, {"_was": previous(F.col(state) > 0)}, ["time_us", "seq"], width)
    return near.filter((F.col(state) > 0) & ~F.coalesce(F.col("_was.v"), F.col("_was").isNotNull())).drop("_was")


def held_at_start(source: DataFrame, clock: DataFrame, value: str, width: int | None = None) -> DataFrame:
    """The value that each frame's window begins with, as a reading before all others."""
    starts = window_starts(clock, width).select("session", "frame", F.col("start_us").alias("time_us"))
    return hold(source, starts, [value], width=width).select("session", "frame", F.lit(-(1 << 62)).alias("time_us"),
        F.lit(0).cast("bigint").alias("seq"), value)


def strongest(value: str, of: Column | None = None) -> Column:
    """A5 as an aggregate: the value of largest magnitude, the earliest on ties; ``of`` says which rows count."""
    key = F.struct(F.abs(value), -F.col("time_us"), -F.col("seq"))
    return F.max_by(F.col(value), key if of is None else F.when(of, key))


def window_onsets(source: DataFrame, clock: DataFrame, state: str = "state", width: int | None = None) -> DataFrame:
    """A4: 1 where an engaged reading that follows a disengaged one falls in the frame's window."""
    hit = in_windows(onsets_of(source, state, width), clock, [], width).select("session", "frame").distinct().withColumn("onset", F.lit(1))
    return clock.join(hit, ["session", "frame"], "left").withColumn("onset", F.coalesce("onset", F.lit(0)))


def signed_peaks(source: DataFrame, clock: DataFrame, value: str = "value", width: int | None = None) -> DataFrame:
    """A5: of the value held at the window's start and all values inside, the one of largest magnitude, the earliest on ties."""
    rows = held_at_start(source, clock, value, width).unionByName(in_windows(source, clock, [value], width))
    return clock.join(rows.groupBy("session", "frame").agg(strongest(value).alias("peak")), ["session", "frame"], "left")


def window_maxima(source: DataFrame, clock: DataFrame, value: str = "value", width: int | None = None) -> DataFrame:
    """Largest value of the window that is not NaN; NaN if all are; an empty window takes the linear value at the frame."""
    inside = in_windows(source, clock, [value], width).groupBy("session",
        "frame").agg(F.max(F.when(~F.isnan(value), F.col(value))).alias("_max"), F.count(F.lit(1)).alias("_n"))
    line = linear(source, clock, [value], width=width).withColumnRenamed(value, "_line")
    joined = line.join(inside, ["session", "frame"], "left")
    return joined.select(*clock.columns, F.when(F.col("_n").isNull(), F.col("_line"))
        .otherwise(F.coalesce("_max", F.lit(float("nan")))).alias("maximum"))


def nearest(source: DataFrame, targets: DataFrame, values: list[str], keys: list[str] | None = None, width: int | None = None) -> DataFrame:
    """The nearest source; a tie takes the later one. ``distance_us`` is how far it is."""
    near = neighbours(source, targets, values, keys, width=width)
    left, right = F.col("time_us") - F.col("prev.time_us"), F.col("next.time_us") - F.col("time_us")
    pick = F.when(F.col("next").isNull() | (left < right), F.col("prev")).otherwise(F.col("next"))
    return near.withColumn("_pick", pick).select(*targets.columns, *[F.col("_pick").getField(v).alias(v) for v in values],
        F.abs(F.col("time_us") - F.col("_pick.time_us")).alias("distance_us"))


def matches_in_tolerance(source: DataFrame, targets: DataFrame, tolerance_us: int = 50_000, keys: list[str] | None = None) -> DataFrame:
    """How many targets have a source nearer than the tolerance."""
    return nearest(source, targets, [], keys).groupBy(*(keys or ["session"])).agg(F.count_if(F.col("distance_us") < tolerance_us).alias("matches"))


def corridor_distance(encoder: DataFrame, corridors: DataFrame, targets: DataFrame, width: int | None = None) -> DataFrame:
    """Distance since the last corridor's onset, clamped to the corridor's length, plus the corridor's start.

    ``encoder`` has ``distance``, ``corridors`` ``start_cm``. The length of the last corridor is open.
    """
    onsets = neighbours(encoder, corridors, ["distance"], width=width).withColumn("onset_distance", F.coalesce("prev.distance", F.lit(0.0)))
    onsets = onsets.withColumn("length_cm", F.lead("start_cm").over(in_order()) - F.col("start_cm")).drop("prev", "next")
    travelled = linear(encoder, targets, ["distance"], width=width)
    placed = hold(onsets, travelled, ["onset_distance", "start_cm", "length_cm"], width=width)
    since = F.greatest(F.col("distance") - F.col("onset_distance"), F.lit(0.0))
    return placed.select(*targets.columns, (F.col("start_cm") + F.when(F.col("length_cm").isNull(), since)
            .otherwise(F.least(since, F.col("length_cm")))).alias("corridor_cm"))


def merged_zones(zones: DataFrame) -> DataFrame:
    """``session, start_cm, end_cm`` of the stretches that zones cover; zones that overlap or touch are one."""
    line = Window.partitionBy("session").orderBy("start_cm", "end_cm")
    reach = F.max("end_cm").over(line.rowsBetween(Window.unboundedPreceding, -1))
    marked = zones.filter("start_cm <= end_cm").withColumn("_new", (reach.isNull() | (F.col("start_cm") > reach)).cast("int"))
    numbered = marked.withColumn("_stretch", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("session", "_stretch").agg(F.min("start_cm").alias("start_cm"), F.max("end_cm").alias("end_cm")).drop("_stretch")


def in_zones(targets: DataFrame, zones: DataFrame, on: str = "distance", width: int | None = None) -> DataFrame:
    """A10: 1 if ``start_cm <= distance <= end_cm`` for some zone of the session: the last stretch that begins at or before decides."""
    begins = merged_zones(zones).select("session", F.col("start_cm").alias(on), F.lit(0).cast("bigint").alias("seq"), "end_cm")
    near = neighbours(begins, targets, ["end_cm"], on=on, width=width)
    return near.select(*targets.columns, F.coalesce((F.col("prev.end_cm") >= F.col(on)).cast("int"), F.lit(0)).alias("in_zone"))


def running_speed(df: DataFrame, window_us: int = 100_000, distance: str = "distance", width: int | None = None) -> DataFrame:
    """Speed from the earliest sample of the last window; backward motion and a missing earlier sample give 0. Distance per second.

    The start of a row's window is the first sample at or behind its time less the window: the series merged with its own times, moved
    back, one pass over both whatever the number of samples in a window. Of samples of one time the first stands for all.
    """
    firsts = df.groupBy("session", "time_us").agg(F.min_by(distance, "seq").alias("_begun"), F.min("seq").alias("seq"))
    begins = firsts.select("session", (F.col("time_us")).alias("_at_us"), "seq", "_begun", F.col("time_us").alias("_from"))
    targets = df.withColumn("_at_us", F.col("time_us") - window_us)
    near = neighbours(begins, targets, ["_begun", "_from"], on="_at_us", width=width)
    rise, span = F.col(distance) - F.col("next._begun"), F.col("time_us") - F.col("next._from")
    return near.select(*df.columns, F.when((span > 0) & (rise > 0), rise / span * 1e6).otherwise(0.0).alias("speed"))


def clock_heights(clocks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each clock."""
    return clocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"))


def slowest_clock(clocks: DataFrame, ranks: dict[str, int] | None = None) -> DataFrame:
    """Of the cameras with two frames and a positive span, the one with the fewest frames per second; ties by rank, then name."""
    spans = clocks.groupBy("session", "camera").agg(F.count(F.lit(1)).alias("frames"), F.min("time_us").alias("first_us"),
        F.max("time_us").alias("last_us"))
    fit = spans.filter("frames >= 2 and last_us > first_us").withColumn("rate", (F.col("frames") - 1) * 1e6 / (F.col("last_us") - F.col("first_us")))
    rank = F.lit(0)
    for name, place in (ranks or {}).items():
        rank = F.when(F.col("camera") == name, place).otherwise(rank)
    return fit.groupBy("session").agg(F.min_by(F.struct("camera", "frames", "rate"), F.struct("rate", rank, "camera"))
        .alias("_c")).select("session", "_c.*")


def elapsed_minutes(df: DataFrame, clock: DataFrame | None = None) -> DataFrame:
    """Minutes since the session's first sample, to two places. ``clock`` has the same times; with it no session is in one window."""
    if clock is None:
        started = df.withColumn("_start", F.min("time_us").over(Window.partitionBy("session")))
    else:
        started = df.join(clock.groupBy("session").agg(F.min("time_us").alias("_start")), "session")
    return started.withColumn("elapsed_min", F.bround((F.col("time_us") - F.col("_start")) / 6e7, 2)).select(*df.columns, "elapsed_min")


def running_total(df: DataFrame, value: str, name: str, width: int | None = None) -> DataFrame:
    """Running sum per session; with ``width`` computed inside time buckets and shifted by the totals of earlier ones."""
    return scanned(df, {name: total(F.col(value))}, ["time_us", "seq"], width)
