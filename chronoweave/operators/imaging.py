"""Imaging frames: pulses of the frame trigger, their runs and acquisitions, and alignment with the recorder's own clock."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from chronoweave.functions.ordering import ORDER, in_order
from chronoweave.functions.scans import medians, previous, scanned, total
from chronoweave.operators.asof import neighbours

TOLERANCE_US = 50_000
ANCHORS = 10
#: Parts of the unit of time that pulses and frames are merged in.
SCALE = 1000
GAP_FACTOR = 3
LEAST_PULSES = 3


def edges(train: DataFrame, width: int | None = None) -> DataFrame:
    """edge of each row (the first one has none) and the running number of rising edges. ``width`` cuts long sessions by time."""
    near = scanned(train, {"_before": previous(F.col("state"))}, ORDER, width)
    step = near.withColumn("edge", F.coalesce(F.col("state") - F.col("_before.v"), F.lit(0))).drop("_before")
    return scanned(step, {"pulse_id": total((F.col("edge") == 1).cast("bigint"))}, ORDER, width)


def paired_pulses(train: DataFrame, width: int | None = None) -> DataFrame:
    """rising and falling edge of each pulse with its length; pulses that miss an edge drop out."""
    rows = edges(train, width)
    rise = rows.filter("edge = 1").select("session", "pulse_id", F.col("time_us").alias("pulse_start"))
    fall = rows.filter("edge = -1").select("session", "pulse_id", F.col("time_us").alias("pulse_end"))
    return rise.join(fall, ["session", "pulse_id"]).withColumn("duration_ms", (F.col("pulse_end") - F.col("pulse_start")) / 1000)


def in_band(pulses: DataFrame, expected_ms: float, tolerance_ms: float = 20.0) -> DataFrame:
    """pulses whose length is near the expected period, both ends included, as ``frame, time_us``."""
    fit = pulses.filter(F.col("duration_ms").between(expected_ms - tolerance_ms, expected_ms + tolerance_ms))
    return fit.select("session", F.col("pulse_id").alias("frame"), F.col("pulse_start").alias("time_us"))


def pulse_runs(pulses: DataFrame, width: int | None = None) -> DataFrame:
    """``run`` from 0 on; a gap over three median periods starts a new one. Sessions of fewer than three pulses are one run.

    With ``width`` sessions are cut by time, and the median comes from counts of ranges (``medians``): no session is in one task.
    """
    near = scanned(pulses, {"_before": previous(F.col("time_us"))}, ["frame"], width, "time_us")
    period = near.withColumn("_period", F.col("time_us") - F.col("_before.v"))
    pulse_counts = period.groupBy("session").agg(F.count(F.lit(1)).alias("_pulses"))
    middle = (period.groupBy("session").agg(F.median("_period").alias("_median"), F.count(F.lit(1)).alias("_pulses")) if width is None
        else pulse_counts.join(medians(period, F.col("_period"), "_median"), "session", "left"))
    gap = period.join(middle, "session").withColumn("_gap", (F.col("_pulses") >= LEAST_PULSES) & (F.col("_period") > F.col("_median") * GAP_FACTOR))
    runs = scanned(gap, {"run": total(F.col("_gap").cast("int"))}, ["frame"], width, "time_us")
    return runs.select(*pulses.columns, F.coalesce("run", F.lit(0)).alias("run"))


def acquisition_sizes(frames: DataFrame) -> DataFrame:
    """``session, size`` of each acquisition. ``frames`` has ``acquisition, number``.

    With one acquisition index, acquisition k holds the frame numbers that occur at least k times.
    """
    own = frames.groupBy("session", "acquisition").agg(F.count(F.lit(1)).alias("size"))
    many = own.groupBy("session").agg((F.count(F.lit(1)) > 1).alias("_indexed"))
    repeats = frames.groupBy("session", "number").agg(F.count(F.lit(1)).alias("_n")).join(many.filter("not _indexed")
        .select("session"), "session", "left_semi")
    peeled = repeats.select("session", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n"))
        .alias("_k")).groupBy("session", "_k").agg(F.count(F.lit(1)).alias("size"))
    return own.join(many.filter("_indexed").select("session"), "session", "left_semi").select("session",
        "size").unionByName(peeled.select("session", "size"))


class _Search:
    """Costs to place acquisitions on runs from some run on, each looked for within a budget.

    A branch ends when what it costs so far and the cheapest span of every acquisition still to place, run over twice or not, are over the
    budget. Acquisitions of one size are alike, so a state is how many of each size are left and the first free run.
    """

    def __init__(self, runs: list[int], sizes: list[int]) -> None:
        self.runs, self.kinds, self.known = runs, sorted(set(sizes)), {}
        self.spans = [[self._spans_at(size, a) for a in range(len(runs))] for size in self.kinds]
        self.cheapest = []
        for own in self.spans:
            least = [math.inf]
            for at in reversed(own):
                least.append(min(least[-1], min(cost for _, cost in at)))
            self.cheapest.append(least[::-1])

    def _spans_at(self, size: int, a: int) -> list[tuple[int, int]]:
        """Last run and cost of the spans from a run on; a span ends with the run that makes it larger than the acquisition."""
        total, out = 0, []
        for b in range(a, len(self.runs)):
            total += self.runs[b]
            out.append((b, abs(total - size)))
            if total > size:
                break
        return out

    def cost(self, left: tuple[int, ...], free: int, budget: float) -> float:
        """The least cost, or something over the budget if that is more."""
        open_ = sum(left)
        if not open_:
            return 0
        if len(self.runs) - free < open_:
            return math.inf
        bound = sum(n * least[free] for n, least in zip(left, self.cheapest, strict=True) if n)
        if bound > budget:
            return bound
        value, exact = self.known.get((left, free), (0, False))
        if exact or value > budget:
            return value
        best = math.inf
        for k, n in enumerate(left):
            if not n:
                continue
            rest = (*left[:k], n - 1, *left[k + 1 :])
            for a in range(free, len(self.runs) - open_ + 1):
                for b, own in self.spans[k][a]:
                    room = min(budget, best - 1) - own
                    if room >= 0:
                        best = min(best, own + self.cost(rest, b + 1, room))
        self.known[left, free] = (best, True) if best <= budget else (max(value, budget + 1), False)
        return self.known[left, free][0]


def best_spans(runs: list[int], sizes: list[int]) -> list[tuple[int, int]] | None:
    """the cheapest span of consecutive runs for each acquisition, by absolute difference of counts.

    A span ends with the run that makes it larger than the acquisition. Equally cheap plans: the first in the order of acquisitions,
    then of spans. The budget is doubled until a plan fits; then the order is settled acquisition by acquisition, and the spans for it.
    """
    if not sizes or len(sizes) > len(runs):
        return None
    search = _Search(runs, sizes)
    left = tuple(sizes.count(k) for k in search.kinds)
    budget = sum(n * least[0] for n, least in zip(left, search.cheapest, strict=True))
    while (least := search.cost(left, 0, budget)) > budget:
        budget = max(2 * budget, 1)

    order, ways, waiting = [], {(0, 0)}, list(range(len(sizes)))  # ways: first free run, and what was spent
    while waiting:
        for k in waiting:
            kind = search.kinds.index(sizes[k])
            rest = (*left[:kind], left[kind] - 1, *left[kind + 1 :]) if left[kind] else None
            found = {(b + 1, spent + own) for free, spent in ways for a in range(free, len(runs)) for b, own in search.spans[kind][a]
                if spent + own + search.cost(rest, b + 1, least - spent - own) == least}
            if found:
                order.append(kind)
                waiting.remove(k)
                ways, left = found, rest
                break
    needed = [[math.inf] * (len(runs) + 1) for _ in order] + [[0] * (len(runs) + 1)]
    for level in range(len(order) - 1, -1, -1):
        for free in range(len(runs) - 1, -1, -1):
            here = min(own + needed[level + 1][b + 1] for b, own in search.spans[order[level]][free])
            needed[level][free] = min(needed[level][free + 1], here)
    plan, free, spent = [], 0, 0
    for level, kind in enumerate(order):
        a, b, own = next((a, b, own) for a in range(free, len(runs)) for b, own in search.spans[kind][a]
            if spent + own + needed[level + 1][b + 1] == least)
        plan.append((a, b))
        free, spent = b + 1, spent + own
    return sorted(plan)


def claimed_runs(runs: DataFrame, sizes: DataFrame) -> DataFrame:
    """``session, run`` of the runs that acquisitions claim; one small table of runs per session is solved at a time.

    ``runs`` has ``session, run, pulses``, ``sizes`` ``session, size``. Sessions without a plan give no rows.
    """
    both = runs.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("run", "pulses")))
        .alias("runs")).join(sizes.groupBy("session").agg(F.reverse(F.array_sort(F.collect_list("size"))).alias("sizes")),
        "session")

    @F.pandas_udf(ArrayType(IntegerType()))
    def solve(of_runs: pd.Series, of_sizes: pd.Series) -> pd.Series:
        out = []
        for r, s in zip(of_runs, of_sizes, strict=True):
            plan = best_spans([int(x["pulses"]) for x in r], [int(x) for x in s])
            out.append([r[k]["run"] for a, b in plan for k in range(a, b + 1)] if plan else [])
        return pd.Series(out)

    return both.select("session", F.explode(solve("runs", "sizes")).alias("run"))


def drop_stray_runs(pulses: DataFrame, frames: DataFrame) -> DataFrame:
    """pulses of claimed runs; all pulses of a session with one run, without metadata or without a plan."""
    rows = pulse_runs(pulses)
    counted = rows.groupBy("session", "run").agg(F.count(F.lit(1)).alias("pulses"))
    several = counted.groupBy("session").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("session")
    claims = claimed_runs(counted.join(several, "session", "left_semi"), acquisition_sizes(frames)).withColumn("_kept", F.lit(True))
    planned = claims.select("session").distinct().withColumn("_planned", F.lit(True))
    return rows.join(claims, ["session", "run"], "left").join(planned, "session", "left").filter("_kept or _planned is null").select(*pulses.columns)


def last_frames(pulses: DataFrame, counts: DataFrame) -> DataFrame:
    """F8: the last ``frame_count`` pulses of each session."""
    back = F.row_number().over(Window.partitionBy("session").orderBy(F.col("frame").desc()))
    return pulses.join(counts, "session").withColumn("_back", back).filter("_back <= frame_count").select(*pulses.columns)


def clock_offset(pulses: DataFrame, frames: DataFrame, tolerance_us: int = TOLERANCE_US, block: int = 4096) -> DataFrame:
    """of the first ten pulses as anchors of the first frame, the offset with most matches, the first one on ties.

    ``pulses`` has ``pulse_start``, ``frames`` ``time_us`` on the recorder's clock with ``place`` from 1 on. Pulses and frames are merged once,
    at the first anchor's offset: a frame that any anchor matches with a pulse is no farther from it than the anchors are apart. That
    reach is the unit of time, so each pulse looks at the frames within one unit and says which anchors it speaks for. Sessions are cut into
    blocks of ``block`` units; only frames next to a cut stand in two of them.
    """
    anchors = pulses.withColumn("anchor", F.row_number().over(in_order(order=["pulse_start"]))).filter(F.col("anchor") <= ANCHORS)
    start = frames.filter("place = 1").select("session", F.col("time_us").alias("_first"))
    offsets = anchors.join(start, "session").groupBy("session").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("anchor", (F.col("pulse_start") - F.col("_first")).alias("offset_us")))),
            lambda x: x["offset_us"]).alias("_offsets"))
    base = F.element_at("_offsets", 1)
    offsets = offsets.select("session", "_offsets", base.alias("_base"), (F.element_at("_offsets", -1) - base + tolerance_us).alias("_reach"))
    none = F.lit(None)
    # Times count from the first frame of the session, in thousandths of the reach.
    first = start.select("session", "_first")
    of_frames = frames.join(offsets, "session").join(first, "session").select("session",
        F.floor((F.col("time_us") - F.col("_first")) * SCALE / F.col("_reach")).alias("_at"), F.col("time_us").alias("_frame"), none.cast("bigint").alias("_pulse"),
        none.cast("array<bigint>").alias("_offsets"))
    reach = SCALE + 2  # both times are rounded down
    near_cut = F.sequence(F.floor((F.col("_at") - reach) / (block * SCALE)), F.floor((F.col("_at") + reach) / (block * SCALE)))
    of_frames = of_frames.withColumn("_block", F.explode(near_cut))
    of_pulses = pulses.join(offsets, "session").join(first, "session").select("session",
        F.floor((F.col("pulse_start") - F.col("_base") - F.col("_first")) * SCALE / F.col("_reach")).alias("_at"), none.cast("bigint").alias("_frame"),
        F.col("pulse_start").alias("_pulse"), "_offsets")
    both = of_frames.unionByName(of_pulses.withColumn("_block", F.floor(F.col("_at") / (block * SCALE))))
    around = Window.partitionBy("session", "_block").orderBy("_at").rangeBetween(-reach, reach)
    near = both.withColumn("_near", F.collect_list("_frame").over(around)).filter("_pulse is not null")
    votes = F.transform("_offsets", lambda o: F.exists("_near", lambda f: F.abs(F.col("_pulse") - f - o) < tolerance_us).cast("bigint"))
    voted = near.withColumn("_votes", votes)
    counted = voted.groupBy("session").agg(F.first("_offsets").alias("_offsets"), *[F.sum(F.get("_votes", k)).alias(f"_v{k}") for k in range(ANCHORS)])
    all_votes = F.array(*[F.struct(F.col(f"_v{k}").alias("matches"), F.lit(-k).alias("k"), F.get("_offsets", k).alias("offset_us")) for k in range(ANCHORS)])
    best = F.array_max(F.filter(all_votes, lambda v: v["matches"].isNotNull()))
    return counted.select("session", best.alias("_b")).select("session", "_b.offset_us", "_b.matches")


def align(pulses: DataFrame, frames: DataFrame, tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """each pulse to its nearest frame on the shifted clock; per frame the closest pulse, the earliest on ties."""
    moved = frames.join(clock_offset(pulses, frames, tolerance_us), "session").select("session",
        (F.col("time_us") + F.col("offset_us")).alias("time_us"), F.col("place").alias("seq"), "place")
    near = neighbours(moved, pulses.withColumn("time_us", F.col("pulse_start")), ["place"])
    left, right = F.col("time_us") - F.col("prev.time_us"), F.col("next.time_us") - F.col("time_us")
    pick = F.when(F.col("next").isNull() | (left < right), F.struct(F.col("prev.place").alias("place"),
            left.alias("distance_us"))).otherwise(F.struct(F.col("next.place").alias("place"),
            right.alias("distance_us")))
    chosen = near.withColumn("_p", pick).select("session", "pulse_id", "pulse_start", "_p.*").filter(F.col("distance_us") < tolerance_us)
    rank = F.row_number().over(Window.partitionBy("session", "place").orderBy("distance_us", "pulse_start"))
    return chosen.withColumn("_rank", rank).filter("_rank = 1").select("session", F.col("pulse_id").alias("frame"),
        F.col("pulse_start").alias("time_us"), "place")


def aligned_frames(band: DataFrame, pulses: DataFrame, frames: DataFrame, counts: DataFrame, tolerance_us: int = TOLERANCE_US) -> DataFrame:
    """the last pulses where there are too many, the nearest ones where there are too few; frames numbered from 1 on."""
    have = counts.join(band.groupBy("session").agg(F.count(F.lit(1)).alias("_have")), "session",
        "left").withColumn("_have", F.coalesce("_have", F.lit(0)))
    enough = last_frames(band, have.filter("_have >= frame_count").select("session", "frame_count"))
    few = have.filter("_have < frame_count").select("session")
    found = align(pulses.join(few, "session", "left_semi"), frames.join(few, "session", "left_semi"),
        tolerance_us).select("session", "frame", "time_us")
    both = enough.select("session", "frame", "time_us").unionByName(found)
    return both.select("session", F.row_number().over(in_order(order=["frame"])).alias("frame"), "time_us")


def cells_only(traces: DataFrame, rois: DataFrame) -> DataFrame:
    """traces of regions that are cells."""
    return traces.join(rois.filter("is_cell = 1").select("session", "roi"), ["session", "roi"], "left_semi")


def frame_arrays(traces: DataFrame, name: str = "values") -> DataFrame:
    """One array per frame, in the order of the regions."""
    return traces.groupBy("session", "frame").agg(F.transform(F.array_sort(F.collect_list(F.struct("roi", "value"))),
            lambda x: x["value"]).alias(name))


def attach_traces(frames: DataFrame, arrays: dict[str, DataFrame]) -> DataFrame:
    """array columns by frame."""
    for name, rows in arrays.items():
        frames = frames.join(frame_arrays(rows, name), ["session", "frame"], "left")
    return frames
