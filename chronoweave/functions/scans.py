"""Scans along a session in two levels, and exact medians, for sessions of any length.

A scan gives every row what stands before it: a running sum, the last value that is not null, the row before. Without ``width`` it is one
window for each session. With ``width`` a session is cut into buckets of its leading order column: rows are scanned inside their bucket,
each bucket leaves one row of state, states are scanned along the session, and what earlier buckets carry is put into the rows.
So no task holds more rows of a session than a bucket has, or a state for each bucket. Both give the same, but for the rounding of sums of doubles.
In buckets the rows are read twice, for their states and for themselves, so they are computed once and kept in the shared folder: scans of one
call share that, and what several scans in a row need is not computed again and again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from chronoweave.functions.shared import settled


@dataclass(frozen=True)
class Scan:
    """What a row gets. ``carry`` is taken over the states of a session's other buckets, ``join`` puts own and carried together."""

    value: Column
    kind: str

    def own(self, ordered: WindowSpec) -> Column:
        """Inside a bucket, or a whole session."""
        if self.kind in ("previous", "following"):
            return (F.lag if self.kind == "previous" else F.lead)(F.struct(self.value.alias("v"))).over(ordered)
        up_to = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {"total": F.sum(self.value), "least": F.min(self.value), "latest": F.last(self.value, ignorenulls=True)}[self.kind].over(up_to)

    def state(self, order: Column) -> Column:
        """What a bucket leaves."""
        return {"total": lambda: F.sum(self.value), "least": lambda: F.min(self.value),
            "latest": lambda: F.max_by(self.value, F.when(self.value.isNotNull(), order)),
            "previous": lambda: F.max_by(F.struct(self.value.alias("v")), order),
            "following": lambda: F.min_by(F.struct(self.value.alias("v")), order)}[self.kind]()

    def carry(self, name: str, buckets: list[str], keys: list[str]) -> Column:
        turn = [F.col(b).desc() if self.kind == "following" else F.col(b) for b in buckets]
        earlier = Window.partitionBy(*keys).orderBy(*turn).rowsBetween(Window.unboundedPreceding, -1)
        how = {"total": F.sum, "least": F.min, "latest": lambda c: F.last(c, ignorenulls=True), "previous": F.last, "following": F.last}[self.kind]
        return how(name).over(earlier)

    def join(self, own: Column, carried: Column) -> Column:
        if self.kind == "total":
            return F.when(own.isNull() & carried.isNull(), F.lit(None)).otherwise(F.coalesce(own, F.lit(0)) + F.coalesce(carried, F.lit(0)))
        return F.least(own, carried) if self.kind == "least" else F.coalesce(own, carried)


def total(value: Column) -> Scan:
    """Sum up to and with the row; null before the first value that is not null."""
    return Scan(value, "total")


def least(value: Column) -> Scan:
    """Smallest value up to and with the row."""
    return Scan(value, "least")


def latest(value: Column) -> Scan:
    """Last value up to and with the row that is not null."""
    return Scan(value, "latest")


def previous(value: Column) -> Scan:
    """A struct whose ``v`` is the value of the row before; null for the first row."""
    return Scan(value, "previous")


def following(value: Column) -> Scan:
    """A struct whose ``v`` is the value of the row behind; null for the last row."""
    return Scan(value, "following")


def in_buckets(df: DataFrame, at: str, width: float) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(at) / width))


def scanned(df: DataFrame, scans: dict[str, Scan], order: list[str], width: float | None = None, at: str | None = None,
        keys: list[str] | None = None) -> DataFrame:
    """``df`` with a column for each scan along ``order``; ``at`` (the leading order column) must not fall along it."""
    keys = keys or ["session"]
    if width is None:
        line = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: scan.own(line) for name, scan in scans.items()})
    parts = [*keys, "_bucket"]
    cut = settled(in_buckets(df, at or order[0], width))
    line = Window.partitionBy(*parts).orderBy(*order)
    rows = cut.withColumns({f"_own_{name}": scan.own(line) for name, scan in scans.items()})
    states = cut.groupBy(*parts).agg(*[scan.state(F.struct(*order)).alias(f"_left_{name}") for name, scan in scans.items()])
    carried = states.select(*parts, *[scan.carry(f"_left_{name}", ["_bucket"], keys).alias(f"_from_{name}") for name, scan in scans.items()])
    joined = rows.join(carried, parts, "left")
    return joined.select(*df.columns, *[scan.join(F.col(f"_own_{name}"), F.col(f"_from_{name}")).alias(name) for name, scan in scans.items()])


def over_runs(df: DataFrame, run: str, value: Column, name: str, width: float | None = None, at: str = "time_us",
        keys: list[str] | None = None) -> DataFrame:
    """The sum of a value over all rows of a run, on each of them; with ``width`` first inside buckets, then over a run's buckets."""
    keys = keys or ["session"]
    if width is None:
        return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys, run)))
    parts = [*keys, "_bucket", run]
    cut = settled(in_buckets(df, at, width))
    inside = cut.groupBy(*parts).agg(F.sum(value).alias("_part"))
    whole = inside.select(*parts, F.sum("_part").over(Window.partitionBy(*keys, run)).alias(name))
    return cut.join(whole, parts, "left").select(*df.columns, name)


#: Ranges that values are counted in, and most values of a session that one task sorts.
RANGES, SORTED = 1024, 65_536


def medians(df: DataFrame, value: Column, name: str, keys: list[str] | None = None, ranges: int = RANGES, most: int = SORTED) -> DataFrame:
    """``keys, name``: the exact median of each session's finite values; null and NaN don't count, a session without values has no row.

    Values are counted in equal ranges between a session's least and largest one, with partial sums. The two middle ranks either stand
    at the ends of two ranges, or in one, which is cut again; each round drops its ends at least. Ranges of at most ``most`` values
    are sorted. A round is a job; a session's values are never in one buffer, and those of a session with more than ``most`` are never shuffled: its
    range is broadcast to them. Such sessions are at most the number of values over ``most``.
    """
    keys = keys or ["session"]
    values = settled(df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    n = F.count(F.lit(1))
    middle = values.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.floor((n - 1) / 2).alias("_a"),
        F.floor(n / 2).alias("_b"), n.alias("_n"))
    result, state = None, settled(middle)
    while True:
        large = state.filter("_n > %d and _lo < _hi" % most)
        short = state.filter("_n <= %d and _lo < _hi" % most)
        if result is None:
            inside = values.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(short, keys)
        else:
            inside = values.join(F.broadcast(short), keys).filter("_v between _lo and _hi")
        ordered = inside.groupBy(*keys, "_a", "_b").agg(F.sort_array(F.collect_list("_v")).alias("_all"))
        found = ordered.select(*keys, (F.element_at("_all", (F.col("_a") + 1).cast("int")) / 2
            + F.element_at("_all", (F.col("_b") + 1).cast("int")) / 2).alias(name))
        found = found.unionByName(state.filter("_lo = _hi").select(*keys, F.col("_lo").alias(name)))
        result = found if result is None else result.unionByName(found)
        if large.isEmpty():
            return settled(result)
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        dealt = values.join(F.broadcast(large), keys).filter("_v between _lo and _hi").withColumn("_range", F.least(F.floor(share * ranges), F.lit(ranges - 1)))
        counted = dealt.groupBy(*keys, "_a", "_b", "_range").agg(n.alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_n")
        placed = counted.withColumn("_before", before)
        has = lambda rank: (F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_before") + F.col("_n"))
        own = F.struct("_lo", "_hi", "_before", "_n", "_range")
        both = settled(placed.groupBy(*keys, "_a", "_b").agg(F.max(F.when(has("_a"), own)).alias("_x"), F.max(F.when(has("_b"), own)).alias("_y")))
        apart = both.filter("_x._range <> _y._range").select(*keys, (F.col("_x._hi") / 2 + F.col("_y._lo") / 2).alias(name))
        result = result.unionByName(apart)
        state = settled(both.filter("_x._range = _y._range").select(*keys, "_x._lo", "_x._hi", (F.col("_a") - F.col("_x._before")).alias("_a"),
            (F.col("_b") - F.col("_x._before")).alias("_b"), "_x._n"))
