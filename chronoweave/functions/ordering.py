"""Order inside a session: windows, edges, runs, closing rows, and keys that sort names the way people do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from chronoweave.functions.scans import previous, scanned, total
from chronoweave.functions.shared import settled

SESSION = ["session"]
ORDER = ["time_us", "seq"]


def in_order(keys: list[str] | None = None, order: list | None = None) -> WindowSpec:
    return Window.partitionBy(*(keys or SESSION)).orderBy(*(order or ORDER))


def so_far(keys: list[str] | None = None, order: list | None = None) -> WindowSpec:
    """Rows up to and with the current one."""
    return in_order(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(keys: list[str] | None = None, order: list | None = None) -> WindowSpec:
    """Rows before the current one."""
    return in_order(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def with_runs(df: DataFrame, value: str, name: str = "run", keys: list[str] | None = None, order: list | None = None,
        width: float | None = None, at: str | None = None) -> DataFrame:
    """Number of the run of equal values that a row stands in, from 1 on. ``width`` cuts long sessions, see ``scans``."""
    order = order or ORDER
    before = scanned(df, {"_before": previous(F.col(value))}, order, width, at, keys)
    changed = F.when(F.col("_before").isNull(), 1).otherwise((~F.col(value).eqNullSafe(F.col("_before.v"))).cast("int"))
    flagged = before.withColumn("_changed", changed).drop("_before")
    return scanned(flagged, {name: total(F.col("_changed"))}, order, width, at, keys).drop("_changed")


def no_negative_zero(value: Column) -> Column:
    """-0.0, and what is as good as zero, becomes 0.0."""
    return F.when((value <= 0) & (F.abs(value) <= 1e-8), F.lit(0.0)).otherwise(value)


def last_rows(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """The last row of each session, by one aggregation and no sort."""
    keys, order = keys or SESSION, order or ORDER
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_last")).select(*keys, "_last.*")


def close_open_end(df: DataFrame, value: str, off: object = 0, keys: list[str] | None = None) -> DataFrame:
    """A train that ends engaged gets one more row at the last time + 1 with the disengaged value."""
    tail = last_rows(df, keys).filter(F.col(value) != F.lit(off))
    tail = tail.withColumns({"time_us": F.col("time_us") + 1, "seq": F.col("seq") + 1, value: F.lit(off).cast(df.schema[value].dataType)})
    return df.unionByName(tail.select(*df.columns))


def natural_key(name: Column) -> Column:
    """Sort key that puts 2 before 10, for runs of digits of any length: how many digits, in ten places, and the digits without leading
    zeros; other text as it is. Names that differ in leading zeros alone have one key."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))

    def number(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+", "")
        return F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 10, "0"), digits)

    return F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), number(p)).otherwise(F.concat(F.lit("1"), p)))


def natural_sort(df: DataFrame, *names: str, nulls_last: bool = True) -> DataFrame:
    """Order by several names at once; the name itself breaks ties. Keys are columns before the sort, which otherwise would work them out
    again in each comparison."""
    made = {f"_key{k}": natural_key(F.col(name)) for k, name in enumerate(names)}
    keys = []
    for made_key, name in zip(made, names, strict=True):
        for key in (F.col(made_key), F.col(name)):
            keys.append(key.asc_nulls_last() if nulls_last else key.asc_nulls_first())
    return df.withColumns(made).orderBy(*keys).select(*df.columns)


def natural_places(df: DataFrame, *names: str, place: str = "place") -> DataFrame:
    """``df`` with each row's place from 1 on in natural order, over the whole table.

    Rows are sorted by ranges and numbered inside them; what is added are the heights of the ranges before, one number for each.
    """
    numbered = settled(natural_sort(df, *names).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    heights = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    base = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = heights.select("_part", base.alias("_base"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return numbered.withColumn("_part", part).join(F.broadcast(bases), "_part").select(*df.columns, (F.col("_base") + inside).alias(place))
