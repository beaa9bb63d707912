"""Data expectations: a check is a DataFrame of violations, ``check, key, message``; strict mode raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ExpectationError(ValueError):
    """Some rows violate an expectation."""


def violations(df: DataFrame, check: str, bad: Column, key: Column, message: Column | str) -> DataFrame:
    """The rows of ``df`` that fulfil ``bad``."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.filter(bad).select(F.lit(check).alias("check"), key.cast("string").alias("key"), text.alias("message"))


def known_labels(df: DataFrame, column: str, allowed: list[str], key: str) -> DataFrame:
    """B1, B2: values outside a closed list, null included."""
    inside = F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return violations(df, f"{column} is known", ~inside, F.col(key),
        F.concat(F.lit("unknown value "), F.coalesce(F.col(column).cast("string"), F.lit("none"))))


def same_heights(left: DataFrame, right: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Groups whose numbers of rows differ."""
    a, b = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "_a"), (right, "_b")))
    both = a.join(b, keys, "full").withColumns({"_a": F.coalesce("_a", F.lit(0)), "_b": F.coalesce("_b", F.lit(0))})
    return violations(both, check, F.col("_a") != F.col("_b"), F.concat_ws("/", *keys), F.format_string("%d and %d rows", "_a", "_b"))


def undescribed(df: DataFrame, described: set[str]) -> list[str]:
    """Columns that have no description."""
    return [c for c in df.columns if c not in described]


def require(found: DataFrame, most: int = 5) -> None:
    """Strict mode: raise if there are violations, naming a few."""
    rows = found.limit(most).collect()
    if rows:
        raise ExpectationError("; ".join(f"{r['check']}: {r['key']}: {r['message']}" for r in rows))


def asserted(value: Column, good: Column, message: str) -> Column:
    """A value that fails the job where it isn't good."""
    return F.when(good, value).otherwise(F.raise_error(F.lit(message)))
