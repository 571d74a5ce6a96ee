"""Grouped aggregates; every one combines on the map side before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.money import exact_sum
from sitebooks.operators.joins import null_safe_join


def totals(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str] | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """Exact sums ``{out: amount column}`` and an optional row count, in one pass."""
    aggs = [exact_sum(F.col(src)).alias(out) for out, src in (sums or {}).items()]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(*keys).agg(*aggs)


def with_totals(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Add group totals to every row.

    Written as aggregate plus join rather than as a window: the aggregate
    combines before it shuffles, and a key that holds a large part of the rows
    is never gathered into one task.
    """
    small = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return null_safe_join(df, small, keys, "left")


def value_set(column: str) -> Column:
    """Sorted array of the distinct values of a column."""
    return F.array_sort(F.collect_set(column))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.distinct()


def control_totals(df: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """One row: number of rows and the exact sum of each amount."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[exact_sum(F.col(a)).alias(a) for a in amounts],
    )
