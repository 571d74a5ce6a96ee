"""Unpivots, spines and total rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_months(
    df: DataFrame,
    ids: Sequence[str],
    months: Mapping[str, str],
    name: str = "calendar_month",
    value: str = "value",
) -> DataFrame:
    """One row per month column ``{label: column}``; null months are kept.

    All month columns are cast to one type first.  The rows are made by
    exploding an array, so the frame is read once and nothing is shuffled.
    """
    cells = F.array(
        *[
            F.struct(F.lit(label).alias(name), F.col(col).cast("double").alias(value))
            for label, col in months.items()
        ]
    )
    return df.select(*ids, F.explode(cells).alias("_cell")).select(*ids, "_cell.*")


def explode_structs(
    df: DataFrame, column: str, keep: Sequence[str], fields: Sequence[str] | None = None
) -> DataFrame:
    """Array of structs to rows; null and empty arrays give no row."""
    rows = df.select(*keep, F.explode(column).alias("_item"))
    if fields is None:
        return rows.select(*keep, "_item.*")
    return rows.select(*keep, *[F.col(f"_item.{f}").alias(f) for f in fields])


def month_spine(
    df: DataFrame, keys: Sequence[str], month: str, amounts: Sequence[str]
) -> DataFrame:
    """Twelve rows per key combination; months without a row get amount 0.

    The months of each key are collected by a grouped aggregate into one sum
    per month position and exploded again: one shuffle, at most 12 values held
    per key, and no join with a spine.
    """
    sums = [
        F.coalesce(
            F.sum(F.when(F.col(month) == m, F.col(a).cast("decimal(18,2)"))).cast("double"),
            F.lit(0.0),
        ).alias(f"_{a}_{m}")
        for a in amounts
        for m in range(1, 13)
    ]
    wide = df.groupBy(*keys).agg(*sums)
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias(month), *[F.col(f"_{a}_{m}").alias(a) for a in amounts]
            )
            for m in range(1, 13)
        ]
    )
    return wide.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")
