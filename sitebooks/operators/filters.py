"""Row filters that reach the scan wherever the predicate allows it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.codes import is_blank


def newer_than(df: DataFrame, column: str, watermark: DataFrame, default: dt.datetime) -> DataFrame:
    """Rows later than a one-row watermark frame (its first column).

    The watermark is read as a scalar subquery by Spark, not fetched by the
    driver; an empty or null watermark counts as ``default``.
    """
    mark = watermark.select(
        F.coalesce(F.max(F.col(watermark.columns[0])), F.lit(default)).alias("_mark")
    )
    return df.where(F.col(column) > mark.scalar())


def keep_years(df: DataFrame, column: str, run_year: int, back: int, ahead: int) -> DataFrame:
    """Keep integer years ``run_year - back`` .. ``run_year + ahead``."""
    return df.where(F.col(column).between(run_year - back, run_year + ahead))


def reject_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where any named key is null or blank."""
    for name in columns:
        df = df.where(~is_blank(F.col(name)))
    return df


def since(df: DataFrame, column: str, first_day: dt.date) -> DataFrame:
    """First-load cut-off: keep instants on or after a day."""
    return df.where(F.col(column) >= F.lit(first_day))


def in_values(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Membership test: a literal list as ``IN``, a frame as a left-semi join."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(keys, column, "left_semi")
    return df.where(F.col(column).isin(list(values)))
