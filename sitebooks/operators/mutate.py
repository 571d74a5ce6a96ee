"""Table changes expressed as DataFrame rewrites.

The results are written to a new location by the sinks; the path that is being
read is never overwritten in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType

from sitebooks.operators.joins import null_safe_join
from sitebooks.operators.sets import union_all
from sitebooks.operators.windows import latest_with_ties


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Update all columns of matching keys, insert the rest.

    Of several source rows with one key the first in ``order`` counts; without
    an order they are an error, raised when the result is computed.  Null keys
    never match, so such rows are all inserted.
    """
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    plain = [F.col(f.name) for f in source.schema.fields if "map<" not in f.dataType.simpleString()]
    same_key = Window.partitionBy(*keys, F.when(unknown, F.xxhash64(*plain)))
    if order:
        ranked = source.withColumn("_rn", F.row_number().over(same_key.orderBy(*order)))
        one = ranked.where(unknown | (F.col("_rn") == 1)).drop("_rn")
    else:
        twice = ~unknown & (F.count(F.lit(1)).over(same_key) > 1)
        checked = source.withColumn("_twice", twice)
        error = F.raise_error(F.lit(f"several source rows with one key ({', '.join(keys)})")).cast("boolean")
        one = checked.where(F.when(F.col("_twice"), error).otherwise(F.lit(True))).drop("_twice")
    kept = target.join(one.select(*keys), list(keys), "left_anti")
    return union_all([kept.select(*target.columns), one.select(*target.columns)])


def upsert_latest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], loaded_at: str
) -> DataFrame:
    """Union of both frames, keeping the rows of the newest load per key (ties kept)."""
    return latest_with_ties(union_all([source, target]), keys, loaded_at)


def conditional_update(df: DataFrame, column: str, test: Column, value) -> DataFrame:
    """Set ``column`` to ``value`` where ``test`` holds."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(test, new).otherwise(F.col(column)))


def _older(df: DataFrame, at: str, cut: int) -> Column:
    """``at``, a year number or a date, lies before the year ``cut``; dates are compared as they are stored."""
    if isinstance(df.schema[at].dataType, DatetimeType):
        return F.col(at) < F.lit(dt.date(cut, 1, 1))
    return F.col(at) < cut


def purge(df: DataFrame, at: str, run_year: int, keep_years: int = 4) -> DataFrame:
    """Rows a retention purge keeps: not older than ``run_year - keep_years``.

    ``at`` is a year column or, so that the scan can skip old files, a date or
    timestamp column.  A null is not older, so the row is kept.
    """
    return df.where(~_older(df, at, run_year - keep_years) | F.col(at).isNull())


def purge_audit(
    df: DataFrame, table: str, at: str, run_year: int, keep_years: int = 4
) -> DataFrame:
    """One audit row: table, rows removed, cut-off year, run year."""
    cut = run_year - keep_years
    return df.where(_older(df, at, cut)).agg(F.count(F.lit(1)).alias("rows_removed")).select(
        F.lit(table).alias("table_name"),
        "rows_removed",
        F.lit(cut).alias("removed_before"),
        F.lit(run_year).alias("run_year"),
    )


def changed_groups(df: DataFrame, group: str, ts: str, since: Column) -> DataFrame:
    """All rows of every group that holds at least one row newer than ``since``."""
    changed = df.where(F.col(ts) > since).select(group).distinct()
    return df.join(changed, group, "left_semi")


def latest_slice(df: DataFrame, ts: str) -> DataFrame:
    """Rows whose date equals the newest date in the frame.

    No row is newer than that day, so its begin as a lower bound on the plain
    column is enough, and the bound reaches the scan.
    """
    newest = df.select(F.max(F.to_date(ts)).alias("_newest"))
    return df.where(F.col(ts) >= newest.scalar())


def after_logged_day(
    df: DataFrame, log: DataFrame, group: str, day: str, logged: str
) -> DataFrame:
    """Rows of days after the last logged day of their group.

    A group without a log row is on its first run and keeps all days.
    """
    last = log.groupBy(group).agg(F.max(logged).alias("_logged"))
    joined = null_safe_join(df, last, [group], "left")
    return joined.where(F.col("_logged").isNull() | (F.col(day) > F.col("_logged"))).drop("_logged")
