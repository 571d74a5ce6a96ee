"""Latest rows, running sums and threshold cut-offs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitebooks.operators.joins import may_match, null_safe_join


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (give a total order).

    Spark plans the ``row_number() = 1`` shape with a group limit in front of
    the shuffle, so each map task sends at most one row per key and a hot key
    does not pile up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_wide(
    df: DataFrame, keys: Sequence[str], newest: str, ties: Sequence[Column], seen: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """:func:`latest_by` for wide rows: largest ``newest`` first (nulls last), then ``ties``.

    The newest value of each key is found from these columns alone; rows that
    are older are dropped as they are read (:func:`may_match`), so only rows that
    may win are exchanged, once, and sorted behind the exchange.  A group limit
    in front of it would sort all rows, in as few tasks as the input has splits.
    ``seen`` is given the frame that all rows pass, to observe it.
    """
    top = df.groupBy(*keys).agg(F.max(newest).alias(newest))
    near = may_match(seen(df), [*keys, newest], top).repartition(*keys)
    return latest_by(near, keys, [F.col(newest).desc_nulls_last(), *ties])


def latest_with_ties(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """All rows that carry the newest ``ts`` of their key (null keys form one group).

    Aggregate plus join: ties may be many, and a join can be split by key skew
    where a ranking window could not.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    joined = null_safe_join(df, newest, keys, "inner")
    return joined.where(F.col(ts).eqNullSafe(F.col("_newest"))).drop("_newest")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per distinct key combination with a documented survivor."""
    return latest_by(df, keys, order)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str]
) -> DataFrame:
    """Running sums ``{out: column}`` from the first row of the partition to this one.

    Meant for aggregated frames, whose partitions are bounded (12 months, the
    queue lengths of one site).
    """
    w = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns({out: F.sum(src).over(w) for out, src in sums.items()})


def flag_until_threshold(
    df: DataFrame,
    pct: str,
    keys: Sequence[str],
    tie_break: Sequence[str],
    thresholds: Sequence[float],
    prefix: str = "needed",
) -> DataFrame:
    """Flag rows up to the first one whose ``pct`` reaches each threshold.

    Rows are ranked by ``pct`` within ``keys`` (ties by ``tie_break``).  The
    result has one row per input row and threshold: columns ``threshold`` and
    ``{prefix}`` (1 up to and including the cut-off row; 0 after it, and 0
    everywhere when the threshold is never reached).
    """
    w = Window.partitionBy(*keys)
    levels = F.explode(F.array(*[F.lit(float(t)) for t in thresholds]))
    ranked = df.withColumn("_rank", F.row_number().over(w.orderBy(pct, *tie_break)))
    long = ranked.withColumn("threshold", levels)
    per_level = Window.partitionBy(*keys, "threshold")
    cut = F.min(F.when(F.col(pct) >= F.col("threshold"), F.col("_rank"))).over(per_level)
    return long.withColumn(
        prefix, F.when(F.col("_rank") <= cut, 1).otherwise(0).cast("int")
    ).drop("_rank")


def count_until_threshold(
    df: DataFrame,
    pct: str,
    keys: Sequence[str],
    thresholds: Sequence[float],
    out: str = "needed",
) -> DataFrame:
    """Number of rows :func:`flag_until_threshold` would flag, per key and threshold.

    The count is "rows below the threshold, plus one" when the threshold is
    reached and 0 otherwise, which needs neither ranking nor sorting.
    """
    level = F.col("threshold")
    return (
        df.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
        .groupBy(*keys, "threshold")
        .agg(
            F.count_if(F.col(pct) < level).alias("_below"),
            F.count_if(F.col(pct) >= level).alias("_reached"),
        )
        .withColumn(
            out, F.when(F.col("_reached") > 0, F.col("_below") + 1).otherwise(F.lit(0))
        )
        .drop("_below", "_reached")
    )
