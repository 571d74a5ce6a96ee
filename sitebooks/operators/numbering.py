"""Gapless numbers over a whole table without ordering it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitebooks.operators.intervals import _bucket, packed
from sitebooks.runtime import materialise

#: Width of a time bucket; narrower ones split a busy key further.
NUMBER_SECONDS = 3600


def starts(counts: DataFrame, order: Sequence[str], count: str, out: str) -> DataFrame:
    """``order`` columns and ``out``: the sum of ``count`` over all rows before, in the order of these columns (nulls first).

    The rows (one per group, few against the table behind them) are cut in
    ranges; a range sums its own rows, and only one total per range, as many as
    there are shuffle partitions, comes to the driver.
    """
    ordered = [F.asc_nulls_first(c) for c in order]
    placed = counts.repartitionByRange(*ordered).withColumn("_range", F.spark_partition_id())
    placed = materialise(placed, "group-counts")  # ranges must not be drawn twice
    totals = sorted(tuple(r) for r in placed.groupBy("_range").agg(F.sum(count)).collect())
    before = [0, *accumulate(n for _, n in totals)]
    known = placed.sparkSession.createDataFrame(
        [(p, n) for (p, _), n in zip(totals, before)], "_of int, _before long"
    )
    earlier = Window.partitionBy("_range").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(count).over(earlier), F.lit(0))
    return (
        placed.select(*order, "_range", own.alias("_own"))
        .join(known, F.col("_range") == F.col("_of"))
        .select(*order, (F.col("_own") + F.col("_before")).alias(out))
    )


def numbered(
    df: DataFrame,
    out: str,
    keys: Sequence[str],
    at: str,
    tie: Sequence[str],
    bucket_seconds: int = NUMBER_SECONDS,
) -> DataFrame:
    """Number all rows 1, 2, 3 ... in the order of ``keys``, ``at`` and ``tie`` (nulls first in each).

    Equal to ``row_number()`` over the whole table, in two steps: rows are
    numbered within (keys, time bucket), and a bucket's number starts behind the
    rows of all buckets before it (:func:`starts`).  The start travels as the
    first row of its bucket, so the rows are exchanged once and a busy key is
    spread over its buckets.  Rows without a time form one bucket per key.
    ``tie`` must tell the rows of one key and instant apart, else their order
    among each other is open.
    """
    cut = df.withColumn("_b", _bucket(F.col(at), bucket_seconds))
    counts = cut.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    rows = cut.select(
        *keys, "_b", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_start"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate([at, *tie])], packed(df).alias("_row"),
    )
    empty = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields}
    first = starts(counts, [*keys, "_b"], "_n", "_start").withColumn("_kind", F.lit(0))
    first = first.select(*[c if c in first.columns else empty[c].alias(c) for c in rows.columns])
    order = [F.asc_nulls_first(f"_o{i}") for i in range(len(tie) + 1)]
    place = Window.partitionBy(*keys, "_b").orderBy("_kind", *order)
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.row_number().over(place) - 1 + F.first("_start").over(so_far)
    return (
        rows.unionByName(first)
        .select("_kind", "_row", number.cast("long").alias(out))
        .where("_kind = 1")
        .select(F.inline("_row"), out)
    )
