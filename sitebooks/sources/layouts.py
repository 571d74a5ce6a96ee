"""Tables laid out so that a change or a question touches few of their files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitebooks.operators.mutate import upsert
from sitebooks.runtime import materialise
from sitebooks.sources.sinks import replace_partitions, write_files

BUCKET = "_bucket"


def drop_directories(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete directories of a table through the file service that holds them; absent ones are no error."""
    files = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        at = files.Path(path)
        at.getFileSystem(conf).delete(at, True)


# --- retention by partition --------------------------------------------------------


def purge_partitions(
    spark: SparkSession, path: str, part: str, at: str, cut: dt.date, table: str, run_year: int
) -> DataFrame:
    """Remove rows dated before ``cut`` from a table partitioned by the year of ``at``; gives the audit row.

    ``part`` is the partition column, ``path`` the table's location.  Years
    before the cut-off's go as whole directories, without reading a row of them
    beyond the audit's count; the cut-off's own year is rewritten by itself, and
    later years are neither read nor written.  Rows without a date lie in the
    null partition and stay.

    The kept rows of the boundary year are staged first, the audit is counted
    before anything is removed, and a repeated run changes nothing more.
    """
    stored = spark.read.parquet(path)
    year = F.col(part)
    old = stored.where((year < cut.year) | ((year == cut.year) & (F.col(at) < F.lit(cut))))
    removed = old.agg(F.count(F.lit(1))).first()[0]
    gone = [r[0] for r in stored.where(year < cut.year).select(part).distinct().collect()]  # one row per year
    boundary = stored.where(year == cut.year)
    if not boundary.where(F.col(at) < F.lit(cut)).isEmpty():
        kept = materialise(boundary.where(F.col(at) >= F.lit(cut)), "boundary-year")
        if kept.isEmpty():
            gone.append(cut.year)
        else:
            replace_partitions(kept, path, [part])
    drop_directories(spark, [f"{path}/{part}={y}" for y in gone])
    return spark.createDataFrame(
        [(table, removed, cut, run_year)], "table_name string, rows_removed long, removed_before date, run_year int"
    )


# --- upsert of touched buckets -----------------------------------------------------


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a table in one directory per hash bucket of its keys."""
    write_files(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, partition_by=[BUCKET])


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_buckets(
    source: DataFrame, path: str, keys: Sequence[str], buckets: int, order: Sequence[Column] = ()
) -> list[int]:
    """Upsert ``source`` into a table of :func:`write_buckets`; gives the buckets that were rewritten.

    Only the buckets that keys of the source fall into are read and written;
    the files of all others stay as they are.  Keys and repeated source rows are
    treated as by :func:`sitebooks.operators.mutate.upsert`.  The new buckets are
    staged before the table is touched, so the run can be repeated at any point.
    """
    spark = source.sparkSession
    fresh = materialise(source.withColumn(BUCKET, bucket_of(keys, buckets)), "upsert-source")
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    stored = spark.read.parquet(path)
    target = stored.where(F.col(BUCKET).isin(touched))
    merged = upsert(target, fresh.select(*stored.columns), [BUCKET, *keys], order)
    replace_partitions(materialise(merged, "upsert-buckets"), path, [BUCKET])
    return touched


# --- partitions chosen at run time -------------------------------------------------


def of_days(stored: DataFrame, day: str, days: DataFrame, first_day: dt.date) -> DataFrame:
    """Rows of a table partitioned by ``day`` for the days in ``days`` (a column of the same name), from ``first_day`` on.

    The distinct days are written first, so their size is known; where it is
    below Spark's broadcast threshold the scan lists only their partitions
    (dynamic partition pruning), else the days are joined.
    """
    asked = materialise(days.select(F.col(day).alias("_asked")).distinct(), "observed-days")
    asked = asked.where(F.col("_asked") >= F.lit(first_day))
    return stored.join(asked, F.col(day) == F.col("_asked"), "left_semi")


# --- clustered files ---------------------------------------------------------------


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int | None = None, group_bytes: int | None = None) -> None:
    """Write files that each hold a range of ``by`` and are ordered by it.

    Later filters on the leading columns then meet few row groups, as the
    footers tell the ranges.  ``files`` is the number of ranges (default: the
    shuffle's), ``group_bytes`` the size of a row group.
    """
    ordered = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = ordered.sortWithinPartitions(*by).write.mode("overwrite")
    if group_bytes:
        writer = writer.option("parquet.block.size", str(group_bytes))
    writer.parquet(path)


# --- watermarks from footers -------------------------------------------------------


def footer_extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_<c>`` and ``max_<c>`` of date, number or boolean columns, read from the footers of the files alone.

    The file reader that takes aggregates into its scan is an option of the
    session, so a sibling session plans this question.  Nulls are not counted,
    as in any aggregate; text and instants have no exact bounds in the footers,
    and Spark reads them from the rows instead.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    sibling.conf.set("spark.sql.sources.useV1SourceList", "")
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    stored = sibling.read.parquet(path)
    return stored.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])


def footer_watermark(spark: SparkSession, path: str, column: str, default: dt.date) -> dt.date:
    """Newest day in a table's column, from its footers; ``default`` for an empty table or one of nulls."""
    newest = footer_extremes(spark, path, [column]).first()[f"max_{column}"]
    return default if newest is None else newest
