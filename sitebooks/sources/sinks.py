"""Writers.  Each runs exactly one job: the write itself."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from sitebooks.operators.project import conform, stamp
from sitebooks.operators.quality import unwatched
from sitebooks.sources.tables import published_watermark

MAX_TEXT = 2000


def write_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    merge_schema: bool = False,
    replace_schema: bool = False,
    rebalance: bool = True,
) -> None:
    """Write by location.  Never point it at the path the frame is read from.

    ``partition_by`` wants columns with few values (country, year): a directory
    per site would mean millions of small files.  The rows of a partitioned
    write are gathered per directory first; adaptive execution splits a large
    directory over several tasks and merges small ones.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``; others stay."""
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalog table: columns matched by name, cast to the table's types."""
    target = df.sparkSession.table(table).schema
    conform(df, target).write.insertInto(table)


def refresh_table(df: DataFrame, table: str) -> None:
    """Replace all rows of a catalog table, keeping its definition."""
    target = df.sparkSession.table(table).schema
    conform(df, target).write.insertInto(table, overwrite=True)


def replace_with_newer(source: DataFrame, table: str, column: str) -> dt.date:
    """Overwrite a published table with the source rows of later days; returns the old watermark.

    Rows without a date are not newer.  The watermark is read before the table
    is overwritten, and the source must not be the table itself.
    """
    mark = published_watermark(source.sparkSession, table, column)
    refresh_table(source.where(F.col(column) >= F.lit(mark + dt.timedelta(days=1))), table)
    return mark


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str | None = None,
    fmt: str = "parquet",
    replace: bool = False,
) -> None:
    """Create a curated table from a declared schema."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    options = {"path": location} if location else {}
    spark.catalog.createTable(name, source=fmt, schema=schema, **options)


def register_table(
    spark: SparkSession, name: str, location: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Register a table over existing data unless it is already there; its schema is read from the data with ``options``."""
    given = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} {f'OPTIONS ({given})' if given else ''} LOCATION '{location}'")


def guard_text(df: DataFrame, limit: int = MAX_TEXT, watch: Callable[..., DataFrame] = unwatched) -> DataFrame:
    """Cut text columns to the width of the warehouse column; ``watch`` counts the rows that lose text."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    longer = [F.coalesce(F.char_length(F.col(f"`{c}`")) > limit, F.lit(False)) for c in text]
    df = watch(df, "text cut", unreadable=reduce(Column.__or__, longer, F.lit(False)))
    return df.withColumns({c: F.substring(F.col(f"`{c}`"), 1, limit) for c in text})


def column_types(df: DataFrame, limit: int = MAX_TEXT) -> str:
    """``createTableColumnTypes`` text giving every text column a width."""
    return ", ".join(
        f"`{f.name}` VARCHAR({limit})"
        for f in df.schema.fields
        if isinstance(f.dataType, StringType)
    )


def warehouse_write_options(
    df: DataFrame, url: str, table: str, overwrite: bool, max_text: int | None, **extra: str
) -> dict[str, str]:
    """Options of a JDBC write; an overwrite truncates, so the table keeps its definition."""
    options = {"url": url, "dbtable": table, **extra}
    if overwrite:
        options["truncate"] = "true"
    if max_text is not None and column_types(df, max_text):
        options["createTableColumnTypes"] = column_types(df, max_text)
    return options


def write_warehouse(
    df: DataFrame,
    url: str,
    table: str,
    overwrite: bool = False,
    max_text: int | None = None,
    watch: Callable[..., DataFrame] = unwatched,
    **extra: str,
) -> None:
    """Append to or overwrite a warehouse table over JDBC; ``watch`` counts the rows whose texts are cut."""
    if max_text is not None:
        df = guard_text(df, max_text, watch)
    options = warehouse_write_options(df, url, table, overwrite, max_text, **extra)
    df.write.format("jdbc").mode("overwrite" if overwrite else "append").options(**options).save()


def arrays_as_text(df: DataFrame) -> DataFrame:
    """Array columns rendered as ``[a, b]``, for sinks without nested types."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: F.col(c).cast("string") for c in arrays})


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Text with a header; one file per task, arrays rendered as text."""
    arrays_as_text(df).write.mode("overwrite").option("sep", sep).option("header", "true").csv(path)


def publishable(
    df: DataFrame,
    columns: Mapping[str, str | Column] | None = None,
    stamp_column: str | None = "refresh_date",
    at: Column | None = None,
) -> DataFrame:
    """The frame a publish step writes: chosen columns and a refresh timestamp."""
    if columns is not None:
        df = df.select(
            *[(F.col(s) if isinstance(s, str) else s).alias(d) for d, s in columns.items()]
        )
    return stamp(df, stamp_column, at) if stamp_column else df


class NoRows(Exception):
    """Raised when a job that must produce rows produced none."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Return ``df``; raise :class:`NoRows` when it is empty (reads at most one row)."""
    if df.isEmpty():
        raise NoRows(f"{what}: no data available")
    return df


def rows_or_stop(df: DataFrame) -> bool:
    """True when there is something to do; False lets a job end early without an error."""
    return not df.isEmpty()
