"""Catalog tables and the JDBC warehouse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Where loading begins when a table is empty, and when there is none.
EMPTY_WATERMARK, MISSING_WATERMARK = dt.date(1000, 1, 1), dt.date(1001, 1, 1)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)


def published_watermark(spark: SparkSession, name: str, column: str) -> dt.date:
    """Newest day in a column of a published table, or the first watermarks where there is none.

    Only a missing table is told apart; any other error is raised.
    """
    if not spark.catalog.tableExists(name):
        return MISSING_WATERMARK
    newest = spark.table(name).agg(F.max(F.to_date(column))).first()[0]
    return EMPTY_WATERMARK if newest is None else newest


def read_location(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table by location, in any format Spark has on its class path."""
    return spark.read.format(fmt).load(path)


def warehouse_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read: a table or a query, and a parallel split.

    Without ``partition_column`` the whole table arrives through one
    connection, so large tables should always name one.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, **extra}
    if table is not None:
        options["dbtable"] = table
    else:
        options["query"] = query
    if partition_column is not None:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        if query is not None:
            options.pop("query")
            options["dbtable"] = f"({query}) part_source"
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_warehouse(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """Read a warehouse table or a pushed-down query over JDBC."""
    return spark.read.format("jdbc").options(**warehouse_options(url, **kwargs)).load()
