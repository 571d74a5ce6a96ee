"""Registration of queries and their SQL twins, and the shared table views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitebooks.functions.calendar import month_label
from sitebooks.runtime import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``(spark, sf_dir)`` and the SQL giving the same rows."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables.  Its timestamps carry no zone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_ts(ts: Column) -> Column:
    """Back to a timestamp without zone, the type of the driver's tables."""
    return ts.cast("timestamp_ntz")


# --- transactions: one per event ------------------------------------------------
#
# Ten users make a site, so the number of sites grows with the data.  The grade
# decides which three of six pumps serve it, so pump sets overlap in part.

TX_MARKERS = ("purchase-1", "error")

TX_SQL = """
tx AS (
  SELECT event_id, 'C' || CAST(CAST(floor(user_id / 10.0) AS BIGINT) % 3 AS VARCHAR) AS country,
         'G' || CAST(CAST(floor(user_id / 10.0) AS BIGINT) AS VARCHAR) AS site,
         event_type AS product,
         event_type || '-' || CAST(event_id % 2 AS VARCHAR) AS info,
         CAST(1 + (length(event_type) + event_id % 3) % 6 AS INTEGER) AS pump,
         CAST(value AS DECIMAL(20,2)) AS qty,
         ts AS start_ts, ts + to_hours(1 + event_id % 5) AS end_ts
  FROM events)"""


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pump transactions, under the names the pump jobs use."""
    ev = table(spark, sf_dir, "events")
    site_no = F.floor(F.col("user_id") / 10)
    start = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id",
        F.concat(F.lit("C"), (site_no % 3).cast("string")).alias("PartitionKey"),
        F.concat(F.lit("G"), site_no.cast("string")).alias("GlobalSiteId"),
        F.concat(F.lit("G"), site_no.cast("string")).alias("SiteId"),
        F.concat(F.lit("Site "), site_no.cast("string")).alias("siteName"),
        F.lit("City").alias("City"),
        F.concat("event_type", F.lit("-"), (F.col("event_id") % 2).cast("string")).alias(
            "additionalProductInfo"
        ),
        F.col("event_type").alias("productCode"),
        (F.lit(1) + (F.length("event_type") + F.col("event_id") % 3) % 6)
        .cast("int")
        .alias("pumpNumber"),
        F.col("value").cast("decimal(20,2)").alias("SALES_QUANTITY"),
        start.alias("transactionStartTime"),
        (start + F.make_dt_interval(hours=(1 + F.col("event_id") % 5).cast("int"))).alias(
            "transactionEndTime"
        ),
    )


# --- plan lines: one per line item ---------------------------------------------

PLAN_SQL = """
plan AS (
  SELECT l_returnflag AS kpi, o_orderpriority AS company, l_linestatus AS class,
         CAST(floor(l_suppkey / 10.0) AS BIGINT) AS site,
         CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(month(l_shipdate) AS INTEGER) AS mon,
         upper(strftime(l_shipdate, '%b')) AS mon_name,
         'CUR-' || substr(o_orderpriority, 1, 1) AS currency,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(l_quantity AS DECIMAL(18,2)) AS amount_usd,
         o_orderstatus AS submission, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def plan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders as plan lines, under the names the plan jobs use."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_shipdate", "l_extendedprice", "l_quantity",
    )
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    site = F.floor(F.col("l_suppkey") / 10)
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_returnflag").alias("KPI"),
        F.col("o_orderpriority").alias("Company_Code"),
        F.col("l_linestatus").alias("Lease_Classification"),
        site.cast("string").alias("Site_ID"),
        F.concat(F.lit("L"), site.cast("string")).alias("Lease_ID"),
        F.year("l_shipdate").alias("Year"),
        month_label(F.month("l_shipdate")).alias("Month"),
        F.concat(F.lit("CUR-"), F.substring("o_orderpriority", 1, 1)).alias("Local_Currency"),
        F.col("l_extendedprice").alias("Plan_Amount"),
        F.col("l_quantity").alias("Plan_Amount_USD"),
        F.col("o_orderstatus").alias("OP_Submissions"),
        F.col("l_orderkey").cast("string").alias("Transaction_ID"),
        F.col("l_linenumber"),
    )
