"""Upserts, updates and incremental extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import query, table
from sitebooks.operators import filters, mutate
from sitebooks.plans.assets import high_watermark
from sitebooks.sources import sinks
from sitebooks.runtime import scratch_dir


def _changed_customers(cust):
    """Half of the segments changed, plus one new customer per existing one of another."""
    changed = cust.where("c_mktsegment < 'G'").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    new = cust.where("c_mktsegment >= 'M'").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return changed.unionByName(new)


@query(
    "upsert_keys",
    """SELECT c_custkey, CASE WHEN c_mktsegment < 'G' THEN c_acctbal + 1 ELSE c_acctbal END
                AS c_acctbal FROM customer
       UNION ALL
       SELECT -c_custkey - 1, c_acctbal FROM customer WHERE c_mktsegment >= 'M'""",
)
def upsert_keys(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return mutate.upsert(cust, _changed_customers(cust), ["c_custkey"]).select(
        "c_custkey", "c_acctbal"
    )


@query(
    "conditional_update",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END
                AS o_orderstatus FROM orders""",
)
def conditional_update(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return mutate.conditional_update(od, "o_orderstatus", F.col("o_orderstatus") == "P", "")


@query(
    "high_watermark_filter",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >
         coalesce((SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1998-07-01'),
                  TIMESTAMP '2020-01-01 00:00:00')""",
)
def high_watermark_filter(spark, sf_dir):
    od = table(spark, sf_dir, "orders").withColumn("at", F.col("o_orderdate").cast("timestamp"))
    target = od.where("o_orderdate < DATE '1998-07-01'")
    fresh = filters.newer_than(od, "at", high_watermark(target, "at"), dt.datetime(2020, 1, 1))
    return fresh.select("o_orderkey", "o_totalprice")


@query(
    "semi_changed_groups",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
         SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01 00:00:00')""",
)
def semi_changed_groups(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    since = F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    return mutate.changed_groups(od, "o_custkey", "o_orderdate", since).select(
        "o_orderkey", "o_custkey"
    )


@query(
    "extract_since_target",
    """WITH mark AS (SELECT coalesce(max(o_orderdate), TIMESTAMP '1000-01-01 00:00:00') AS m
                     FROM orders WHERE o_orderdate < DATE '2001-05-01')
       SELECT o_orderkey, strftime(o_orderdate, '0%m.%Y') AS fiscal_period FROM orders
       WHERE strftime(o_orderdate, '0%m.%Y') IN (
         SELECT strftime(o_orderdate, '0%m.%Y') FROM orders WHERE o_orderdate > (SELECT m FROM mark))""",
)
def extract_since_target(spark, sf_dir):
    """All rows of the fiscal periods that changed since the target was loaded."""
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.date_format("o_orderdate", "'0'MM.yyyy").alias("fiscal_period"),
    )
    target = od.where("o_orderdate < DATE '2001-05-01'")
    never = F.lit("1000-01-01 00:00:00").cast("timestamp_ntz")
    mark = target.select(F.coalesce(F.max("o_orderdate"), never).alias("m"))
    return mutate.changed_groups(od, "fiscal_period", "o_orderdate", mark.scalar()).select(
        "o_orderkey", "fiscal_period"
    )


@query(
    "latest_snapshot",
    """SELECT event_id, user_id FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def latest_snapshot(spark, sf_dir):
    return mutate.latest_slice(table(spark, sf_dir, "events"), "ts").select("event_id", "user_id")


@query(
    "dated_catch_up",
    """WITH log AS (SELECT event_type, max(CAST(ts AS DATE)) - 3 AS last_day FROM events
                    WHERE event_type <> 'error' GROUP BY 1)
       SELECT e.event_id, e.event_type, CAST(e.ts AS DATE) AS day FROM events e
       LEFT JOIN log ON e.event_type = log.event_type
       WHERE log.last_day IS NULL OR CAST(e.ts AS DATE) > log.last_day""",
)
def dated_catch_up(spark, sf_dir):
    """Days after the logged one per event type; a type without a log takes all days."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("day")
    )
    log = ev.where("event_type <> 'error'").groupBy("event_type").agg(
        F.date_sub(F.max("day"), 3).alias("last_day")
    )
    return mutate.after_logged_day(ev, log, "event_type", "day", "last_day")


@query(
    "refresh_and_append",
    """SELECT s_suppkey, s_acctbal FROM supplier
       UNION ALL SELECT -s_suppkey - 1, s_acctbal FROM supplier WHERE s_acctbal < 0""",
)
def refresh_and_append(spark, sf_dir):
    """A full refresh followed by an append, both written and read back."""
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    path = scratch_dir(spark, "refresh")
    sinks.write_files(su, path)
    more = su.where("s_acctbal < 0").withColumn("s_suppkey", -F.col("s_suppkey") - 1)
    sinks.write_files(more, path, mode="append")
    return spark.read.schema(su.schema).parquet(path)
