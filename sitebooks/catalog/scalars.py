"""Scalar function families."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import plain_ts, query, table
from sitebooks.functions import calendar, codes, money, text


@query(
    "string_functions",
    """SELECT p_partkey, p_brand || '/' || p_type AS joined, left(p_name, 3) AS head,
              right(p_name, 3) AS tail, replace(p_brand, '#', '') AS stripped,
              upper(trim(p_type)) AS up, substring(p_name, 2, 4) AS mid,
              p_name LIKE '%ring' AS is_ring,
              p_brand || p_type || CAST(p_size AS VARCHAR) AS composite
       FROM part""",
)
def string_functions(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.left("p_name", F.lit(3)).alias("head"),
        F.right("p_name", F.lit(3)).alias("tail"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("stripped"),
        F.upper(F.trim("p_type")).alias("up"),
        F.substring("p_name", 2, 4).alias("mid"),
        F.col("p_name").like("%ring").alias("is_ring"),
        codes.composite_key(F.col("p_brand"), F.col("p_type"), F.col("p_size")).alias("composite"),
    )


@query(
    "strip_prefix_codes",
    """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code,
              CASE WHEN left(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 2) = '00'
                   THEN substring(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 3)
                   ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS stripped
       FROM customer""",
)
def strip_prefix_codes(spark, sf_dir):
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", code.alias("code"), codes.strip_zero_pair(code).alias("stripped")
    )


@query(
    "regex_class",
    """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)RING|B.LT|frei (2)')
                              THEN p_name ELSE 'other' END AS product_class
       FROM part""",
)
def regex_class(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        codes.product_class(F.col("p_name"), ("RING", "B.LT", "frei (2)"), "other").alias(
            "product_class"
        ),
    )


@query(
    "month_name_roundtrip",
    """SELECT o_orderkey, upper(strftime(o_orderdate, '%b')) AS month_name,
              CAST(month(o_orderdate) AS INTEGER) AS month_no,
              upper(strftime(o_orderdate, '%b')) AS again
       FROM orders""",
)
def month_name_roundtrip(spark, sf_dir):
    name = F.date_format("o_orderdate", "MMM")
    number = calendar.month_number(name)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.upper(name).alias("month_name"),
        number.alias("month_no"),
        calendar.month_label(number).alias("again"),
    )


@query(
    "fiscal_period",
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH, '0%m.%Y')
                AS fiscal_period
       FROM orders""",
)
def fiscal_period(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", calendar.fiscal_period(F.col("o_orderdate")).alias("fiscal_period")
    )


@query(
    "quarter_calendar",
    """SELECT o_orderkey, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_name,
              CAST(quarter(o_orderdate) * 3 AS INTEGER) AS quarter_end_month
       FROM orders""",
)
def quarter_calendar(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        calendar.quarter_label(F.col("o_orderdate")).alias("quarter_name"),
        calendar.quarter_end_month(F.month("o_orderdate")).alias("quarter_end_month"),
    )


@query(
    "datetime_functions",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hr,
              CAST(minute(ts) AS INTEGER) AS mi, ts + INTERVAL 15 MINUTE AS later,
              ts - INTERVAL 1 MINUTE AS earlier,
              CAST(CAST(ts AS DATE) + INTERVAL 2 MONTH AS DATE) AS in_two_months,
              strftime(ts, '%Y-%m') AS year_month, DATE '2024-02-01' AS run_date,
              TRY_CAST(props AS INTEGER) AS not_a_number
       FROM events""",
)
def datetime_functions(spark, sf_dir):
    run = dt.date(2024, 2, 1)
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.hour(ts).alias("hr"),
        F.minute(ts).alias("mi"),
        F.expr("ts + INTERVAL 15 MINUTES").alias("later"),
        F.expr("ts - INTERVAL 1 MINUTE").alias("earlier"),
        F.add_months(F.to_date(ts), 2).alias("in_two_months"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
        F.lit(run).alias("run_date"),
        F.col("props").try_cast("int").alias("not_a_number"),
    )


@query(
    "time_zone_parts",
    """SELECT event_id, timezone('Europe/Paris', timezone('UTC', ts)) AS local_ts,
              CAST(hour(timezone('Europe/Paris', timezone('UTC', ts))) AS INTEGER) AS local_hour
       FROM events""",
)
def time_zone_parts(spark, sf_dir):
    local = calendar.local_time(F.col("ts").cast("timestamp"), "Europe/Paris")
    return table(spark, sf_dir, "events").select(
        "event_id", plain_ts(local).alias("local_ts"), F.hour(local).alias("local_hour")
    )


@query(
    "numeric_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round(CAST(l_extendedprice AS DECIMAL(18,2)), 1)::DOUBLE AS rounded,
              1.0::DOUBLE / l_quantity AS reciprocal,
              l_discount * 100.0::DOUBLE / l_quantity AS share,
              greatest(CAST(l_quantity AS INTEGER) + 1 - 25, 0) AS queue
       FROM lineitem""",
)
def numeric_functions(spark, sf_dir):
    qty = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(money.exact(F.col("l_extendedprice")), 1).cast("double").alias("rounded"),
        F.try_divide(F.lit(1.0), qty).alias("reciprocal"),
        money.share(F.col("l_discount"), qty).alias("share"),
        money.bounded_queue(qty.cast("int"), F.lit(25)).alias("queue"),
    )


@query(
    "json_parse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def json_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.parsed(F.col("props"), "k int")["k"].alias("k")
    )


@query(
    "array_functions",
    """WITH sets AS (
         SELECT user_id, CAST(ts AS DATE) AS day,
                list_sort(list(DISTINCT CAST(event_id % 6 AS INTEGER))) AS pumps
         FROM events GROUP BY 1, 2)
       SELECT array_to_string(pumps, ',') AS pumps, count(*) AS user_days,
              CAST(len(pumps) AS INTEGER) AS n_pumps, list_contains(pumps, 3) AS has_three,
              list_has_any(pumps, [0, 1]) AS has_low
       FROM sets GROUP BY pumps""",
)
def array_functions(spark, sf_dir):
    sets = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.array_sort(F.collect_set((F.col("event_id") % 6).cast("int"))).alias("pumps")
    )
    return sets.groupBy("pumps").agg(F.count(F.lit(1)).alias("user_days")).select(
        F.array_join("pumps", ",").alias("pumps"),
        "user_days",
        F.size("pumps").alias("n_pumps"),
        F.array_contains("pumps", 3).alias("has_three"),
        F.arrays_overlap("pumps", F.array(F.lit(0), F.lit(1))).alias("has_low"),
    )


@query(
    "surrogate_id",
    """SELECT count(DISTINCT event_id) AS ids, count(*) AS row_count FROM events""",
)
def surrogate_id(spark, sf_dir):
    """Hash ids need no global ordering; as many ids as natural keys."""
    ids = table(spark, sf_dir, "events").select(
        codes.row_key(F.col("event_id"), F.col("ts"), F.col("user_id")).alias("txn_id")
    )
    return ids.agg(
        F.count_distinct("txn_id").alias("ids"), F.count(F.lit(1)).alias("row_count")
    )


@query(
    "case_country_map",
    """SELECT n.n_nationkey, r.r_name AS region_name, n.mapped AS country
       FROM (SELECT *, CASE WHEN n_name = 'NATION_1' THEN 'United States of America'
                            WHEN n_name = 'NATION_2' THEN 'United Kingdom'
                            ELSE n_name END AS mapped FROM nation) n
       JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def case_country_map(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    names = {"NATION_1": "United States of America", "NATION_2": "United Kingdom"}
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        F.col("r_name").alias("region_name"),
        codes.recode(F.col("n_name"), names).alias("country"),
    )
