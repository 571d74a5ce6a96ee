"""Scans, projections, filters and sorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import query, table
from sitebooks.functions.calendar import in_year, last_complete_years
from sitebooks.functions.money import exact_sum
from sitebooks.operators import filters, project
from sitebooks.runtime import materialise


@query(
    "scan_project_rename",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status_code,
              CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS lc_amount,
              CAST(o_orderdate AS DATE) AS effective_date
       FROM orders""",
)
def scan_project_rename(spark, sf_dir):
    out = project.project(
        table(spark, sf_dir, "orders"),
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "status_code": "o_orderstatus",
            "amount": F.col("o_totalprice").cast("decimal(18,2)").cast("double"),
            "order_date": F.col("o_orderdate").cast("date"),
        },
    )
    return project.rename(
        out, {"amount": "lc_amount", "order_date": "effective_date", "absent": "ignored"}
    )


@query(
    "columns_shape",
    """SELECT 'ACTUAL' AS LE_ACTUAL_PLAN, l_orderkey AS L_ORDERKEY, l_linenumber AS L_LINENUMBER,
              CAST(NULL AS VARCHAR) AS LEGALLY_COMMITTED,
              round(l_extendedprice, 2) AS L_EXTENDEDPRICE,
              l_quantity * 2.0 AS DOUBLE_QUANTITY
       FROM lineitem""",
)
def columns_shape(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax", "l_discount"
    )
    li = li.select("*", (F.col("l_quantity") * 2.0).alias("double_quantity"))
    li = project.drop_all(li, ["l_tax", "l_discount", "l_quantity", "no_such_column"])
    li = project.constants(
        li, {"le_actual_plan": ("ACTUAL", "string"), "legally_committed": (None, "string")}
    )
    li = project.upper_names(project.round_columns(li, ["l_extendedprice"]))
    return li.select(
        "LE_ACTUAL_PLAN", "L_ORDERKEY", "L_LINENUMBER", "LEGALLY_COMMITTED", "L_EXTENDEDPRICE",
        "DOUBLE_QUANTITY",
    )


@query(
    "null_fill",
    """SELECT o.o_orderkey, coalesce(CAST(c.c_acctbal AS DOUBLE), 0) AS balance,
              coalesce(c.c_mktsegment, 'none') AS segment
       FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
         ON o.o_custkey = c.c_custkey""",
)
def null_fill(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = od.join(cust, od.o_custkey == cust.c_custkey, "left").select(
        "o_orderkey", F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    return project.fill_zero(out, ["balance"]).select(
        "o_orderkey", "balance", F.coalesce("c_mktsegment", F.lit("none")).alias("segment")
    )


@query(
    "filters_basic",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders
       WHERE o_totalprice BETWEEN 1000 AND 400000 AND lower(o_orderstatus) IN ('f', 'o')
         AND o_orderpriority IS NOT NULL AND o_orderpriority NOT LIKE '5%'
         AND trim(o_orderpriority) <> ''
       GROUP BY 1, 2""",
)
def filters_basic(spark, sf_dir):
    od = table(spark, sf_dir, "orders").where(
        F.col("o_totalprice").between(1000, 400000)
        & F.lower("o_orderstatus").isin("f", "o")
        & F.col("o_orderpriority").isNotNull()
        & ~F.col("o_orderpriority").like("5%")
    )
    od = filters.reject_blank(od, "o_orderpriority")
    return od.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("o_totalprice")).alias("amount")
    )


@query(
    "relative_year_filters",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr,
              count(*) FILTER (WHERE year(o_orderdate) BETWEEN 1999 AND 2010) AS rolling,
              count(*) FILTER (WHERE year(o_orderdate) IN (1999, 2000, 2001)) AS around,
              count(*) FILTER (WHERE year(o_orderdate) IN (1998, 1999)) AS last_two,
              count(*) FILTER (WHERE year(o_orderdate) = 2000) AS run_year
       FROM orders WHERE o_orderdate >= DATE '1996-06-01' GROUP BY 1""",
)
def relative_year_filters(spark, sf_dir):
    run = dt.date(2000, 6, 15)
    od = filters.since(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(1996, 6, 1))
    year, ts = F.year("o_orderdate"), F.col("o_orderdate")
    return od.groupBy(year.alias("yr")).agg(
        F.count_if(year.between(run.year - 1, run.year + 10)).alias("rolling"),
        F.count_if(year.isin(run.year - 1, run.year, run.year + 1)).alias("around"),
        F.count_if(last_complete_years(ts, run)).alias("last_two"),
        F.count_if(in_year(ts, run.year)).alias("run_year"),
    )


@query(
    "sorted_output",
    """SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
       ORDER BY r_name, n_name DESC""",
)
def sorted_output(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = n.join(r, n.n_regionkey == r.r_regionkey).select("r_name", "n_name")
    return joined.orderBy(F.asc("r_name"), F.desc("n_name"))


@query(
    "scalar_extremes",
    """SELECT max(o_totalprice) AS max_amount, max(o_orderpriority) AS max_text,
              CAST(max(o_orderdate) AS DATE) AS last_day,
              (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
                AS top_order
       FROM orders""",
)
def scalar_extremes(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    return od.agg(
        F.max("o_totalprice").alias("max_amount"),
        F.max("o_orderpriority").alias("max_text"),
        F.max("o_orderdate").cast("date").alias("last_day"),
        F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("top_order"),
    )


@query(
    "materialised_stage",
    """SELECT o_orderstatus, count(*) AS n,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders GROUP BY 1""",
)
def materialised_stage(spark, sf_dir):
    """A stage written to shared scratch space and read back by the next one."""
    od = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")
    return materialise(od, "stage").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("o_totalprice")).alias("amount")
    )
