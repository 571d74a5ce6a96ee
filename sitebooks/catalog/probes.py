"""Data-quality probes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitebooks.catalog.registry import query, table
from sitebooks.operators import aggregates, quality


def _placed(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    return od.join(cu, od.o_custkey == cu.c_custkey, "left")


@query(
    "dq_null_counts",
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE c_custkey IS NULL) AS null_c_custkey,
              count(*) FILTER (WHERE c_mktsegment IS NULL) AS null_c_mktsegment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
         ON o_custkey = c_custkey""",
)
def dq_null_counts(spark, sf_dir):
    return quality.null_counts(_placed(spark, sf_dir), ["c_custkey", "c_mktsegment"])


@query(
    "dq_resolved_lookups",
    """SELECT count(*) FILTER (WHERE c_custkey IS NOT NULL) AS resolved,
              count(*) FILTER (WHERE c_custkey IS NULL) AS unresolved,
              count(*) FILTER (WHERE year(o_orderdate) = 1998) AS in_slice,
              count(*) FILTER (WHERE year(o_orderdate) <> 1998) AS out_of_slice
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
         ON o_custkey = c_custkey""",
)
def dq_resolved_lookups(spark, sf_dir):
    year = F.year("o_orderdate")
    return quality.conditional_counts(
        _placed(spark, sf_dir),
        {
            "resolved": F.col("c_custkey").isNotNull(),
            "unresolved": F.col("c_custkey").isNull(),
            "in_slice": year == 1998,
            "out_of_slice": year != 1998,
        },
    )


@query(
    "dq_domain",
    """SELECT o_orderpriority, count(*) AS row_count FROM orders GROUP BY 1""",
)
def dq_domain(spark, sf_dir):
    return quality.domain(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "dq_layer_counts",
    """SELECT 'landing' AS layer, count(*) AS row_count FROM lineitem
       UNION ALL SELECT 'curated', count(*) FROM orders
       UNION ALL SELECT 'published', count(*) FROM customer""",
)
def dq_layer_counts(spark, sf_dir):
    return quality.layer_counts(
        {
            "landing": table(spark, sf_dir, "lineitem"),
            "curated": table(spark, sf_dir, "orders"),
            "published": table(spark, sf_dir, "customer"),
        }
    )


@query(
    "dq_control_totals",
    """SELECT count(*) AS row_count,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
       FROM lineitem""",
)
def dq_control_totals(spark, sf_dir):
    return aggregates.control_totals(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"]
    )


@query(
    "dq_job_status",
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'success' ELSE 'failed' END
                AS status FROM orders""",
)
def dq_job_status(spark, sf_dir):
    jobs = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return quality.job_status(jobs, "o_orderpriority", "1").drop("o_orderpriority")
