"""Aggregates, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitebooks.catalog.registry import PLAN_SQL, TX_SQL, plan_lines, query, table, tx
from sitebooks.functions.calendar import MONTHS
from sitebooks.functions.money import exact, share
from sitebooks.operators import aggregates, reshape, windows


@query(
    "group_sum_count",
    """SELECT l_returnflag, l_linestatus,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
              count(*) AS row_count
       FROM lineitem GROUP BY 1, 2""",
)
def group_sum_count(spark, sf_dir):
    return aggregates.totals(
        table(spark, sf_dir, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        {"sum_qty": "l_quantity", "sum_price": "l_extendedprice"},
        "row_count",
    )


@query(
    "distinct_rows",
    """SELECT DISTINCT l_returnflag, l_linestatus, o_orderpriority, o_orderstatus
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def distinct_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return aggregates.dedupe_rows(
        li.join(od, li.l_orderkey == od.o_orderkey).drop("l_orderkey", "o_orderkey")
    )


@query(
    "dedupe_subset",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
           l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def dedupe_subset(spark, sf_dir):
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    return windows.dedupe(li, ["l_orderkey", "l_linenumber"], [F.col(c) for c in order]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query(
    "latest_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
           o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_by_key(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    return windows.latest_by(
        od, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]
    ).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "latest_ties_kept",
    """SELECT o_custkey, o_orderkey FROM (
         SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY
           date_trunc('month', o_orderdate) DESC) AS r FROM orders) WHERE r = 1""",
)
def latest_ties_kept(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.trunc(F.to_date("o_orderdate"), "month").alias("loaded")
    )
    return windows.latest_with_ties(od, ["o_custkey"], "loaded").drop("loaded")


@query(
    "partition_totals_share",
    f"""WITH {TX_SQL}
        SELECT event_id, CAST(sum(qty) OVER (PARTITION BY site) AS DOUBLE) AS site_vol,
               count(*) OVER (PARTITION BY site) AS site_txn,
               CAST(sum(qty) OVER (PARTITION BY site, product) AS DOUBLE) AS grade_vol,
               CAST(qty AS DOUBLE) * 100.0::DOUBLE /
                 CAST(sum(qty) OVER (PARTITION BY site) AS DOUBLE) AS perc_of_site
        FROM tx""",
)
def partition_totals_share(spark, sf_dir):
    """Group totals on every row, without gathering a group in one task."""
    rows = tx(spark, sf_dir).select("event_id", "SiteId", "productCode", "SALES_QUANTITY")
    rows = aggregates.with_totals(
        rows, ["SiteId"], {"site_vol": F.sum("SALES_QUANTITY"), "site_txn": F.count(F.lit(1))}
    )
    rows = aggregates.with_totals(
        rows, ["SiteId", "productCode"], {"grade_vol": F.sum("SALES_QUANTITY")}
    )
    return rows.select(
        "event_id",
        F.col("site_vol").cast("double").alias("site_vol"),
        "site_txn",
        F.col("grade_vol").cast("double").alias("grade_vol"),
        share(F.col("SALES_QUANTITY"), F.col("site_vol")).alias("perc_of_site"),
    )


@query(
    "running_ytd",
    f"""WITH {PLAN_SQL}, m AS (
          SELECT kpi, company, class, yr, mon, sum(amount) AS amount FROM plan GROUP BY ALL)
        SELECT kpi, company, class, yr, mon, CAST(amount AS DOUBLE) AS amount,
               CAST(sum(amount) OVER (PARTITION BY kpi, company, class, yr ORDER BY mon
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ytd
        FROM m""",
)
def running_ytd(spark, sf_dir):
    from sitebooks.functions.calendar import month_number

    keys = ["kpi", "company", "class", "yr"]
    lines = plan_lines(spark, sf_dir).select(
        F.col("KPI").alias("kpi"),
        F.col("Company_Code").alias("company"),
        F.col("Lease_Classification").alias("class"),
        F.col("Year").alias("yr"),
        month_number(F.col("Month")).alias("mon"),
        exact(F.col("Plan_Amount")).alias("amount"),
    )
    monthly = lines.groupBy(*keys, "mon").agg(F.sum("amount").alias("amount"))
    out = windows.running_sum(monthly, keys, ["mon"], {"ytd": "amount"})
    return out.withColumns({c: F.col(c).cast("double") for c in ("amount", "ytd")})


_PIVOT_SQL = """
p AS (SELECT o_orderpriority AS category, o_orderstatus AS project, {sums}
      FROM orders GROUP BY 1, 2)""".format(
    sums=", ".join(
        f"CAST(sum(CASE WHEN month(o_orderdate) = {i} AND o_orderstatus <> 'P' "
        f"THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {m}"
        for i, m in enumerate(MONTHS, 1)
    )
)


def wide_months(spark, sf_dir, *more):
    """Orders as a wide budget: one column per month, status P without values, and ``more`` aggregates."""
    od = table(spark, sf_dir, "orders")
    month = F.month("o_orderdate")
    return od.groupBy(
        F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("project")
    ).agg(
        *[
            F.sum(
                F.when((month == i) & (F.col("o_orderstatus") != "P"), exact(F.col("o_totalprice")))
            )
            .cast("double")
            .alias(m)
            for i, m in enumerate(MONTHS, 1)
        ],
        *more,
    )


@query(
    "unpivot_months",
    f"WITH {_PIVOT_SQL} "
    + " UNION ALL ".join(
        f"SELECT category, project, '{m}' AS calendar_month, {m} AS value FROM p" for m in MONTHS
    ),
)
def unpivot_months(spark, sf_dir):
    wide = wide_months(spark, sf_dir)
    return reshape.unpivot_months(wide, ["category", "project"], {m: m for m in MONTHS})


@query(
    "month_spine_densify",
    f"""WITH {PLAN_SQL}, k AS (SELECT DISTINCT company, site, yr FROM plan),
        s AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS mon),
        v AS (SELECT company, site, yr, mon, sum(amount) AS amount FROM plan GROUP BY ALL)
        SELECT k.company, k.site, k.yr, s.mon, CAST(coalesce(v.amount, 0) AS DOUBLE) AS amount
        FROM k CROSS JOIN s LEFT JOIN v
          ON v.company = k.company AND v.site = k.site AND v.yr = k.yr AND v.mon = s.mon""",
)
def month_spine_densify(spark, sf_dir):
    """Twelve rows per key from one aggregate; no join with a calendar."""
    from sitebooks.functions.calendar import month_number

    lines = plan_lines(spark, sf_dir).select(
        F.col("Company_Code").alias("company"),
        F.col("Site_ID").cast("long").alias("site"),
        F.col("Year").alias("yr"),
        month_number(F.col("Month")).alias("mon"),
        F.col("Plan_Amount").alias("amount"),
    )
    return reshape.month_spine(lines, ["company", "site", "yr"], "mon", ["amount"])


@query(
    "two_level_rollup",
    """WITH f AS (
         SELECT o_custkey, o_orderpriority, CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS flag,
                count(*) AS n
         FROM orders GROUP BY 1, 2)
       SELECT o_orderpriority, CAST(sum(flag) AS BIGINT) AS repeat_customers,
              CAST(sum(n) AS BIGINT) AS orders
       FROM f GROUP BY 1""",
)
def two_level_rollup(spark, sf_dir):
    """Flag groups, then count the flags per coarser group."""
    fine = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n")
    )
    return fine.groupBy("o_orderpriority").agg(
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("repeat_customers"),
        F.sum("n").alias("orders"),
    )


@query(
    "conditional_counts",
    """SELECT event_type, count(*) FILTER (WHERE value > 50) AS high,
              count(*) FILTER (WHERE value <= 50) AS low, count(DISTINCT user_id) AS users
       FROM events GROUP BY 1""",
)
def conditional_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("high"),
        F.count_if(F.col("value") <= 50).alias("low"),
        F.count_distinct("user_id").alias("users"),
    )

