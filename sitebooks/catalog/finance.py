"""Exchange rates, budgets, book values, tax rates and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import query, table
from sitebooks.catalog.summaries import _PIVOT_SQL, wide_months
from sitebooks.functions.calendar import MONTHS
from sitebooks.plans import assets, budget, fx, retention
from sitebooks.schemas import schema


def raw_rates(spark, sf_dir):
    """Orders as a rate feed: inverted date, signed rate text, three currencies."""
    od = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return od.select(
        "o_orderkey",
        F.lit("ZQ1").alias("Exchanage_Rate_Type_Period"),
        F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("From_Currency_Code"),
        F.when(F.col("o_orderstatus") == "F", "USD").otherwise("EUR").alias("To_Currency_Code"),
        (F.lit(99999999) - F.date_format("o_orderdate", "yyyyMMdd").cast("int")).alias(
            "effective_from_date"
        ),
        F.when(
            F.col("o_orderstatus") == "F", F.concat(price, F.lit("-"))
        ).otherwise(price).alias("Exchanage_Rate"),
        F.lit(1).alias("Ratio_From_Currency_Unit"),
        F.lit(1).alias("Ratio_To_Currency_Unit"),
    )


@query(
    "fx_normalise",
    """SELECT 'ZQ1' AS Exchange_Rate_Period_Type_Code,
              'C' || substr(o_orderpriority, 1, 1) AS From_Currency_Code,
              CASE WHEN o_orderstatus = 'F' THEN 'USD' ELSE 'EUR' END AS To_Currency_Code,
              CAST(o_orderdate AS DATE) AS Effective_From_Date,
              CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE / o_totalprice
                   ELSE o_totalprice END AS Exchanage_Rate,
              1.0::DOUBLE AS Ratio_From_Currency_Unit_Number,
              1.0::DOUBLE AS Ratio_To_Currency_Unit_Number
       FROM orders""",
)
def fx_normalise(spark, sf_dir):
    return fx.normalise_rates(raw_rates(spark, sf_dir)).drop("Create_Date")


@query(
    "negative_rates",
    """SELECT DISTINCT 'N' || o_orderstatus AS Exchanage_Rate_Type_Period FROM orders
       WHERE o_orderstatus <> 'F' AND -o_totalprice < 0""",
)
def negative_rates(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("N"), "o_orderstatus").alias("Exchanage_Rate_Type_Period"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
        .otherwise(-F.col("o_totalprice"))
        .cast("string")
        .alias("Exchanage_Rate"),
    )
    return fx.negative_rate_types(raw)


@query(
    "monthly_budget",
    f"WITH {_PIVOT_SQL}, d AS (SELECT o_orderpriority, o_orderstatus, max(o_orderdate) AS ing "
    "FROM orders GROUP BY 1, 2), w AS (SELECT p.*, d.ing FROM p JOIN d ON category = "
    "o_orderpriority AND project = o_orderstatus) "
    + " UNION ALL ".join(
        "SELECT CAST(ing AS DATE) AS ingested, category AS Capex_Category_Type_Code, "
        f"project AS Project_Name, '{m}' AS Calender_MONTH, {m} AS VALUE, "
        "CAST(year(ing) AS INTEGER) AS Calendar_year, "
        "'Q' || CAST(quarter(ing) AS VARCHAR) AS Quarter_Number FROM w"
        for m in MONTHS
    ),
)
def monthly_budget(spark, sf_dir):
    return budget.monthly_budget(
        budget_lines(spark, sf_dir), months={m: m for m in MONTHS}
    ).select(
        F.to_date("Ingestion_Revision_Date").alias("ingested"),
        "Capex_Category_Type_Code", "Project_Name", "Calender_MONTH", "VALUE", "Calendar_year",
        "Quarter_Number",
    )


def budget_lines(spark, sf_dir):
    """The wide budget with an ingestion date per line (the newest order)."""
    wide = wide_months(spark, sf_dir, F.max("o_orderdate").alias("Ingestion_Revision_Date"))
    return wide.withColumnsRenamed({"category": "Capex_Category_Type_Code", "project": "Project_Name"})


_RATES_SQL = """
d AS (SELECT o_orderpriority, o_orderstatus, max(o_orderdate) AS ing FROM orders GROUP BY 1, 2),
le AS (
  SELECT 'C' || substr(category, 1, 1) AS cur, category, project, ing, mname, mno, v FROM (
    SELECT p.category, p.project, d.ing, u.mname, u.mno,
           CASE u.mno {cases} END AS v
    FROM p JOIN d ON category = o_orderpriority AND project = o_orderstatus
    CROSS JOIN (SELECT unnest([{names}]) AS mname, unnest(range(1, 13)) AS mno) u)
  WHERE v IS NOT NULL),
pr AS (SELECT 'C' || substr(o_orderpriority, 1, 1) AS cur, year(o_orderdate) AS y,
              arg_max(o_totalprice, strftime(o_orderdate, '%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS r
       FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2),
ar AS (SELECT 'C' || substr(o_orderpriority, 1, 1) AS cur, year(o_orderdate) AS y,
              max(CAST(o_orderdate AS DATE)) AS eff, max(o_totalprice) AS r
       FROM orders WHERE month(o_orderdate) = 6 GROUP BY 1, 2)
""".format(
    cases=" ".join(f"WHEN {i} THEN p.{m}" for i, m in enumerate(MONTHS, 1)),
    names=", ".join(f"'{m}'" for m in MONTHS),
)


@query(
    "estimate_fx",
    f"""WITH {_PIVOT_SQL}, {_RATES_SQL}
        SELECT 'LE4' AS LE, le.category AS Capex_Category_Type_Code, le.project AS Project_Name,
               le.cur AS Currency_Code, le.mname AS Calender_MONTH, le.v AS VALUE,
               CAST(le.mno AS INTEGER) AS LE_month_no,
               CAST(ceil(le.mno / 3.0) * 3 AS INTEGER) AS Q_month,
               CAST(year(le.ing) AS INTEGER) AS Q_year,
               coalesce(pr.r, 1.0) AS Plan_USD, ar.r AS Actual_USD, ar.eff AS Effective_From_Date
        FROM le JOIN ar ON le.cur = ar.cur AND year(le.ing) = ar.y
        LEFT JOIN pr ON le.cur = pr.cur AND year(le.ing) = pr.y""",
)
def estimate_fx(spark, sf_dir):
    """Monthly estimates at plan and actual rates; priority 5 has no plan rate."""
    od = table(spark, sf_dir, "orders")
    cur = F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1))
    # The exchange date text sorts by month, day and order before the year at its end.
    stamp = F.concat(
        F.date_format("o_orderdate", "MMdd"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0"),
        F.date_format("o_orderdate", "yyyy"),
    )
    plan_rates = od.where("o_orderpriority <> '5-LOW'").select(
        cur.alias("FROM_CURRENCY"), F.lit("USD").alias("TO_CURRENCY"),
        stamp.alias("EXCHANGE_DATE"), F.col("o_totalprice").alias("EXCHANGE_RATE"),
    )
    actual_rates = (
        od.where("month(o_orderdate) = 6")
        .groupBy(cur.alias("From_Currency_Code"), F.year("o_orderdate").alias("_y"))
        .agg(
            F.max(F.to_date("o_orderdate")).alias("Effective_From_Date"),
            F.concat(F.max("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("-")).alias(
                "Exchanage_Rate"
            ),
        )
        .withColumns(
            {"To_Currency_Code": F.lit("USD"), "Exchange_Rate_Period_Type_Code": F.lit("ZQ1")}
        )
    )
    estimate = budget_lines(spark, sf_dir).withColumn(
        "Currency_Code", F.concat(F.lit("C"), F.substring("Capex_Category_Type_Code", 1, 1))
    )
    return fx.estimate_at_two_rates(
        estimate, plan_rates, actual_rates, dt.date(2001, 5, 20), months={m: m for m in MONTHS}
    ).drop("Ingestion_DateTime", "Calendar_year")


@query(
    "nbv_incremental",
    """WITH f AS (
         SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS company,
                lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS site, l_shipdate AS created,
                strftime(l_shipdate, '0%m.%Y') AS period,
                CAST(l_extendedprice AS DECIMAL(18,5)) AS nbv FROM lineitem),
       c AS (SELECT CAST(s_suppkey AS VARCHAR) AS company, min(n_name) AS country
             FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 4
             GROUP BY 1)
       SELECT f.company AS COMPANY_CODE, CAST(f.created AS DATE) AS CREATE_DATE,
              CASE WHEN left(site, 2) = '00' THEN substring(site, 3) ELSE site END AS SITE_CODE,
              f.period AS PERIOD, CAST(f.nbv AS DOUBLE) AS FIXED_ASSET_NET_BOOK_VALUE,
              'EUR' AS CURRENCY_CODE, c.country AS COUNTRY
       FROM f LEFT JOIN c ON f.company = c.company
       WHERE f.created > (SELECT max(l_shipdate) FROM lineitem WHERE l_shipdate < DATE '1999-01-01')""",
)
def nbv_incremental(spark, sf_dir):
    """Net book values newer than what the target already holds."""
    li = table(spark, sf_dir, "lineitem")
    feed = li.select(
        F.col("l_suppkey").cast("string").alias("COMPANY_CODE"),
        F.lpad(F.col("l_partkey").cast("string"), 7, "0").alias("SITE_CODE"),
        F.col("l_shipdate").cast("timestamp").alias("Ingestion_Revision_Date"),
        F.date_format("l_shipdate", "'0'MM.yyyy").alias("PERIOD"),
        F.col("l_extendedprice").cast("decimal(18,5)").alias("Fixed_Asset_NBV"),
        F.lit("EUR").alias("CURRENCY_CODE"),
    )
    target = li.where("l_shipdate < DATE '1999-01-01'").select(
        F.col("l_shipdate").cast("timestamp").alias("CREATE_DATE")
    )
    na = table(spark, sf_dir, "nation").where("n_regionkey <> 4")
    su = table(spark, sf_dir, "supplier")
    companies = su.join(na, su.s_nationkey == na.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("COMP_CODE"), F.col("n_name").alias("COUNTRY")
    )
    out = assets.load_net_book_values(feed, target, companies)
    return out.withColumns(
        {
            "CREATE_DATE": F.to_date("CREATE_DATE"),
            "FIXED_ASSET_NET_BOOK_VALUE": F.col("FIXED_ASSET_NET_BOOK_VALUE").cast("double"),
        }
    )


@query(
    "tax_rate_load",
    """SELECT DISTINCT '012.2023' AS FISCAL_PERIOD, CAST(o_orderdate AS DATE) AS CREATE_DATE,
              CAST(o_custkey AS VARCHAR) AS Company_code, o_orderpriority AS Country,
              o_totalprice AS Percentage, CAST(year(o_orderdate) AS INTEGER) AS Year
       FROM orders
       WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1999-01-01')""",
)
def tax_rate_load(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    feed = od.select(
        at.alias("Ingestion_Revision_Date"),
        F.col("o_custkey").alias("Company_code"),
        F.col("o_orderpriority").alias("Country"),
        F.col("o_totalprice").alias("Percentage"),
        F.year("o_orderdate").alias("Year"),
    )
    target = od.where("o_orderdate < DATE '1999-01-01'").select(at.alias("CREATE_DATE"))
    return assets.load_tax_rates(feed, target, dt.date(2024, 1, 15)).withColumn(
        "CREATE_DATE", F.to_date("CREATE_DATE")
    )


@query(
    "cost_centre_load",
    """SELECT DISTINCT '002.2024' AS FISCAL_PERIOD, CAST(o_orderkey AS VARCHAR) AS Cost_Center,
              CAST(o_custkey AS VARCHAR) AS Company_Code,
              CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS Indicator
       FROM orders""",
)
def cost_centre_load(spark, sf_dir):
    """A full reload, with the bad indicator blanked."""
    od = table(spark, sf_dir, "orders")
    feed = od.select(
        F.col("o_orderdate").cast("timestamp").alias("Ingestion_Revision_Date"),
        F.col("o_orderkey").alias("Cost_Center"),
        F.col("o_custkey").alias("Company_Code"),
        F.when(F.col("o_orderstatus") == "P", assets.BAD_INDICATOR)
        .otherwise(F.col("o_orderstatus"))
        .alias("Indicator"),
    )
    out = assets.load_cost_centre_sites(feed, feed, dt.date(2024, 3, 31), reload_all=True, optional=schema("cost_centre_site").fieldNames())
    return out.select("FISCAL_PERIOD", "Cost_Center", "Company_Code", "Indicator")


def _dated_tables(spark, sf_dir):
    return {
        "orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
    }


@query(
    "retention_purge",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders
       WHERE year(o_orderdate) >= 1997""",
)
def retention_purge(spark, sf_dir):
    kept, _ = retention.apply_retention(_dated_tables(spark, sf_dir), 2001)
    return kept["orders"].select("o_orderkey", F.year("o_orderdate").alias("yr"))


@query(
    "retention_audit",
    """SELECT 'orders' AS table_name, count(*) FILTER (WHERE year(o_orderdate) < 1997)
                AS rows_removed, 1997 AS removed_before, 2001 AS run_year FROM orders
       UNION ALL
       SELECT 'lineitem', count(*) FILTER (WHERE year(l_shipdate) < 1997), 1997, 2001
       FROM lineitem""",
)
def retention_audit(spark, sf_dir):
    _, audit = retention.apply_retention(_dated_tables(spark, sf_dir), 2001)
    return audit


