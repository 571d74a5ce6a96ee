"""Plan tables, estimates with actuals, staging loads and publishing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sitebooks.catalog.registry import PLAN_SQL, plan_lines, query, table
from sitebooks.plans import estimate, planning, publish, staging
from sitebooks.runtime import materialise
from sitebooks.schemas import schema

RUN = dt.date(2000, 6, 15)
_FY_SQL = """
  SELECT {keys}, yr AS Year, submission AS OP_Submissions, 'FY' AS Month, 13 AS Month_ID,
         count(class) AS No_Of_Lease_Sites, CAST(sum(amount) AS DOUBLE) AS Plan_Amount,
         CAST(sum(amount_usd) AS DOUBLE) AS Plan_Amount_USD,
         0.0::DOUBLE AS Plan_YTD_Amount, 0.0::DOUBLE AS Plan_YTD_Amount_USD
  FROM plan WHERE yr IN (SELECT yr FROM plan WHERE mon = 12) GROUP BY {raw}, yr, submission"""
_MONTH_SQL = """
  SELECT {keys}, yr AS Year, submission AS OP_Submissions, mon_name AS Month, mon AS Month_ID,
         n AS No_Of_Lease_Sites, CAST(a AS DOUBLE) AS Plan_Amount, CAST(u AS DOUBLE) AS Plan_Amount_USD,
         CAST(sum(a) OVER w AS DOUBLE) AS Plan_YTD_Amount,
         CAST(sum(u) OVER w AS DOUBLE) AS Plan_YTD_Amount_USD
  FROM (SELECT {raw}, yr, submission, mon_name, mon, count(*) AS n, sum(amount) AS a,
               sum(amount_usd) AS u FROM plan GROUP BY ALL)
  WINDOW w AS (PARTITION BY {raw}, yr, submission ORDER BY mon
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
_COMPANY = dict(
    keys="kpi AS KPI, company AS Company_Code, class AS Lease_Classification",
    raw="kpi, company, class",
)
_SITE = dict(
    keys="kpi AS KPI, company AS Company_Code, class AS Lease_Classification, site AS Site_ID",
    raw="kpi, company, class, site",
)
_DAYS = ("Create_Date", "Update_Date")


def _staged(df):
    return materialise(df, "monthly-plan")


@query(
    "plan_full_year",
    f"""WITH {PLAN_SQL}
        SELECT kpi AS KPI, company AS Company_Code, class AS Lease_Classification, yr AS Year,
               submission AS OP_Submissions, CAST(sum(amount) AS DOUBLE) AS Plan_Amount,
               CAST(sum(amount_usd) AS DOUBLE) AS Plan_Amount_USD, max(currency) AS Local_Currency,
               count(class) AS No_Of_Lease_Sites
        FROM plan WHERE yr BETWEEN 1999 AND 2010 GROUP BY 1, 2, 3, 4, 5""",
)
def plan_full_year(spark, sf_dir):
    return planning.company_full_year(plan_lines(spark, sf_dir), RUN).drop(*_DAYS)


@query(
    "plan_month_ytd_fy",
    f"""WITH {PLAN_SQL}, r AS ({_MONTH_SQL.format(**_COMPANY)} UNION ALL {_FY_SQL.format(**_COMPANY)})
        SELECT r.*, 'CUR-' || substr(Company_Code, 1, 1) AS Local_Currency FROM r""",
)
def plan_month_ytd_fy(spark, sf_dir):
    return planning.month_ytd_full_year(plan_lines(spark, sf_dir), RUN, stage=_staged).drop(*_DAYS)


@query(
    "plan_site_month_ytd_fy",
    f"""WITH {PLAN_SQL}, r AS ({_MONTH_SQL.format(**_SITE)} UNION ALL {_FY_SQL.format(**_SITE)})
        SELECT r.*, 'CUR-' || substr(Company_Code, 1, 1) AS Local_Currency FROM r
        WHERE Year BETWEEN 1999 AND 2001""",
)
def plan_site_month_ytd_fy(spark, sf_dir):
    out = planning.month_ytd_full_year(
        plan_lines(spark, sf_dir), RUN, site_level=True, years_around=1, stage=_staged
    )
    return out.withColumn("Site_ID", F.col("Site_ID").cast("long")).drop(
        *_DAYS, "Lease_ID", "Transaction_ID", "Legally_Committed", "Auto_Renewal_Y_N"
    )


def _site_plan(spark, sf_dir):
    return plan_lines(spark, sf_dir).withColumns(
        {
            "No_Of_Lease_Sites": F.lit(1),
            "Legally_Committed": F.lit("Y"),
            "Auto_Renewal_Y_N": F.lit("N"),
        }
    )


@query(
    "plan_site_full_year",
    f"""WITH {PLAN_SQL}
        SELECT kpi AS KPI, company AS Company_Code, class AS Lease_Classification, site AS Site_ID,
               yr AS Year, currency AS Local_Currency, CAST(sum(amount) AS DOUBLE) AS Plan_Amount,
               CAST(sum(amount_usd) AS DOUBLE) AS Plan_Amount_USD,
               max(submission) AS OP_Submissions
        FROM plan WHERE yr BETWEEN 1999 AND 2010 GROUP BY 1, 2, 3, 4, 5, 6""",
)
def plan_site_full_year(spark, sf_dir):
    out = planning.site_full_year(_site_plan(spark, sf_dir), RUN)
    return out.withColumn("Site_ID", F.col("Site_ID").cast("long")).drop(
        *_DAYS, "Lease_ID", "Transaction_ID", "Legally_Committed", "Auto_Renewal_Y_N",
        "No_Of_Lease_Sites",
    )


@query(
    "plan_site_fy_joinback",
    f"""WITH {PLAN_SQL}, t AS (
          SELECT kpi, company, class, site, yr, currency, sum(amount) AS a, sum(amount_usd) AS u
          FROM plan WHERE yr BETWEEN 1999 AND 2010 GROUP BY ALL)
        SELECT t.kpi AS KPI, t.company AS Company_Code, t.class AS Lease_Classification,
               t.site AS Site_ID, t.yr AS Year, t.currency AS Local_Currency,
               CAST(t.a AS DOUBLE) AS Plan_Amount, CAST(t.u AS DOUBLE) AS Plan_Amount_USD,
               CAST(d.l_orderkey AS VARCHAR) AS Transaction_ID, d.submission AS OP_Submissions
        FROM t LEFT JOIN plan d ON t.kpi = d.kpi AND t.company = d.company AND t.class = d.class
          AND t.site = d.site AND t.yr = d.yr AND t.currency = d.currency""",
)
def plan_site_fy_joinback(spark, sf_dir):
    """Site totals repeated on each of their plan lines."""
    out = planning.site_full_year(_site_plan(spark, sf_dir), RUN, repeat_per_detail=True)
    return out.withColumn("Site_ID", F.col("Site_ID").cast("long")).drop(
        *_DAYS, "Lease_ID", "Legally_Committed", "Auto_Renewal_Y_N", "No_Of_Lease_Sites"
    )


# --- estimates whose past months are actuals --------------------------------------

_ESTIMATE_SQL = f"""
{PLAN_SQL},
act AS (SELECT site, company, class, kpi, mon, amount, amount_usd, l_orderkey FROM plan
        WHERE submission = 'F' AND yr = 2000),
est AS (SELECT *, 'LE' || CAST(1 + l_linenumber % 4 AS VARCHAR) AS le_type FROM plan
        WHERE submission <> 'F' AND yr = 2000),
cuts AS (SELECT * FROM (VALUES ('LE1', 0), ('LE2', 3), ('LE3', 6), ('LE4', 9)) AS c(le, cut)),
-- one set of attributes per lease, company, classification and month
per_month AS (SELECT site, company, class, mon, min(kpi) AS kpi, sum(amount) AS a,
                     sum(amount_usd) AS u FROM act GROUP BY site, company, class, mon),
keys AS (SELECT DISTINCT site, company, class, kpi FROM per_month),
months AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS mon),
booked AS (
  SELECT k.site, k.company, k.class, k.kpi, m.mon, coalesce(p.a, 0) AS a, coalesce(p.u, 0) AS u
  FROM keys k CROSS JOIN months m LEFT JOIN per_month p ON p.site = k.site
    AND p.company = k.company AND p.class = k.class AND p.kpi = k.kpi AND p.mon = m.mon),
actual_part AS (
  SELECT DISTINCT c.le || '_ACT' AS LE_ACT, b.company, b.class, b.kpi, b.site, b.mon,
         CASE WHEN b.mon <= c.cut THEN CAST(b.a AS DOUBLE) ELSE 0 END AS amt,
         CASE WHEN b.mon <= c.cut THEN CAST(b.u AS DOUBLE) ELSE 0 END AS usd,
         CAST(NULL AS VARCHAR) AS le_type, CAST(NULL AS VARCHAR) AS tid
  FROM booked b JOIN cuts c ON c.cut > 0),
est_rows AS (
  SELECT e.le_type || '_ACT' AS LE_ACT, e.company,
         CASE WHEN class = 'O' THEN 'LR' ELSE 'NTI' END AS class, e.kpi, e.site, e.mon,
         CASE WHEN e.mon <= c.cut THEN 0 ELSE CAST(e.amount AS DOUBLE) END AS amt,
         CASE WHEN e.mon <= c.cut THEN 0 ELSE CAST(e.amount_usd AS DOUBLE) END AS usd,
         e.le_type, CAST(e.l_orderkey AS VARCHAR) AS tid, c.cut
  FROM est e JOIN cuts c ON c.le = e.le_type)
"""


@query(
    "actuals_replace",
    f"""WITH {_ESTIMATE_SQL}
        SELECT LE_ACT, company AS COMPANY_CODE, class AS LEASE_CLASSIFICATION_CODE,
               kpi AS KPI_TYPE_TEXT, CAST(site AS VARCHAR) AS SITE_ID, mon AS NO_MONTH,
               amt AS LE_AMOUNT, usd AS LE_USD_AMOUNT, le_type AS LE_Type_Code,
               tid AS TRANSACTION_ID
        FROM (SELECT * FROM actual_part
              UNION ALL SELECT DISTINCT * EXCLUDE (cut) FROM est_rows WHERE cut > 0
              UNION ALL SELECT * EXCLUDE (cut) FROM est_rows WHERE cut = 0)""",
)
def actuals_replace(spark, sf_dir):
    """Orders in status F are actuals, all others estimates of four rounds."""
    lines = plan_lines(spark, sf_dir)
    null = F.lit(None).cast("string")
    shared = {
        "KPI_TYPE_TEXT": F.col("KPI"),
        "SITE_ID": F.col("Site_ID"),
        "SITE_NAME": null,
        "LEASE_ID": F.col("Lease_ID"),
        "COMPANY_CODE": F.col("Company_Code"),
        "CALENDAR_YEAR": F.col("Year"),
        "CALENDAR_MONTH": F.col("Month"),
        "LEASE_SITE_COUNT": F.lit(1),
        "LOCAL_CURRENCY_CODE": F.col("Local_Currency"),
        "LEGALLY_COMMITTED_INDICATOR": null,
    }
    actuals = lines.where("OP_Submissions = 'F'").select(
        *[c.alias(n) for n, c in shared.items()],
        F.col("Lease_Classification").alias("LEASE_CLASSIFICATION_CODE"),
        null.alias("TRANSACTION_ID"),
        F.col("Plan_Amount").alias("ACTUAL_LC_AMOUNT"),
        F.col("Plan_Amount_USD").alias("ACTUAL_USD_AMOUNT"),
        null.alias("FLOW_TYPE_CODE"), null.alias("PROFIT_CENTER"),
        null.alias("GROWTH_SUSTAIN_SPLIT_TEXT"),
    )
    estimates = lines.where("OP_Submissions != 'F'").select(
        *[c.alias(n) for n, c in shared.items()],
        F.when(F.col("Lease_Classification") == "O", "Tap UP").otherwise("EV SFS").alias(
            "LEASE_CLASSIFICATION_CODE"
        ),
        "Transaction_ID",
        F.concat(F.lit("LE"), (F.lit(1) + F.col("l_linenumber") % 4).cast("string")).alias(
            "LE_TYPE_CODE"
        ),
        F.lit("advance payments").alias("VALUE_TYPE_CODE"),
        F.col("Plan_Amount").alias("LE_LC_AMOUNT"),
        F.col("Plan_Amount_USD").alias("LE_USD_AMOUNT"),
        null.alias("AUTO_RENEWAL_INDICATOR"),
    )
    return estimate.replace_with_actuals(estimates, actuals, 2000, run_date=RUN, optional=schema("estimate_with_actuals").fieldNames()).select(
        "LE_ACT", "COMPANY_CODE", "LEASE_CLASSIFICATION_CODE", "KPI_TYPE_TEXT", "SITE_ID",
        "NO_MONTH", "LE_AMOUNT", "LE_USD_AMOUNT", "LE_Type_Code", "TRANSACTION_ID",
    )


@query(
    "filtered_actuals",
    """SELECT DISTINCT l_returnflag AS KPI_TYPE_TEXT, CAST(l_suppkey AS VARCHAR) AS SITE_ID,
              CAST(year(l_shipdate) AS INTEGER) AS CALENDAR_YEAR,
              l_extendedprice AS ACTUAL_LC_AMOUNT,
              CASE WHEN l_linestatus = 'O' THEN 'Q20' ELSE 'Q24' END AS FLOW_TYPE_CODE,
              CAST(800000 + l_linenumber AS INTEGER) AS PROFIT_CENTER
       FROM lineitem
       WHERE CAST(l_shipdate AS DATE) IN (DATE '1998-03-01', DATE '1998-03-02', DATE '1999-12-31')
         AND 800000 + l_linenumber IN (800001, 800002, 800003)""",
)
def filtered_actuals(spark, sf_dir):
    """Staged actuals reduced to accepted load dates, flow types and profit centres."""
    li = table(spark, sf_dir, "lineitem")
    null = F.lit(None).cast("string")
    empty = {
        c: null
        for c in (
            "SITE_NAME", "LEASE_ID", "TRANSACTION_ID", "COMPANY_CODE", "MONTH",
            "LEASE_CLASSIFICATION", "LEGALLY_COMMITTED", "LOCAL_CURRENCY", "TEXT", "G_L_ACCOUNT",
            "ASSIGNMENT", "DOCUMENT_TYPE", "GROWTH_SUSTAIN_SPLIT_TEXT",
        )
    }
    raw = li.select(
        F.col("l_returnflag").alias("KPI"),
        F.col("l_suppkey").cast("string").alias("SITE_ID"),
        F.year("l_shipdate").alias("YEAR"),
        F.col("l_extendedprice").alias("ACTUAL_AMOUNT"),
        F.lit(None).cast("double").alias("ACTUAL_AMOUNT_USD"),
        F.col("l_shipdate").alias("LOAD_DATE"),
        F.col("l_shipdate").alias("UPDATE_DATE"),
        F.lit(1).alias("NO_OF_LEASE_SITES"),
        F.lit(None).cast("int").alias("POSTING_PERIOD"),
        F.when(F.col("l_linestatus") == "O", "Q20").otherwise("Q24").alias("FLOW_TYPE"),
        (F.lit(800000) + F.col("l_linenumber")).alias("PROFIT_CENTER"),
        *[c.alias(n) for n, c in empty.items()],
    )
    days = [dt.date(1998, 3, 1), dt.date(1998, 3, 2), dt.date(1999, 12, 31)]
    out = staging.payment_actuals(
        staging.stage_actuals(raw), days, profit_centres=(800001, 800002, 800003)
    )
    return out.select(
        "KPI_TYPE_TEXT", "SITE_ID", "CALENDAR_YEAR", "ACTUAL_LC_AMOUNT", "FLOW_TYPE_CODE",
        "PROFIT_CENTER",
    )


# --- staging of estimates, plan and operating costs -------------------------------


def _raw_plan(spark, sf_dir, names, amounts):
    """Plan lines under the raw names of a staging load; what they lack is null."""
    filled = {
        "KPI": "KPI", "SITE_ID": "Site_ID", "LEASE_ID": "Lease_ID", "TRANSACTION_ID": "Transaction_ID",
        "COMPANY_CODE": "Company_Code", "YEAR": "Year", "MONTH": "Month",
        "LEASE_CLASSIFICATION": "Lease_Classification", "LOCAL_CURRENCY": "Local_Currency", **amounts,
    }
    return plan_lines(spark, sf_dir).select(
        *[(F.col(filled[raw]) if raw in filled else F.lit(None).cast("string")).alias(raw)
          for raw in dict.fromkeys(names.values())]
    )


_STAGED_SQL = """SELECT kpi AS KPI_TYPE_TEXT, CAST(site AS VARCHAR) AS SITE_ID,
       'L' || CAST(site AS VARCHAR) AS LEASE_ID, CAST(l_orderkey AS VARCHAR) AS TRANSACTION_ID,
       company AS COMPANY_CODE, yr AS CALENDAR_YEAR, mon_name AS CALENDAR_MONTH,
       class AS LEASE_CLASSIFICATION_CODE, currency AS LOCAL_CURRENCY_CODE"""
_STAGED = (
    "KPI_TYPE_TEXT", "SITE_ID", "LEASE_ID", "TRANSACTION_ID", "COMPANY_CODE", "CALENDAR_YEAR",
    "CALENDAR_MONTH", "LEASE_CLASSIFICATION_CODE", "LOCAL_CURRENCY_CODE",
)


@query(
    "staged_estimates",
    f"""WITH {PLAN_SQL} {_STAGED_SQL.replace("yr AS", "CAST(yr AS VARCHAR) AS")}, CAST(amount AS DOUBLE) AS LE_LC_AMOUNT,
        CAST(amount_usd AS DOUBLE) AS LE_USD_AMOUNT, submission AS LE_TYPE_CODE FROM plan""",
)
def staged_estimates(spark, sf_dir):
    """Raw estimates in the curated layout."""
    raw = _raw_plan(
        spark, sf_dir, staging.ESTIMATE_NAMES,
        {"LE_AMOUNT": "Plan_Amount", "LE_AMOUNT_USD": "Plan_Amount_USD", "LE_TYPE": "OP_Submissions"},
    )
    out = staging.curated_estimates(staging.stage_estimates(raw))
    return out.select(
        *_STAGED, F.col("LE_LC_AMOUNT").cast("double").alias("LE_LC_AMOUNT"),
        F.col("LE_USD_AMOUNT").cast("double").alias("LE_USD_AMOUNT"), "LE_TYPE_CODE",
    )


@query(
    "staged_plan",
    f"""WITH {PLAN_SQL} {_STAGED_SQL}, CAST(amount AS DOUBLE) AS PLAN_LC_AMOUNT,
        CAST(amount_usd AS DOUBLE) AS PLAN_USD_AMOUNT FROM plan""",
)
def staged_plan(spark, sf_dir):
    raw = _raw_plan(
        spark, sf_dir, staging.PLAN_NAMES, {"PLAN_AMOUNT": "Plan_Amount", "PLAN_AMOUNT_USD": "Plan_Amount_USD"}
    )
    return staging.stage_plan(raw).select(
        *_STAGED, F.col("PLAN_LC_AMOUNT").cast("double").alias("PLAN_LC_AMOUNT"),
        F.col("PLAN_USD_AMOUNT").cast("double").alias("PLAN_USD_AMOUNT"),
    )


@query(
    "staged_opex",
    f"""WITH {PLAN_SQL}
        SELECT 'estimate' AS load, NULL::VARCHAR AS code, currency AS LOCAL_CURRENCY_CODE,
               yr AS CALENDAR_YEAR, CAST(amount AS DOUBLE) AS lc, CAST(amount_usd AS DOUBLE) AS usd FROM plan
        UNION ALL
        SELECT 'plan', company, NULL, yr, CAST(amount AS DOUBLE), CAST(amount_usd AS DOUBLE) FROM plan""",
)
def staged_opex(spark, sf_dir):
    """Operating-cost estimates and plan; years arrive as text and leave as integers."""
    text_year = lambda raw: raw.withColumn("YEAR", F.col("YEAR").cast("string"))
    le = staging.stage_opex_estimates(text_year(_raw_plan(
        spark, sf_dir, staging.OPEX_ESTIMATE_NAMES,
        {"OPEX_LE_AMOUNT": "Plan_Amount", "OPEX_LE_AMOUNT_USD": "Plan_Amount_USD"},
    )))
    plan = staging.stage_opex_plan(text_year(_raw_plan(
        spark, sf_dir, staging.OPEX_PLAN_NAMES,
        {"OPEX_PL_AMOUNT": "Plan_Amount", "OPEX_PL_AMOUNT_USD": "Plan_Amount_USD"},
    )))
    part = lambda df, load, code, currency, lc, usd: df.select(
        F.lit(load).alias("load"), code.alias("code"), currency.alias("LOCAL_CURRENCY_CODE"),
        "CALENDAR_YEAR", F.col(lc).cast("double").alias("lc"), F.col(usd).cast("double").alias("usd"),
    )
    none = F.lit(None).cast("string")
    return part(le, "estimate", none, F.col("LOCAL_CURRENCY_CODE"), "OPEX_LE_LC_AMOUNT", "OPEX_LE_USD_AMOUNT").unionByName(
        part(plan, "plan", F.col("COUNTRY_CODE"), none, "OPEX_PL_LC_AMOUNT", "OPEX_PL_USD_AMOUNT")
    )


@query(
    "publish_with_country",
    f"""WITH {PLAN_SQL}, fy AS (
          SELECT kpi, company, class, yr, submission, sum(amount) AS a, max(currency) AS cur
          FROM plan WHERE yr BETWEEN 1999 AND 2010 GROUP BY 1, 2, 3, 4, 5),
        c AS (SELECT DISTINCT o_orderpriority AS company, 'LAND-' || substr(o_orderpriority, 1, 1)
                AS country FROM orders WHERE o_orderpriority <> '5-LOW')
        SELECT kpi AS KPI_Type_Text, fy.company AS Company_Code, c.country, yr AS Calendar_Year,
               CAST(a AS DOUBLE) AS Plan_LC_Amount, class AS Lease_Classification_Code,
               cur AS Local_Currency_Code, submission AS OP_Submissions
        FROM fy JOIN c ON fy.company = c.company""",
)
def publish_with_country(spark, sf_dir):
    companies = (
        table(spark, sf_dir, "orders")
        .where("o_orderpriority <> '5-LOW'")
        .select(
            F.col("o_orderpriority").alias("company"),
            F.concat(F.lit("LAND-"), F.substring("o_orderpriority", 1, 1)).alias("country"),
        )
    )
    out = publish.with_country(
        planning.company_full_year(plan_lines(spark, sf_dir), RUN),
        companies,
        names=publish.PLAN_PUBLISH_NAMES,
    )
    return out.select(
        "KPI_Type_Text", "Company_Code", "country", "Calendar_Year", "Plan_LC_Amount",
        "Lease_Classification_Code", "Local_Currency_Code", "OP_Submissions",
    )


@query(
    "publish_with_region",
    """SELECT s.s_suppkey, m.mapped AS country_name, m.code AS COUNTRY_CODE
       FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN (SELECT CASE n_name WHEN 'NATION_3' THEN 'Land three' WHEN 'NATION_4' THEN 'Land four'
                         ELSE n_name END AS mapped, 'R' || CAST(n_regionkey AS VARCHAR) AS code
             FROM nation) m
         ON m.mapped = CASE n.n_name WHEN 'NATION_3' THEN 'Land three' ELSE n.n_name END""",
)
def publish_with_region(spark, sf_dir):
    """Country names of the facts and of the region list differ for some countries."""
    na = table(spark, sf_dir, "nation")
    su = table(spark, sf_dir, "supplier")
    name = F.when(F.col("n_name") == "NATION_3", "Land three").otherwise(F.col("n_name"))
    facts = su.join(na, su.s_nationkey == na.n_nationkey).select(
        "s_suppkey", name.alias("country_name")
    )
    regions = na.select(
        F.col("n_name").alias("country_name"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("COUNTRY_CODE"),
    )
    aliases = {"NATION_3": "Land three", "NATION_4": "Land four"}
    return publish.with_region(facts, regions, aliases, stamp_column=None)
