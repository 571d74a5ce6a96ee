"""Plan tables: full year, month with year-to-date, and full-year total rows.

Input columns: KPI, Company_Code, Lease_Classification, Year (int), Month
(``JAN``..``DEC``), Local_Currency, Plan_Amount, Plan_Amount_USD,
OP_Submissions, and for the site tables also Site_ID, Lease_ID, Transaction_ID,
Legally_Committed, Auto_Renewal_Y_N and No_Of_Lease_Sites.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import month_number
from sitebooks.operators.filters import keep_years
from sitebooks.operators.joins import map_values
from sitebooks.operators.project import stamp
from sitebooks.operators.windows import running_sum

COMPANY_KEYS = ["KPI", "Company_Code", "Lease_Classification"]
SITE_KEYS = ["KPI", "Company_Code", "Lease_ID", "Site_ID", "Lease_Classification"]
AMOUNTS = ["Plan_Amount", "Plan_Amount_USD"]


def _dated(df: DataFrame, run_date: dt.date) -> DataFrame:
    day = F.lit(run_date)
    return stamp(stamp(df, "Create_Date", day), "Update_Date", day)


def _whole(amount: str):
    """Sum of unrounded amounts, rounded at the end; null when all are null."""
    return F.sum(F.col(amount).cast("decimal(18,6)"))


def company_full_year(
    plan: DataFrame, run_date: dt.date, back: int = 1, ahead: int = 10
) -> DataFrame:
    """Yearly plan per KPI, company, classification and submission.

    Keeps the years ``run year - back`` .. ``run year + ahead``.  Lease sites
    are rows with a classification, as nulls are not counted.
    """
    plan = keep_years(plan, "Year", run_date.year, back, ahead)
    out = plan.groupBy(*COMPANY_KEYS, "Year", "OP_Submissions").agg(
        *[
            F.coalesce(F.round(_whole(a), 2).cast("double"), F.lit(0.0)).alias(a)
            for a in AMOUNTS
        ],
        F.max("Local_Currency").alias("Local_Currency"),
        F.count("Lease_Classification").alias("No_Of_Lease_Sites"),
    )
    return _dated(out, run_date)


def month_ytd_full_year(
    plan: DataFrame,
    run_date: dt.date,
    site_level: bool = False,
    years_around: int | None = None,
    mix_submissions: bool = False,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Month rows with running year-to-date amounts, plus one ``FY`` row per year.

    * The running sum restarts per submission; ``mix_submissions=True`` runs one
      sum over all submissions of a company (ties by submission name).
    * ``FY`` rows exist for years that have a December row anywhere in the plan,
      and carry year-to-date 0.
    * ``years_around=1`` keeps the run year and its neighbours.

    A company's currency is looked up by company code in the whole plan; without
    one the code itself stands in.  Year totals, year-to-date, currency and the December test all read
    the monthly aggregate; ``stage`` is applied to it, and a job passes
    ``materialise`` there so that the plan is aggregated only once.
    """
    keys = SITE_KEYS if site_level else COMPANY_KEYS
    currencies = None
    if years_around is not None:
        # A company's currency may be known from years that are not kept.
        currencies = plan.groupBy("Company_Code").agg(F.max("Local_Currency").alias("_currency"))
        plan = keep_years(plan, "Year", run_date.year, years_around, years_around)
    monthly = plan.groupBy(
        *keys, "Year", "OP_Submissions", F.upper(F.trim("Month")).alias("Month")
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("Lease_Classification").alias("_classified"),
        F.max("Local_Currency").alias("_currency"),
        *[F.sum(F.col(a).cast("decimal(18,2)")).alias(a) for a in AMOUNTS],
        *[_whole(a).alias(f"_{a}") for a in AMOUNTS],
    )
    monthly = stage(monthly.withColumn("Month_ID", month_number(F.col("Month"))))

    months = monthly.select(
        *keys,
        "Year",
        "OP_Submissions",
        "Month",
        "Month_ID",
        F.col("_rows").alias("No_Of_Lease_Sites"),
        *[F.coalesce(F.col(a), F.lit(0).cast("decimal(28,2)")).alias(a) for a in AMOUNTS],
    )
    parts = [*keys, "Year"] + ([] if mix_submissions else ["OP_Submissions"])
    order = ["Month_ID"] + (["OP_Submissions"] if mix_submissions else [])
    months = running_sum(
        months,
        parts,
        order,
        {"Plan_YTD_Amount": "Plan_Amount", "Plan_YTD_Amount_USD": "Plan_Amount_USD"},
    )
    closed = monthly.where("Month_ID = 12").select("Year").distinct()
    years = (
        monthly.join(closed, "Year", "left_semi")
        .groupBy(*keys, "Year", "OP_Submissions")
        .agg(
            F.sum("_classified").alias("No_Of_Lease_Sites"),
            *[
                F.coalesce(F.round(F.sum(f"_{a}"), 2), F.lit(0)).cast("decimal(28,2)").alias(a)
                for a in AMOUNTS
            ],
        )
        .withColumns(
            {
                "Month": F.lit("FY"),
                "Month_ID": F.lit(13),
                "Plan_YTD_Amount": F.lit(0).cast("decimal(28,2)"),
                "Plan_YTD_Amount_USD": F.lit(0).cast("decimal(28,2)"),
            }
        )
    )
    out = months.unionByName(years).withColumns(
        {
            c: F.col(c).cast("double")
            for c in (*AMOUNTS, "Plan_YTD_Amount", "Plan_YTD_Amount_USD")
        }
    )
    out = map_values(
        out, "Company_Code", monthly if currencies is None else currencies, "Company_Code", "_currency", out="Local_Currency"
    )
    if site_level:
        out = out.withColumns(
            {
                c: F.lit(None).cast("string")
                for c in ("Transaction_ID", "Legally_Committed", "Auto_Renewal_Y_N")
            }
        )
    return _dated(out, run_date)


def site_full_year(
    plan: DataFrame,
    run_date: dt.date,
    back: int = 1,
    ahead: int = 10,
    repeat_per_detail: bool = False,
) -> DataFrame:
    """Yearly plan per site and lease, with the attributes of its plan lines.

    By default one row per group, each attribute being its largest value.  With
    ``repeat_per_detail`` the totals are joined back to the plan lines on the
    seven shared keys, giving one row per matching line (none matches a null
    key; such a group keeps one row without attributes).
    """
    plan = keep_years(plan, "Year", run_date.year, back, ahead)
    group = [*SITE_KEYS, "Year", "Local_Currency"]
    attributes = ["Transaction_ID", "Legally_Committed", "Auto_Renewal_Y_N", "OP_Submissions"]
    sums = [
        F.coalesce(F.round(_whole(a), 2).cast("double"), F.lit(0.0)).alias(a) for a in AMOUNTS
    ]
    if not repeat_per_detail:
        out = plan.groupBy(*group, "No_Of_Lease_Sites").agg(
            *sums, *[F.max(a).alias(a) for a in attributes]
        )
    else:
        total = plan.groupBy(*group, "No_Of_Lease_Sites").agg(*sums)
        out = total.join(plan.select(*group, *attributes), group, "left")
    return _dated(out, run_date)
