"""Exchange rates: normalisation, and estimates valued at two rates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import (
    inverted_date,
    month_number,
    quarter_end_month,
)
from sitebooks.functions.money import unsigned_rate, usd_rate
from sitebooks.operators.project import project
from sitebooks.operators.reshape import unpivot_months


def normalise_rates(raw: DataFrame) -> DataFrame:
    """Rate table with decoded dates; rates into US dollars become reciprocals.

    Every US-dollar rate is inverted, whatever its sign.  The sign character is
    dropped on those rows only, so other targets keep a negative rate.
    """
    return project(
        raw,
        {
            "Exchange_Rate_Period_Type_Code": "Exchanage_Rate_Type_Period",
            "From_Currency_Code": "From_Currency_Code",
            "To_Currency_Code": "To_Currency_Code",
            "Effective_From_Date": inverted_date(F.col("effective_from_date")),
            "Exchanage_Rate": usd_rate(F.col("Exchanage_Rate"), F.col("To_Currency_Code")),
            "Ratio_From_Currency_Unit_Number": F.col("Ratio_From_Currency_Unit").cast("double"),
            "Ratio_To_Currency_Unit_Number": F.col("Ratio_To_Currency_Unit").cast("double"),
            "Create_Date": F.current_timestamp(),
        },
    )


def negative_rate_types(raw: DataFrame) -> DataFrame:
    """Rate types that occur with a negative rate (a probe before loading)."""
    return (
        raw.where(F.col("Exchanage_Rate").try_cast("double") < 0)
        .select("Exchanage_Rate_Type_Period")
        .distinct()
    )


# Month columns of the estimate feed, the estimate label and the
# rate type of quarterly closing rates.
ESTIMATE_MONTHS = {
    m: f"{m}_Amount"
    for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
}
ESTIMATE_LABEL = "LE4"
QUARTER_RATE_TYPE = "ZQ1"


def estimate_at_two_rates(
    estimate: DataFrame,
    plan_rates: DataFrame,
    actual_rates: DataFrame,
    run_date: dt.date,
    label: str = ESTIMATE_LABEL,
    rate_type: str = QUARTER_RATE_TYPE,
    months: dict[str, str] | None = None,
    single_plan_rate: bool = True,
) -> DataFrame:
    """Monthly estimates with the plan rate and the rate of the run's quarter.

    Months without a value are dropped.  A currency without a plan rate gets 1;
    a row without an actual rate in the run quarter's last month is absent.
    Several plan rates of one currency and year would repeat rows; by default
    the latest exchange date is used, ``single_plan_rate=False`` keeps the
    repetition.
    """
    long = unpivot_months(
        estimate,
        ["Capex_Category_Type_Code", "Project_Name", "Currency_Code", "Ingestion_Revision_Date"],
        months or ESTIMATE_MONTHS,
        "Calender_MONTH",
        "VALUE",
    ).where(F.col("VALUE").isNotNull())
    month_no = month_number(F.col("Calender_MONTH"))
    q_year = F.year("Ingestion_Revision_Date")
    long = long.select(
        F.lit(label).alias("LE"),
        quarter_end_month(month_no).alias("Q_month"),
        q_year.alias("Q_year"),
        "Capex_Category_Type_Code",
        "Project_Name",
        "Currency_Code",
        "Calender_MONTH",
        "VALUE",
        q_year.alias("Calendar_year"),
        month_no.alias("LE_month_no"),
        F.col("Ingestion_Revision_Date").alias("Ingestion_DateTime"),
    )
    plan = plan_rates.where(F.col("TO_CURRENCY") == "USD").select(
        F.col("FROM_CURRENCY").alias("_pc"),
        F.right("EXCHANGE_DATE", F.lit(4)).try_cast("int").alias("_py"),
        F.col("EXCHANGE_DATE").alias("_pd"),
        F.col("EXCHANGE_RATE").cast("double").alias("_pr"),
    )
    if single_plan_rate:
        plan = plan.groupBy("_pc", "_py").agg(
            F.max_by("_pr", F.struct("_pd", "_pr")).alias("_pr")
        )
    run_quarter = (run_date.month + 2) // 3 * 3
    actual = actual_rates.where(
        (F.col("To_Currency_Code") == "USD")
        & (F.col("Exchange_Rate_Period_Type_Code") == rate_type)
        & (F.month("Effective_From_Date") == run_quarter)
    ).select(
        F.col("From_Currency_Code").alias("_ac"),
        F.year("Effective_From_Date").alias("_ay"),
        unsigned_rate(F.col("Exchanage_Rate")).alias("Actual_USD"),
        "Effective_From_Date",
    )
    return (
        long.join(
            actual, (long.Currency_Code == actual["_ac"]) & (long.Q_year == actual["_ay"]), "inner"
        )
        .join(plan, (long.Currency_Code == plan["_pc"]) & (long.Q_year == plan["_py"]), "left")
        .select(
            F.coalesce("_pr", F.lit(1.0)).alias("Plan_USD"),
            "Actual_USD",
            "Effective_From_Date",
            *long.columns,
        )
    )
