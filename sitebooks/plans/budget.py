"""Monthly budgets: twelve amount columns turned into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import quarter_label
from sitebooks.operators.reshape import unpivot_months

# Month columns of the budget feed.
BUDGET_MONTHS = {
    m: f"{m}_Month"
    for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
}


def monthly_budget(
    budget: DataFrame, with_quarter: bool = True, months: dict[str, str] | None = None
) -> DataFrame:
    """Twelve rows per budget line, null months kept.

    Year and quarter come from the ingestion date, not from the month of the row.
    """
    out = unpivot_months(
        budget,
        ["Ingestion_Revision_Date", "Capex_Category_Type_Code", "Project_Name"],
        months or BUDGET_MONTHS,
        "Calender_MONTH",
        "VALUE",
    ).withColumn("Calendar_year", F.year("Ingestion_Revision_Date"))
    if with_quarter:
        out = out.withColumn("Quarter_Number", quarter_label(F.col("Ingestion_Revision_Date")))
    return out
