"""Publishing: curated tables with their country and a refresh timestamp."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.codes import COUNTRY_ALIASES, recode
from sitebooks.operators.joins import lookup
from sitebooks.operators.project import rename, stamp

# Plan columns and their published names.
PLAN_PUBLISH_NAMES = {
    "KPI": "KPI_Type_Text",
    "Year": "Calendar_Year",
    "Month": "Calendar_Month",
    "Plan_Amount": "Plan_LC_Amount",
    "Plan_Amount_USD": "Plan_USD_Amount",
    "Plan_YTD_Amount": "Plan_Ytd_LC_Amount",
    "Plan_YTD_Amount_USD": "Plan_Ytd_USD_Amount",
    "Legally_Committed": "Legally_Committed_Indicator",
    "Lease_Classification": "Lease_Classification_Code",
    "Local_Currency": "Local_Currency_Code",
    "No_Of_Lease_Sites": "Lease_Site_Count",
    "Auto_Renewal_Y_N": "Auto_Renewal_Indicator",
}


def with_country(
    df: DataFrame,
    companies: DataFrame,
    how: str = "inner",
    names: Mapping[str, str] | None = None,
    company: str = "COMPANY_CODE",
    stamp_column: str | None = "refresh_date",
    at: Column | None = None,
) -> DataFrame:
    """Rename, add ``country`` by company code, add the refresh timestamp.

    Baseload and plan tables use ``how="inner"``, actuals and estimates
    ``how="left"``.
    """
    pairs = companies.select("company", "country").distinct()
    out = lookup(rename(df, names or {}), pairs, {company: "company"}, {"country": "country"}, how)
    return stamp(out, stamp_column, at) if stamp_column else out


def with_region(
    df: DataFrame,
    regions: DataFrame,
    aliases: Mapping[str, str] | None = None,
    stamp_column: str | None = "refresh_date",
    at: Column | None = None,
) -> DataFrame:
    """Add ``COUNTRY_CODE`` by country name, after aligning the names that differ."""
    known = regions.withColumn(
        "_name", recode(F.col("country_name"), dict(aliases or COUNTRY_ALIASES))
    )
    out = lookup(df, known, {"country_name": "_name"}, {"COUNTRY_CODE": "COUNTRY_CODE"}, "inner")
    return stamp(out, stamp_column, at) if stamp_column else out
