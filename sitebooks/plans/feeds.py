"""Multi-country feeds unioned to one target schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sitebooks.operators.project import conform, rename
from sitebooks.operators.sets import union_all
from sitebooks.sources.files import read_feed, read_period

# Source names of the cash-capex feed and their curated names.
CASH_CAPEX_NAMES = {
    "Country": "Country_Name",
    "Country Code": "Country_Code",
    "Company Code": "Company_Code",
    "CAPIN ID": "CAPIN_Unique_Id",
    "Fiscal Period": "FISCAL_Period",
    "Date - Year": "Date_Year",
    "Date - Month": "Date_Month",
    "Amount @ActualRate": "ActualRate",
    "Amount @PlanRate": "PlanRate",
    "Currency Code": "Currency_Code",
    "Project Code": "Project_Code",
    "Project Text": "Project_Text",
    "CAPIN Type Project Code": "CAPIN_Type_Project_Code",
    "CAPIN Type Project Text": "CAPIN_Type_Project_Text",
    "CAPIN Type Child Code": "CAPIN_Type_Child_Code",
    "CAPIN Type Child Text": "CAPIN_Type_Child_Text",
    "Entry Name": "Entry_Text",
}


def combine(
    frames: Sequence[DataFrame],
    target: StructType,
    names: dict[str, str] | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Rename, cast to the target by name and union; a column that some frames lack is null there."""
    return union_all([rename(f, names or {}) for f in frames], target, optional)


def period_feed(
    spark: SparkSession,
    roots: Sequence[str],
    countries: Sequence[str],
    year: int,
    month: int,
    target: StructType,
    names: dict[str, str] | None = None,
    optional: Sequence[str] = (),
    stored: StructType | None = None,
    layout: str = "{country}/{year:04d}/{month:02d}",
) -> DataFrame:
    """One month of a feed over all countries and restricted roots, as the target schema.

    ``stored`` declares the columns of the files, so that no footer is read for
    it; without it the footers of the month are merged.  A renamed or missing column fails unless it is ``optional``.  Check the result with ``require_rows`` where an empty month is an error.
    """
    df = read_period(
        spark, roots, countries, year, month, merge_schema=stored is None, schema=stored, layout=layout
    )
    return conform(rename(df, names or {}), target, optional)


def history_feed(
    spark: SparkSession,
    roots: Sequence[str],
    target: StructType,
    names: dict[str, str] | None = None,
    pattern: str = "*/*/*/*.parquet",
    optional: Sequence[str] = (),
    stored: StructType | None = None,
) -> DataFrame:
    """The whole history of a feed over all its roots, exact copies removed.

    ``stored`` declares the columns of the files; without it all footers are merged.
    """
    df = read_feed(spark, roots, pattern, merge_schema=stored is None, schema=stored, skip_missing=True)
    return conform(rename(df, names or {}), target, optional).distinct()
