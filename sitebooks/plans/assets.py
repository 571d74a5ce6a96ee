"""Net book values, cost-centre mapping and tax rates, loaded incrementally."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import fiscal_period
from sitebooks.functions.codes import strip_zero_pair
from sitebooks.operators.filters import newer_than, reject_blank
from sitebooks.operators.mutate import conditional_update
from sitebooks.operators.project import conform, rename
from sitebooks.schemas import schema

# Watermark when the target holds no rows yet, value names per feed
# and the indicator that marks a bad cost-centre row.
FIRST_WATERMARK = dt.datetime(2020, 1, 1)
NBV_VALUE = {
    "fixed_asset_nbv": ("Fixed_Asset_NBV", "FIXED_ASSET_NET_BOOK_VALUE"),
    "rou_asset_nbv": ("ROU_Asset_NBV", "ROU_ASSET_NET_BOOK_VALUE"),
}
BAD_INDICATOR = "BAD_DATA"


def high_watermark(target: DataFrame, column: str) -> DataFrame:
    """One row with the newest load time of a table (null when it is empty)."""
    return target.agg(F.max(column).alias("watermark"))


def company_countries(companies: DataFrame, company: str, country: str) -> DataFrame:
    """Distinct (company, country) pairs with a usable country."""
    return reject_blank(companies.select(company, country).distinct(), country)


def load_net_book_values(
    feed: DataFrame,
    target: DataFrame,
    companies: DataFrame,
    contract: str = "fixed_asset_nbv",
    one_country: bool = True,
) -> DataFrame:
    """New net-book-value rows with normalised site codes and their country.

    Two countries for one company would repeat rows; by default the first in
    alphabetical order is used, ``one_country=False`` keeps the repetition.
    """
    source, curated = NBV_VALUE[contract]
    rows = rename(feed.distinct(), {"Ingestion_Revision_Date": "CREATE_DATE", source: curated})
    rows = rows.withColumn("SITE_CODE", strip_zero_pair(F.col("SITE_CODE")))
    fresh = newer_than(rows, "CREATE_DATE", high_watermark(target, "CREATE_DATE"), FIRST_WATERMARK)
    dim = company_countries(companies, "COMP_CODE", "COUNTRY").withColumnRenamed(
        "COMP_CODE", "COMPANY_CODE"
    )
    if one_country:
        dim = dim.groupBy("COMPANY_CODE").agg(F.min("COUNTRY").alias("COUNTRY"))
    joined = fresh.drop("COUNTRY").join(dim, ["COMPANY_CODE"], "left")
    return conform(joined, schema(contract))


def load_tax_rates(feed: DataFrame, target: DataFrame, run_date: dt.date) -> DataFrame:
    """Tax rates newer than the target, labelled with the previous fiscal period."""
    rows = rename(feed.distinct(), {"Ingestion_Revision_Date": "CREATE_DATE"})
    fresh = newer_than(rows, "CREATE_DATE", high_watermark(target, "CREATE_DATE"), FIRST_WATERMARK)
    labelled = fresh.withColumn("FISCAL_PERIOD", fiscal_period(F.lit(run_date)))
    return conform(labelled, schema("tax_rate"))


def load_cost_centre_sites(
    feed: DataFrame,
    target: DataFrame,
    run_date: dt.date,
    reload_all: bool = False,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Cost-centre mapping rows with the previous fiscal period; bad indicators blanked.

    ``reload_all=True`` ignores the watermark, so that every run returns the
    whole feed again.  ``optional`` columns of the contract may be missing.
    """
    rows = rename(feed.distinct(), {"Ingestion_Revision_Date": "CREATE_DATE"})
    if not reload_all:
        mark = high_watermark(target, "CREATE_DATE")
        rows = newer_than(rows, "CREATE_DATE", mark, FIRST_WATERMARK)
    rows = rows.withColumn("FISCAL_PERIOD", fiscal_period(F.lit(run_date)))
    rows = conditional_update(rows, "Indicator", F.col("Indicator") == BAD_INDICATOR, "")
    return conform(rows, schema("cost_centre_site"), optional)
