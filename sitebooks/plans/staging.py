"""Column-mapped full refreshes of actuals, estimates and plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import on_days
from sitebooks.operators.project import conform, project
from sitebooks.schemas import schema

# Curated name -> raw name, shared by the three staging loads.
_SHARED = {
    "KPI_TYPE_TEXT": "KPI",
    "SITE_ID": "SITE_ID",
    "SITE_NAME": "SITE_NAME",
    "LEASE_ID": "LEASE_ID",
    "TRANSACTION_ID": "TRANSACTION_ID",
    "COMPANY_CODE": "COMPANY_CODE",
    "CALENDAR_YEAR": "YEAR",
    "CALENDAR_MONTH": "MONTH",
    "LEASE_CLASSIFICATION_CODE": "LEASE_CLASSIFICATION",
    "LEGALLY_COMMITTED_INDICATOR": "LEGALLY_COMMITTED",
    "LOCAL_CURRENCY_CODE": "LOCAL_CURRENCY",
    "CREATE_DATE": "LOAD_DATE",
    "UPDATE_DATE": "UPDATE_DATE",
    "LEASE_SITE_COUNT": "NO_OF_LEASE_SITES",
}
ACTUAL_NAMES = {
    **_SHARED,
    "ACTUAL_LC_AMOUNT": "ACTUAL_AMOUNT",
    "ACTUAL_USD_AMOUNT": "ACTUAL_AMOUNT_USD",
    "COMMENTS_TEXT": "TEXT",
    "POSTING_PERIOD": "POSTING_PERIOD",
    "PROFIT_CENTER": "PROFIT_CENTER",
    "G_L_ACCOUNT": "G_L_ACCOUNT",
    "ASSIGNMENT_CODE": "ASSIGNMENT",
    "FLOW_TYPE_CODE": "FLOW_TYPE",
    "DOCUMENT_TYPE_CODE": "DOCUMENT_TYPE",
    "GROWTH_SUSTAIN_SPLIT_TEXT": "GROWTH_SUSTAIN_SPLIT_TEXT",
}
ESTIMATE_NAMES = {
    **_SHARED,
    "LE_TYPE_CODE": "LE_TYPE",
    "VALUE_TYPE_CODE": "VALUE_TYPE",
    "LE_LC_AMOUNT": "LE_AMOUNT",
    "LE_USD_AMOUNT": "LE_AMOUNT_USD",
    "AUTO_RENEWAL_INDICATOR": "AUTO_RENEWAL_Y_N",
}
PLAN_NAMES = {
    **_SHARED,
    "VALUE_TYPE_CODE": "VALUE_TYPE",
    "PLAN_LC_AMOUNT": "PLAN_AMOUNT",
    "PLAN_USD_AMOUNT": "PLAN_AMOUNT_USD",
    "AUTO_RENEWAL_INDICATOR": "AUTO_RENEWAL_Y_N",
}
OPEX_ESTIMATE_NAMES = {
    "COUNTRY_NAME": "COUNTRY_NAME",
    "OPEX_LE_USD_AMOUNT": "OPEX_LE_AMOUNT_USD",
    "OPEX_LE_LC_AMOUNT": "OPEX_LE_AMOUNT",
    "CALENDAR_YEAR": "YEAR",
    "LOCAL_CURRENCY_CODE": "LOCAL_CURRENCY",
    "LE_TYPE_CODE": "LE_TYPE",
}
OPEX_PLAN_NAMES = {
    "GLOBAL_COST_ELEMENT": "GLOBAL_COST_ELEMENT",
    "COUNTRY_CODE": "COMPANY_CODE",
    "SFS_LINE_ITEM": "SFS_LINE_ITEM",
    "CALENDAR_MONTH": "MONTH",
    "CALENDAR_YEAR": "YEAR",
    "OPEX_PL_USD_AMOUNT": "OPEX_PL_AMOUNT_USD",
    "OPEX_PL_LC_AMOUNT": "OPEX_PL_AMOUNT",
}
# Bookings that count as actual payments.
PAYMENT_FLOW_TYPES = ("Q20", "Q24")
PROFIT_CENTRES = (800001, 800002, 800003, 800004, 800005, 800006, 800007)

# Columns of the curated estimates that no staging load fills.
UNSTAGED = ("LEASE_START_DATE", "LEASE_EXPIRY_DATE")


def stage_actuals(raw: DataFrame) -> DataFrame:
    """Raw actuals under curated names."""
    return project(raw, ACTUAL_NAMES)


def stage_estimates(raw: DataFrame) -> DataFrame:
    """Raw estimates under curated names."""
    return project(raw, ESTIMATE_NAMES)


def stage_plan(raw: DataFrame) -> DataFrame:
    """Raw plan under curated names."""
    return project(raw, PLAN_NAMES)


def stage_opex_estimates(raw: DataFrame) -> DataFrame:
    """Operating-cost estimates; the year stays an integer."""
    return project(raw, OPEX_ESTIMATE_NAMES).withColumn(
        "CALENDAR_YEAR", F.col("CALENDAR_YEAR").cast("int")
    )


def stage_opex_plan(raw: DataFrame) -> DataFrame:
    """Operating-cost plan; the year stays an integer."""
    return project(raw, OPEX_PLAN_NAMES).withColumn(
        "CALENDAR_YEAR", F.col("CALENDAR_YEAR").cast("int")
    )


def payment_actuals(
    staged: DataFrame,
    load_dates: Sequence[dt.date],
    flow_types: Sequence[str] = PAYMENT_FLOW_TYPES,
    profit_centres: Sequence[int] = PROFIT_CENTRES,
) -> DataFrame:
    """Distinct payment bookings of the accepted loads."""
    kept = staged.where(
        on_days(F.col("CREATE_DATE"), load_dates)
        & F.col("FLOW_TYPE_CODE").isin(list(flow_types))
        & F.col("PROFIT_CENTER").isin(list(profit_centres))
    )
    return conform(kept, schema("actual")).distinct()


def curated_estimates(staged: DataFrame, optional: Sequence[str] = UNSTAGED) -> DataFrame:
    """Estimates in the curated layout, columns matched by name.

    ``optional`` columns may be missing; by default those that no staging load fills.
    """
    return conform(staged, schema("estimate"), optional)
