"""Estimates whose past months are replaced by actuals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitebooks.functions.calendar import month_label, month_number
from sitebooks.operators.project import conform
from sitebooks.operators.reshape import month_spine
from sitebooks.schemas import schema

# Last actual month per estimate round, classification groups and
# spellings of the advance-payment value type.
CUTOFFS = {"LE1": 0, "LE2": 3, "LE3": 6, "LE4": 9}
RENEWAL_CLASSES = (
    "LR", "LPG Equipment", "LNG Equipment", "CON", "OPT", "Tap UP", "Non RE Equipment", "CPI",
    "EV OTG FC", "LPG EQ", "LNG EQ", "NON RE",
)
NEW_SITE_CLASSES = ("NTI", "EV", "NTS", "NFR", "EV  DEST", "EV SFS", "EV OTG Hub", "EV DEST")
ADVANCE_PAYMENT = "ADVANCE_PAYMENT"
ADVANCE_SPELLINGS = (
    "ADVANCE_PAYMENTS", "ADVANCE PAYMENTS", "ADVANCE_PAYMENT", "ADVANCE PAYMENT",
)

ACTUAL_KEYS = ["LEASE_ID", "COMPANY_CODE", "SITE_ID", "LEASE_CLASSIFICATION_CODE"]
ACTUAL_ATTRIBUTES = [
    "KPI_TYPE_TEXT", "SITE_NAME", "TRANSACTION_ID", "LEASE_SITE_COUNT", "LOCAL_CURRENCY_CODE",
    "FLOW_TYPE_CODE", "PROFIT_CENTER", "LEGALLY_COMMITTED_INDICATOR",
    "GROWTH_SUSTAIN_SPLIT_TEXT",
]
MONEY = ["LE_AMOUNT", "LE_USD_AMOUNT"]


def value_type(code: Column) -> Column:
    """One spelling for advance payments; a missing type counts as one."""
    return F.when(
        code.isNull() | F.upper(code).isin(*ADVANCE_SPELLINGS), F.lit(ADVANCE_PAYMENT)
    ).otherwise(code)


def classification_group(code: Column) -> Column:
    """``LR``, ``NTI`` or null for an unmapped classification."""
    return F.when(code.isin(*RENEWAL_CLASSES), "LR").when(code.isin(*NEW_SITE_CLASSES), "NTI")


def monthly_actuals(
    actuals: DataFrame, year: int, relabel_other_years: bool = False
) -> DataFrame:
    """Twelve rows per lease and attribute set for one year, 0 where nothing was booked.

    Amounts are summed per lease, company, site, classification and month; the
    attributes of one booking (the smallest as a tuple) stand for the group.
    ``relabel_other_years`` lets actuals of every year count as bookings of
    ``year``, equal amounts only once.
    """
    if not relabel_other_years:
        actuals = actuals.where(F.col("CALENDAR_YEAR").cast("int") == year)
    else:
        actuals = actuals.where(F.col("CALENDAR_YEAR").isNotNull())
    booked = (
        actuals.groupBy(
            *ACTUAL_KEYS,
            F.col("CALENDAR_YEAR").cast("int").alias("_year"),
            F.upper(F.trim("CALENDAR_MONTH")).alias("_month"),
        )
        .agg(
            F.sum(F.col("ACTUAL_LC_AMOUNT").cast("decimal(18,2)")).alias("LE_AMOUNT"),
            F.sum(F.col("ACTUAL_USD_AMOUNT").cast("decimal(18,2)")).alias("LE_USD_AMOUNT"),
            F.min(F.struct(*ACTUAL_ATTRIBUTES)).alias("_a"),
        )
        .select(
            *ACTUAL_KEYS,
            "_a.*",
            month_number(F.col("_month")).alias("NO_MONTH"),
            *MONEY,
        )
    )
    if relabel_other_years:
        booked = booked.distinct()
    spine = month_spine(booked, [*ACTUAL_KEYS, *ACTUAL_ATTRIBUTES], "NO_MONTH", MONEY)
    return spine.withColumns(
        {
            "CALENDAR_MONTH": month_label(F.col("NO_MONTH")),
            "CALENDAR_YEAR": F.lit(str(year)),
            "VALUE_TYPE": F.lit(ADVANCE_PAYMENT),
        }
    )


def replace_with_actuals(
    estimates: DataFrame,
    actuals: DataFrame,
    year: int,
    cutoffs: dict[str, int] | None = None,
    relabel_other_years: bool = False,
    run_date: dt.date | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """All estimate rounds of a year with their past months taken from actuals.

    Round ``LEn`` holds actuals up to its cut-off month and estimates after it;
    the respective other months are present with amount 0.  A round with cut-off
    0 is the estimate unchanged.  Equal rows of a round with actuals collapse
    into one, those of a round without actuals do not.  ``optional`` columns of
    the target may be missing in the inputs.
    """
    cutoffs = cutoffs or CUTOFFS
    cut_of = F.create_map(*[F.lit(v) for kv in cutoffs.items() for v in kv])
    day = F.current_date() if run_date is None else F.lit(run_date)
    target = schema("estimate_with_actuals")

    planned = estimates.where(
        (F.col("CALENDAR_YEAR").cast("int") == year) & F.col("LE_TYPE_CODE").isin(*cutoffs)
    ).withColumns(
        {
            "VALUE_TYPE": value_type(F.col("VALUE_TYPE_CODE")),
            "LEASE_CLASSIFICATION_CODE": classification_group(F.col("LEASE_CLASSIFICATION_CODE")),
            "NO_MONTH": month_number(F.col("CALENDAR_MONTH")),
            "_cut": F.try_element_at(cut_of, F.col("LE_TYPE_CODE")),
            "LE_ACT": F.concat("LE_TYPE_CODE", F.lit("_ACT")),
        }
    )
    planned = planned.withColumns(
        {
            out: F.when(F.col("NO_MONTH") <= F.col("_cut"), 0.0).otherwise(
                F.coalesce(F.col(src), F.lit(0.0))
            )
            for out, src in zip(MONEY, ("LE_LC_AMOUNT", "LE_USD_AMOUNT"))
        }
    )

    rounds = F.array(
        *[
            F.struct(F.lit(f"{name}_ACT").alias("LE_ACT"), F.lit(cut).alias("_cut"))
            for name, cut in cutoffs.items()
            if cut > 0
        ]
    )
    booked = (
        monthly_actuals(actuals, year, relabel_other_years)
        .withColumn("_round", F.explode(rounds))
        .select("*", "_round.*")
        .withColumns(
            {
                m: F.when(F.col("NO_MONTH") <= F.col("_cut"), F.col(m)).otherwise(0.0)
                for m in MONEY
            }
        )
    )

    def shaped(df: DataFrame) -> DataFrame:
        df = df.withColumn("LE_ACTUAL_PLAN1", F.lit("LE"))
        return conform(df.withColumn("CREATE_DATE", day).withColumn("UPDATE_DATE", day), target, optional)

    plain = shaped(planned.where("_cut = 0"))
    mixed = shaped(planned.where("_cut > 0")).unionByName(shaped(booked)).distinct()
    return plain.unionByName(mixed)
