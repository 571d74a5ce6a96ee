"""Dates, months, quarters and fiscal periods."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels in calendar order.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
FULL_MONTHS = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER",
    "OCTOBER", "NOVEMBER", "DECEMBER",
)


def month_number(label: Column) -> Column:
    """1..12 for a short or full month name in any case, else null."""
    numbers = {name: i for names in (FULL_MONTHS, MONTHS) for i, name in enumerate(names, 1)}
    table = F.create_map(*[F.lit(v) for pair in numbers.items() for v in pair])
    return F.try_element_at(table, F.upper(F.trim(label)))


def month_label(number: Column) -> Column:
    """``JAN``..``DEC`` for 1..12, else null."""
    labels = F.array(*[F.lit(m) for m in MONTHS])
    return F.when(number.between(1, 12), F.element_at(labels, number.cast("int")))


def inverted_date(number: Column) -> Column:
    """Decode a date stored as ``99999999 - yyyymmdd``; null when it is no date."""
    digits = (F.lit(99999999) - number.cast("int")).cast("string")
    return F.try_to_timestamp(F.lpad(digits, 8, "0"), F.lit("yyyyMMdd")).cast("date")


def fiscal_period(run_date: Column) -> Column:
    """Fiscal period text ``0MM.yyyy`` of the month before ``run_date``."""
    return F.date_format(F.add_months(run_date.cast("date"), -1), "'0'MM.yyyy")


def quarter_label(date: Column) -> Column:
    """``Q1``..``Q4``."""
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def quarter_end_month(month: Column) -> Column:
    """Last month (3, 6, 9, 12) of the quarter a month number falls in."""
    return (F.ceil(month / 3) * 3).cast("int")


def in_year(ts: Column, year: int) -> Column:
    """``ts`` falls in ``year``, written as a range so that it reaches the scan."""
    return (ts >= F.lit(dt.date(year, 1, 1))) & (ts < F.lit(dt.date(year + 1, 1, 1)))


def in_years(ts: Column, first: int, last: int) -> Column:
    """``ts`` falls in ``first``..``last`` (both included), as one range."""
    return (ts >= F.lit(dt.date(first, 1, 1))) & (ts < F.lit(dt.date(last + 1, 1, 1)))


def on_days(ts: Column, days: Sequence[dt.date]) -> Column:
    """``ts`` falls on one of the days, as ranges that reach the scan."""
    ranges = [(ts >= F.lit(d)) & (ts < F.lit(d + dt.timedelta(days=1))) for d in days]
    return reduce(lambda a, b: a | b, ranges, F.lit(False))


def last_complete_years(ts: Column, run_date: dt.date, years: int = 2) -> Column:
    """``ts`` falls in the ``years`` calendar years before the run date's year."""
    return in_years(ts, run_date.year - years, run_date.year - 1)


def local_time(ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of an instant held in UTC."""
    return F.from_utc_timestamp(ts, zone)
