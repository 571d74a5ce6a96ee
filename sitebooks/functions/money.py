"""Amounts, rates and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(amount: Column, precision: int = 18, scale: int = 2) -> Column:
    """Amount as a decimal, so that sums do not depend on the order of rows."""
    return amount.cast(f"decimal({precision},{scale})")


def exact_sum(amount: Column, scale: int = 2) -> Column:
    """Order-independent sum of a 2-place amount, returned as double."""
    return F.sum(exact(amount, 18, scale)).cast("double")


def unsigned_rate(rate: Column) -> Column:
    """Rate with a sign character removed wherever it stands; null if unreadable."""
    return F.replace(rate.cast("string"), F.lit("-"), F.lit("")).try_cast("double")


def usd_rate(rate: Column, target: Column) -> Column:
    """Reciprocal of the unsigned rate for US-dollar targets, else the rate.

    A zero rate gives null rather than an error.
    """
    return F.when(target == "USD", F.try_divide(F.lit(1.0), unsigned_rate(rate))).otherwise(
        rate.try_cast("double")
    )


def share(part: Column, total: Column) -> Column:
    """Percentage of a total; null for a zero total."""
    return F.try_divide(part.cast("double") * F.lit(100.0), total.cast("double"))


def bounded_queue(ongoing: Column, servers: Column) -> Column:
    """Customers queueing, the arriving one included: never below zero."""
    return F.greatest(ongoing + 1 - servers, F.lit(0))
