"""Retention: drop old years, and record what was dropped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sitebooks.operators.mutate import purge, purge_audit

KEEP_YEARS = 4


def apply_retention(
    tables: Mapping[str, tuple[DataFrame, str]], run_year: int, keep_years: int = KEEP_YEARS
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Kept rows per table, and one audit row per table.

    ``tables`` maps a table name to its frame and the name of its year column
    (a number, or a date that the scan can filter on).
    """
    kept, audit = {}, None
    for name, (df, at) in tables.items():
        kept[name] = purge(df, at, run_year, keep_years)
        row = purge_audit(df, name, at, run_year, keep_years)
        audit = row if audit is None else audit.unionAll(row)
    return kept, audit
