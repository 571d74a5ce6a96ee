"""JSON held in string columns, and dates held in file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

DATE_IN_PATH = r"/(\d{4})/(\d{1,2})/(\d{1,2})(?:/|$)"
# A directory may be a plain value or ``name=value``.
PERIOD_IN_PATH = r"/(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?(\d{4})/(?:[^/=]+=)?(\d{1,2})(?:/|$)"


def parsed(column: Column, schema: DataType | str) -> Column:
    """Parse JSON text; malformed text gives null."""
    return F.from_json(column, schema)


def date_from_path(path: Column) -> Column:
    """Date from a ``.../yyyy/mm/dd/...`` path; null when there is none."""
    text = F.concat_ws(
        "-",
        *[F.regexp_extract(path, DATE_IN_PATH, i) for i in (1, 2, 3)],
    )
    return F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")


def period_from_path(path: Column) -> tuple[Column, Column, Column]:
    """(country, year, month) from a ``.../<country>/<yyyy>/<mm>/...`` path."""
    country = F.regexp_extract(path, PERIOD_IN_PATH, 1)
    year = F.regexp_extract(path, PERIOD_IN_PATH, 2).try_cast("int")
    month = F.regexp_extract(path, PERIOD_IN_PATH, 3).try_cast("int")
    return country, year, month
