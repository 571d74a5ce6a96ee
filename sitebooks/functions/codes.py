"""Code and name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region names that differ between the two country lists.
COUNTRY_ALIASES = {
    "USA": "United States of America",
    "UK": "United Kingdom",
    "Hong Kong": "Hongkong",
    "Czech": "Czech Republic",
}

# Product markers of non-road, gas, additive and truck grades.
# Matched as a case-insensitive regular expression, so "." and "( )" keep their
# regular-expression meaning.
SPECIAL_PRODUCT_MARKERS = (
    "00003", "00006", "00007", "00008", "00009", "00011", "00015", "00016",
    "adblue", "auto", "cng", "hvo", "h v o", "lng", "lpg", "frei (2)", "truck",
    "gnv", "gpl", "huisbrandoli", "klima", "l.p.g", "mix", "hydrogen",
)
DEFAULT_PRODUCT_CLASS = "Mogas / non-truck diesel"


def strip_zero_pair(code: Column) -> Column:
    """Drop one leading ``00`` from a code; other codes are unchanged."""
    return F.when(code.startswith("00"), F.substr(code, F.lit(3))).otherwise(code)


def is_blank(code: Column) -> Column:
    """True for null, empty and all-space values."""
    return code.isNull() | (F.trim(code) == "")


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Replace listed values, keep all others (also nulls)."""
    out = None
    for old, new in mapping.items():
        test, hit = value == F.lit(old), F.lit(new)
        out = F.when(test, hit) if out is None else out.when(test, hit)
    return value if out is None else out.otherwise(value)


def product_class(
    info: Column,
    markers: tuple[str, ...] = SPECIAL_PRODUCT_MARKERS,
    default: str = DEFAULT_PRODUCT_CLASS,
) -> Column:
    """The product text itself when a marker occurs in it, else ``default`` (also for null)."""
    return F.when(info.rlike("(?i)" + "|".join(markers)), info).otherwise(F.lit(default))


def composite_key(*parts: Column) -> Column:
    """Concatenate parts as text; null as soon as one part is null."""
    return F.concat(*[p.cast("string") for p in parts])


def row_key(*parts: Column) -> Column:
    """64-bit surrogate id of a natural key, computed without any shuffle."""
    return F.xxhash64(*parts)
