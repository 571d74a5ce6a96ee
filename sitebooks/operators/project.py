"""Projections: renames, casts, constants, fills and column order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.operators.quality import unwatched


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select columns under new names: ``{target name: source name or expression}``."""
    return df.select(
        *[
            (F.col(src) if isinstance(src, str) else src).alias(dst)
            for dst, src in mapping.items()
        ]
    )


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}``; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def upper_names(df: DataFrame) -> DataFrame:
    """Upper-case every column name."""
    return df.toDF(*[c.upper() for c in df.columns])


def drop_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop a list of columns; absent ones are ignored.

    Takes a sequence, and refuses a bare string, which would be read as a list
    of one-letter names.
    """
    if isinstance(names, str):
        raise TypeError("pass a list of column names, not a string")
    return df.drop(*names)


def unreadable(df: DataFrame, schema: StructType) -> Column:
    """True for a row of which a value cannot be cast to its type in ``schema`` (columns by name)."""
    have = {c.lower(): c for c in df.columns}
    test = F.lit(False)
    for field in schema.fields:
        source = have.get(field.name.lower())
        if source is not None and df.schema[source].dataType != field.dataType:
            value = F.col(f"`{source}`")
            test = test | (value.isNotNull() & value.try_cast(field.dataType).isNull())
    return test


def conform(
    df: DataFrame,
    schema: StructType,
    optional: Sequence[str] = (),
    lenient: bool = False,
    watch: Callable[..., DataFrame] = unwatched,
) -> DataFrame:
    """Columns of ``schema`` by name, in its order, cast to its types.

    A column may be missing only if it is named in ``optional``; it is then a
    typed null.  A value that cannot be cast fails the job, unless ``lenient``
    turns it to null; ``watch`` counts the rows this happens to
    (:class:`sitebooks.operators.quality.Steps`).
    """
    if lenient:
        df = watch(df, "lenient cast", unreadable=unreadable(df, schema))
    may_lack = {name.lower() for name in optional}
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        source = have.get(field.name.lower())
        if source is None and field.name.lower() not in may_lack:
            raise ValueError(f"column {field.name} is missing")
        column = F.lit(None) if source is None else F.col(f"`{source}`")
        if source is None or df.schema[source].dataType != field.dataType:
            column = column.try_cast(field.dataType) if lenient else column.cast(field.dataType)
        out.append(column.alias(field.name))
    return df.select(*out)


def constants(df: DataFrame, values: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add typed constants ``{name: (value, type)}``; a null keeps its type."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in values.items()})


def round_columns(df: DataFrame, names: Sequence[str], places: int = 2) -> DataFrame:
    """Round the named amounts half up."""
    return df.withColumns({n: F.round(F.col(n), places) for n in names})


def fill_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Null to 0 in the named amounts."""
    return df.fillna(0, subset=list(names))


def stamp(df: DataFrame, name: str = "refresh_date", at: Column | None = None) -> DataFrame:
    """Add a load timestamp (the query's own time unless ``at`` is given)."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)
