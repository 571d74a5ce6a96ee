"""File sources: Parquet paths, country/period feeds and delimited text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitebooks.functions.text import date_from_path, period_from_path


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """One scan over one or more Parquet paths (globs allowed)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a path or glob matches something.

    "Path not found" is the only error tolerated; anything else the file
    service reports is raised.
    """
    try:
        spark.read.schema("_probe int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths or globs that match something."""
    return [p for p in paths if path_exists(spark, p)]


def read_feed(
    spark: SparkSession,
    roots: str | Sequence[str],
    pattern: str = "*/*/*/*.parquet",
    merge_schema: bool = False,
    schema: StructType | None = None,
    skip_missing: bool = False,
) -> DataFrame:
    """All files of a feed laid out as ``root/<country>/<yyyy>/<mm>/*.parquet``.

    Several roots (the main feed and restricted-country siblings) become one
    scan.  With a ``schema`` no footers are merged, which is what a large feed
    wants; ``merge_schema`` reads every footer.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    paths = [f"{r.rstrip('/')}/{pattern}" for r in roots]
    if skip_missing:
        paths = existing(spark, paths)
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no feed files under {roots}")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def with_period(df: DataFrame) -> DataFrame:
    """Add ``feed_country``, ``feed_year`` and ``feed_month`` taken from the file path."""
    country, year, month = period_from_path(F.col("_metadata.file_path"))
    return df.select(
        "*",
        country.alias("feed_country"),
        year.alias("feed_year"),
        month.alias("feed_month"),
    )


def with_file_date(df: DataFrame, name: str = "file_date") -> DataFrame:
    """Add the date found in a ``.../yyyy/mm/dd/...`` file path."""
    return df.select("*", date_from_path(F.col("_metadata.file_path")).alias(name))


def read_period(
    spark: SparkSession,
    roots: str | Sequence[str],
    countries: Sequence[str],
    year: int,
    month: int,
    merge_schema: bool = False,
    schema: StructType | None = None,
    layout: str = "{country}/{year:04d}/{month:02d}",
) -> DataFrame:
    """One period of the listed countries; countries without that period are skipped.

    ``layout`` names the directory of a country's period below a root.  Only the
    directories of the period are listed, once per root, and read.  A year-month path
    without files for any country is an error unless ``schema`` is given, which
    then yields an empty frame.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    place = lambda country: layout.format(country=country, year=year, month=month)
    # One listing per root: the file service picks the countries that are there.
    plain = [c for c in countries if not set(c) & set("{},*?[]\\")]
    wanted = [place("{" + ",".join(plain) + "}") if len(plain) > 1 else place(c) for c in (plain[:1] or [])]
    wanted += [place(c) for c in countries if c not in plain]
    paths = existing(spark, [root.rstrip("/") + "/" + w for root in roots for w in wanted])
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no files of {year:04d}/{month:02d} under {roots}")
        empty = spark.createDataFrame([], schema)
        return empty.select(
            "*",
            F.lit(None).cast("string").alias("feed_country"),
            F.lit(None).cast("int").alias("feed_year"),
            F.lit(None).cast("int").alias("feed_month"),
        )
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return with_period(reader.parquet(*paths))


def read_delimited(
    spark: SparkSession, path: str, sep: str = "|", schema: StructType | str | None = None
) -> DataFrame:
    """Delimited text with a header line; all columns are text unless a schema is given."""
    reader = spark.read.option("sep", sep).option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def has_any_column(df: DataFrame, *names: str) -> bool:
    """True when the frame has at least one of the columns (case-insensitive)."""
    have = {c.lower() for c in df.columns}
    return any(n.lower() in have for n in names)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, given schema."""
    return spark.createDataFrame([], schema)
