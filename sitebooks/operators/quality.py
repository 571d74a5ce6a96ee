"""Data-quality counts taken in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def watched(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """Attach counters to a frame; they are filled by the job that writes it.

    Replaces a separate count after each step.  ``rows`` is always counted.
    """
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(test).alias(name) for name, test in counts.items()]
    return df.observe(seen, *metrics), seen


class Steps:
    """Counters of the steps of one job, gathered by the run that writes its result.

    ``watch`` is handed to a job and called with a frame and the name of the
    step behind it; :meth:`frame` gives one row per step once the result has
    been computed, by one action and in full (a step is counted where it runs).
    """

    def __init__(self):
        self.seen: list[tuple[str, str | None, Observation]] = []

    def watch(self, df: DataFrame, step: str, key: str | None = None, unreadable: Column | None = None) -> DataFrame:
        """Count rows, those without ``key`` and those that are ``unreadable`` (lose a value in the step), as they pass."""
        tests = {"without_key": F.col(key).isNull()} if key else {}
        if unreadable is not None:
            tests["unreadable"] = unreadable
        df, seen = watched(df, **tests)
        self.seen.append((step, key, seen))
        return df

    def frame(self, spark: SparkSession) -> DataFrame:
        """``step_no, step, rows, key, without_key, unreadable`` in the order of the steps."""
        rows = []
        for i, (step, key, seen) in enumerate(self.seen):
            got = seen.get
            rows.append((i + 1, step, got["rows"], key, got.get("without_key"), got.get("unreadable")))
        return spark.createDataFrame(
            rows, "step_no int, step string, rows long, key string, without_key long, unreadable long"
        )


def unwatched(df: DataFrame, step: str, key: str | None = None, unreadable: Column | None = None) -> DataFrame:
    """The default of a job's ``watch``: nothing is counted."""
    return df


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: number of rows and of nulls per column."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def conditional_counts(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows meeting each test."""
    return df.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column with their row counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def layer_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several snapshots or layers, one row each."""
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("layer"), "row_count"
        )
        out = one if out is None else out.unionAll(one)
    return out


def job_status(df: DataFrame, message: str, ok_prefix: str = "Success") -> DataFrame:
    """Label each job row ``success`` or ``failed`` by the prefix of its message."""
    return df.withColumn(
        "status",
        F.when(F.col(message).startswith(ok_prefix), "success").otherwise("failed"),
    )
