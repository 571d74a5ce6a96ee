"""Catch-up ingestion that keeps the run log with the data, batch by batch.

A micro-batch writes its rows and its log rows into directories named by the
batch.  A batch that is run again, after a lost driver for example, overwrites
its own directories: nothing is taken twice, and the log never runs ahead of or
behind the data by more than the batch that is repeated next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch"


def write_batch(rows: DataFrame, batch: int, data: str, log: str, job: str, group: str, day: str) -> None:
    """Write one batch: its rows, then the newest day of each group in it.  Writing it again gives the same files' content.

    The log is summed up from what was written, so both tell the same even if
    the source would be read differently a second time.
    """
    spark = rows.sparkSession
    at = f"{data}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(at)
    written = spark.read.schema(rows.schema).parquet(at)
    seen = written.groupBy(group).agg(F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows"))
    seen.select(F.lit(job).alias("job"), group, "last_day", "rows").write.mode("overwrite").parquet(f"{log}/{BATCH}={batch}")


def ingest_logged(
    spark: SparkSession,
    source: str,
    schema: StructType,
    data: str,
    log: str,
    checkpoint: str,
    job: str,
    group: str,
    day: str,
    files_per_batch: int = 10_000,
) -> None:
    """Take all files below ``source`` that no earlier run took, then stop.

    ``group`` (the country) and ``day`` are columns of the rows.  Which files a
    batch holds is fixed in the checkpoint before it runs, so a repeated batch
    has the same rows.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    run = lambda rows, batch: write_batch(rows, batch, data, log, job, group, day)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_log(spark: SparkSession, log: str, group: str) -> DataFrame:
    """The current log: per job and group the newest day, all rows taken, and the last batch."""
    return spark.read.parquet(log).groupBy("job", group).agg(
        F.max("last_day").alias("last_day"), F.sum("rows").alias("rows"), F.max(BATCH).cast("long").alias("last_batch")
    )
