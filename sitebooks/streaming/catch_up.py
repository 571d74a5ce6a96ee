"""Catch-up ingestion: each run takes the files that arrived since the last one.

The checkpoint of the file stream is the run log: it records every file that was
taken, so late files of an already processed day are not lost and nothing is
taken twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sitebooks.sources.files import with_file_date


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int = 10_000,
    dated: bool = False,
) -> None:
    """Process all unseen files below ``source`` into Parquet at ``target``, then stop.

    ``transform`` is a row-wise step (for example the JSON parse); ``dated`` adds
    ``file_date`` from a ``yyyy/mm/dd`` path before it.  The batch size bounds
    the work of one micro-batch, not the run.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    if dated:
        stream = with_file_date(stream)
    if transform is not None:
        stream = transform(stream)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
