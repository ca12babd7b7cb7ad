"""The pending queue: a folder of small files of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from titlemill.schema import PENDING


def enqueue(ids: DataFrame, folder: str, now: str) -> None:
    """Append ids to the queue with the run's time stamp."""
    ids.select(
        F.col("id").cast("string"),
        F.lit(now).cast("timestamp").alias("enqueued_at"),
        F.lit(0).alias("attempts"),
    ).write.mode("append").parquet(folder)


def read_pending(spark: SparkSession, folder: str) -> DataFrame:
    """The queue as a batch table."""
    return spark.read.schema(PENDING).option("recursiveFileLookup", "true").parquet(folder)


def pending_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The queue as a stream, oldest file first. The query's checkpoint records what was taken."""
    reader = spark.readStream.schema(PENDING).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)
