"""Reading stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as it is stored: filters and column choices reach the scan."""
    return spark.read.parquet(path)

