"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from titlemill.session import durable

_ROWS_PER_PARTITION_BITS = 33  # documented layout of monotonically_increasing_id


def with_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add the zero-based position of each row in `order`, which must be a total order.

    Rows are range-partitioned and sorted once; the sorted copy is kept so that partition numbers
    stay what they are. Positions are the partition's offset plus the place within it. Only one
    count per partition is windowed and broadcast, never rows. Pass the key columns alone where
    the table is wide.
    """
    placed = durable(df.orderBy(*order)).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id()
        .bitwiseAND(F.lit((1 << _ROWS_PER_PARTITION_BITS) - 1))
        .alias("_place"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_place")).alias(name)
    )


def with_batch(df: DataFrame, order: list[str], size: int, name: str) -> DataFrame:
    """Add the zero-based number of the batch of `size` consecutive rows a row belongs to."""
    numbered = with_index(df, order, "_index")
    return numbered.select(*df.columns, F.floor(F.col("_index") / size).alias(name))
