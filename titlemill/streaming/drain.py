"""Embedding what the pending queue holds, as a streaming query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from titlemill.operators.merge import merge_vectors
from titlemill.operators.model import BATCH_SIZE, DIMENSION, EmbeddingModel, embed_items
from titlemill.session import durable
from titlemill.sources.items import fetch_for_embedding
from titlemill.sources.pending import pending_stream

MAX_ATTEMPTS = 3
INTERVAL = "30 seconds"


@dataclass(frozen=True)
class EmbeddingStore:
    """Folders below one root. Every micro-batch owns a subfolder it overwrites when replayed."""

    root: str

    @property
    def pending(self) -> str:
        return f"{self.root}/pending"

    @property
    def vectors(self) -> str:
        return f"{self.root}/vectors"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def results(self) -> str:
        return f"{self.root}/results"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def drain_batch(
    batch: DataFrame,
    batch_id: int,
    items: DataFrame,
    model: EmbeddingModel,
    store: EmbeddingStore,
    batch_size: int = BATCH_SIZE,
    dimension: int = DIMENSION,
    max_attempts: int = MAX_ATTEMPTS,
) -> None:
    """Embed one micro-batch of ids and write vectors, requeued ids and a result record.

    Vectors go to a delta folder per micro-batch, not into the item table: rewriting that table
    every half minute would not scale. `apply_vectors` merges the deltas when it suits.
    """
    # Duplicates collapse before the shuffle's reduce side, however often one id was queued.
    wanted = durable(
        batch.groupBy("id").agg(
            F.min("enqueued_at").alias("enqueued_at"),
            F.max(F.coalesce("attempts", F.lit(0))).alias("attempts"),
        )
    )
    found = fetch_for_embedding(items, wanted)
    vectors = durable(embed_items(found, model, batch_size, dimension))
    written = vectors.where(F.col("embedding").isNotNull())
    written.select("id", "embedding").write.mode("overwrite").parquet(
        f"{store.vectors}/batch_id={batch_id}"
    )

    missed = (
        wanted.join(written.select("id"), "id", "left_anti")
        .join(vectors.select("id", "error"), "id", "left")
        .select(
            "id",
            "enqueued_at",
            (F.col("attempts") + 1).cast("int").alias("attempts"),
            F.coalesce("error", F.lit("no enriched item with this id")).alias("error"),
        )
    )
    given_up = F.col("attempts") >= max_attempts
    missed.where(given_up).write.mode("overwrite").parquet(
        f"{store.quarantine}/batch_id={batch_id}"
    )
    retry = missed.where(~given_up).select("id", "enqueued_at", "attempts")
    if not retry.isEmpty():
        retry.write.mode("overwrite").parquet(f"{store.pending}/requeued={batch_id}")

    outcome = wanted.join(
        vectors.select("id", "embedding", F.lit(True).alias("fetched")), "id", "left"
    )
    counts = outcome.agg(
        F.count_if(F.col("embedding").isNotNull()).alias("processed"),
        F.count_if(F.col("fetched") & F.col("embedding").isNull()).alias("failed"),
        F.count("*").alias("total"),
    )
    status = (
        F.when(F.col("total") == 0, F.lit("empty"))
        .when(F.col("processed") + F.col("failed") == 0, F.lit("no_items"))
        .when(F.col("processed") == 0, F.lit("api_error"))
        .otherwise(F.lit("ok"))
    )
    counts.select(status.alias("status"), "processed", "failed", "total").write.mode(
        "overwrite"
    ).parquet(f"{store.results}/batch_id={batch_id}")


def start_drain(
    spark: SparkSession,
    items: Callable[[], DataFrame],
    model: EmbeddingModel,
    store: EmbeddingStore,
    flush: bool = False,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Drain the queue every 30 seconds, or once and to the end with `flush`.

    `items` is called per micro-batch, so each one sees the current snapshot. One query per
    checkpoint takes the place of a lock; a replayed micro-batch overwrites its own output.
    Ids queued again during a flush wait for the next one.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        drain_batch(batch, batch_id, items(), model, store, **options)

    writer = pending_stream(spark, store.pending, max_files).writeStream.foreachBatch(
        handle
    ).option("checkpointLocation", store.checkpoint)
    writer = writer.trigger(availableNow=True) if flush else writer.trigger(processingTime=INTERVAL)
    return writer.start()


def apply_vectors(spark: SparkSession, items: DataFrame, store: EmbeddingStore) -> DataFrame:
    """The item table with the newest vector of each id merged in."""
    deltas = spark.read.schema("id string, embedding array<float>, batch_id bigint").parquet(
        store.vectors
    )
    return merge_vectors(items, deltas, order="batch_id")
