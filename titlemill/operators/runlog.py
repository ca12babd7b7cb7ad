"""Reports over the run log (see `schema.RUN_LOG`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

OK, FAILED = "ok", "failed"
ERROR_CHARS = 80


def succeeded(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == OK)


def failed(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == FAILED)


def totals(log: DataFrame) -> DataFrame:
    """One row: processed, ok, failed and the context sizes of successes, in one pass."""
    chars = F.when(F.col("status") == OK, F.col("context_chars"))
    return log.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("status") == OK).alias("ok"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.min(chars).alias("min_chars"),
        F.max(chars).alias("max_chars"),
        F.sum(chars.cast("bigint")).alias("total_chars"),
    )


def source_distribution(log: DataFrame) -> DataFrame:
    """source, n over successes, most frequent first."""
    return (
        succeeded(log)
        .groupBy("source")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "source")
    )


def success_list(log: DataFrame) -> DataFrame:
    """Successes by source."""
    return (
        succeeded(log)
        .select("id", "title", "category", "tier", "source", "context_chars")
        .orderBy("source", "id")
    )


def failure_list(log: DataFrame) -> DataFrame:
    """Failures with their error cut to 80 characters."""
    return failed(log).select(
        "id", "title", F.substring("error", 1, ERROR_CHARS).alias("error"), "attempts"
    )


def quarantine(log: DataFrame, stage: str) -> DataFrame:
    """What is kept about failed rows for review and a later run."""
    return failed(log).select("id", "title", F.lit(stage).alias("stage"), "error", "attempts")


def write_totals(vectors: DataFrame) -> DataFrame:
    """One row: how many embeddings can be written and how many failed."""
    return vectors.agg(
        F.count_if(F.col("embedding").isNotNull()).alias("written"),
        F.count_if(F.col("embedding").isNull()).alias("failed"),
    )


def backlog(items: DataFrame, pending: DataFrame) -> DataFrame:
    """One row: unenriched items and depth of the pending queue."""
    zero = F.lit(0).cast("bigint")
    waiting = items.agg(F.count_if(F.col("description").isNull()).alias("unenriched"))
    depth = pending.agg(F.count("*").alias("pending"))
    both = waiting.withColumn("pending", zero).unionByName(depth.withColumn("unenriched", zero))
    return both.agg(F.sum("unenriched").alias("unenriched"), F.sum("pending").alias("pending"))


def write_report(log: DataFrame, vectors: DataFrame | None, folder: str) -> None:
    """Write every report table below `folder`."""
    tables = {
        "totals": totals(log),
        "sources": source_distribution(log),
        "succeeded": success_list(log),
        "failed": failure_list(log),
    }
    if vectors is not None:
        tables["embeddings"] = write_totals(vectors)
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
