"""Reading the item table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from titlemill.operators.selection import first_rows


def unenriched() -> Column:
    """An item still waits for enrichment while its description is NULL; '' counts as enriched."""
    return F.col("description").isNull()


def scan_unenriched(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids and titles of the oldest `limit` unenriched items; every one for None or 0.

    The order is by age, items without a time last, then id. It only decides which rows a limit
    keeps: without a limit nothing is sorted, with one only the items near the cut are.
    """
    todo = items.where(unenriched()).select(
        F.col("id").cast("string").alias("id"), "title", "created_at"
    )
    if not limit:
        return todo.select("id", "title")
    if todo.schema["created_at"].dataType.typeName() == "timestamp_ntz":
        micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', created_at)")
    else:
        micros = F.unix_micros("created_at")
    age = F.coalesce(micros, F.lit((1 << 63) - 1))
    return first_rows(todo, age, "id", limit).select("id", "title")


def count_unenriched(items: DataFrame) -> DataFrame:
    """One row with the number of unenriched items."""
    return items.where(unenriched()).agg(F.count("*").alias("unenriched"))


def dispatch_estimate(items: DataFrame, limit: int | None = None) -> DataFrame:
    """One row with the number of items a run would take: the answer of a dry run."""
    total = F.count("*")
    queued = F.least(total, F.lit(limit).cast("bigint")) if limit else total
    return items.where(unenriched()).agg(total.alias("unenriched"), queued.alias("queued"))


def single_item(items: DataFrame, item_id: str) -> DataFrame:
    """One item to run again, enriched or not."""
    return items.where(F.col("id") == item_id).select(F.col("id").cast("string"), "title")


def fetch_for_embedding(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Enriched items among `ids`, once each, with every column the embedding text reads.

    Repeated ids collapse before the shuffle, so an id queued very often stays cheap.
    """
    return items.where(~unenriched()).select(
        "id",
        "title",
        "description",
        "category",
        "tags",
        "audience",
        "metrics",
        "format_type",
        "language",
    ).join(ids.select("id").distinct(), "id", "left_semi")


def write_bucketed(items: DataFrame, table: str, buckets: int) -> None:
    """Store items bucketed and sorted by id.

    A keyed merge or fetch against such a table shuffles only its small side.
    """
    items.write.mode("errorifexists").bucketBy(buckets, "id").sortBy("id").saveAsTable(table)
