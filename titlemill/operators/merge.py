"""Keyed updates of the item table, as a new snapshot of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ENRICHED = ["description", "category", "tags", "audience", "metrics"]


def _content(updates: DataFrame, columns: list[str]) -> Column:
    """A hash of the values, so that of updates with equal order the same one wins in every run."""
    maps = {f.name for f in updates.schema.fields if isinstance(f.dataType, T.MapType)}
    return F.xxhash64(*[F.sort_array(F.map_entries(c)) if c in maps else F.col(c) for c in columns])


def last_per_key(updates: DataFrame, key: str, order: str | None) -> DataFrame:
    """The last update of each key; without an order, one of them.

    Combined before the shuffle, so a hot key stays cheap.
    """
    rest = [c for c in updates.columns if c != key]
    turn = F.struct(*([F.col(order)] if order else []), _content(updates, rest))
    return (
        updates.groupBy(key)
        .agg(F.max_by(F.struct(*rest), turn).alias("_last"))
        .select(key, "_last.*")
    )


def merge_by_key(items: DataFrame, updates: DataFrame, columns: list[str], **stamps) -> DataFrame:
    """Replace `columns` of the items whose id is in `updates` (one row per id).

    An update only: unknown ids are dropped. A NULL in a matched update overwrites, so matching
    is tracked by a flag, not by `coalesce`. `stamps` are set on matched rows. The update side is
    the small one, and adaptive execution broadcasts it when it measures small; items bucketed by
    id are not shuffled either way.
    """
    new = updates.select(
        "id", *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched")
    )
    values = {c: F.col(f"_new_{c}") for c in columns}
    values.update(stamps)
    return items.join(new, "id", "left").select(
        *[
            F.when(F.col("_matched"), values[c]).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in items.columns
        ]
    )


def merge_items(items: DataFrame, updates: DataFrame, now: str, order: str = "seq") -> DataFrame:
    """Write enriched fields; the last update per id wins. `now` is the run's time stamp."""
    columns = [c for c in [*ENRICHED, "metrics_extra"] if c in updates.columns and c in items.columns]
    latest = last_per_key(updates, "id", order if order in updates.columns else None)
    stamps = {}
    if "updated_at" in items.columns:
        stamps["updated_at"] = F.lit(now).cast(items.schema["updated_at"].dataType)
    return merge_by_key(items, latest, columns, **stamps)


def merge_vectors(items: DataFrame, vectors: DataFrame, order: str | None = None) -> DataFrame:
    """Write embeddings by id; no other column changes."""
    return merge_by_key(items, last_per_key(vectors, "id", order), ["embedding"])


def unwritten(requested: DataFrame, written: DataFrame) -> DataFrame:
    """Requested ids that were not written, once each: the set to queue again."""
    return requested.select("id").distinct().join(
        written.select("id").distinct(), "id", "left_anti"
    )


def remaining(todo: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of `todo` without a finished counterpart."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
