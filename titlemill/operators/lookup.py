"""Joining rows to a table with one row per key when some keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key is split once it holds more than 1/MAX_HOT_KEYS of all rows. Fewer than MAX_HOT_KEYS keys
# can do so, which bounds what is broadcast to that many (hash, copies) pairs.
MAX_HOT_KEYS = 2_000


def lookup(
    rows: DataFrame, table: DataFrame, keys: list[tuple[Column, str]], how: str = "left"
) -> DataFrame:
    """Join `rows` with a table that has one row per key, where many rows may share a key.

    Adaptive execution splits a skewed partition of `rows` only if both sides of the join come
    straight from a shuffle. A deduplicated table would instead keep the partitions of its own
    aggregation. The hash joins in as a further key, so both sides are shuffled for this join;
    the extra move is of one row per key.
    """
    condition = F.xxhash64(*[k for k, _ in keys]) == F.xxhash64(*[F.col(c) for _, c in keys])
    for key, column in keys:
        condition = (key == F.col(column)) & condition
    return rows.join(table, condition, how)


def salted_lookup(
    rows: DataFrame, table: DataFrame, key: str, weight: str, spread_by: str
) -> DataFrame:
    """Inner join of `rows` with `table` on `key`; `table[weight]` is the key's row count.

    The entries of hot keys are copied and their rows dealt over the copies by `spread_by`, so no
    task receives a whole hot key. Other keys have one copy. `table` is read three times and
    should be materialised.
    """
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    threshold = max(total // MAX_HOT_KEYS, 1)
    copies = F.ceil(F.col(weight) / threshold).cast("int")
    # Equal hashes of different keys only add needless copies: both sides use the larger number.
    hot = (
        table.where(F.col(weight) > threshold)
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.max(copies).alias("_copies"))
    )

    def with_copies(df: DataFrame) -> DataFrame:
        hashed = df.withColumn("_hash", F.xxhash64(key))
        return hashed.join(F.broadcast(hot), "_hash", "left").drop("_hash")

    dealt = F.pmod(F.xxhash64(spread_by), F.coalesce("_copies", F.lit(1))).cast("int")
    left = with_copies(rows).withColumn("_salt", dealt).drop("_copies")
    salts = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    right = with_copies(table).withColumn("_salt", F.explode(salts)).drop("_copies", weight)
    return left.join(right, [key, "_salt"]).drop("_salt")
