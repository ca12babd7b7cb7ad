"""Telling rows apart by a bitmap of the keys they might have, without moving them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2^25 bits are 4 MB; fuller bitmaps let more rows through to the exact join, and lose none.
SLOTS = 1 << 25


def _slot(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS))


def split_by_keys(rows: DataFrame, columns: list[str], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a key of `keys` in `columns`, and those that have none; nulls are equal.

    `keys` has columns of the same names and types. They are hashed to a bitmap of fixed size, and
    `rows` is tested where it is read: what comes first must still be joined with `keys`, as keys
    may share a bit; the others need not be shuffled for that.
    """
    slot = F.col("_slot")
    blocks = (
        keys.select(_slot(columns).alias("_slot"))
        .groupBy(F.bitmap_bucket_number(slot).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    )
    held = F.broadcast(blocks.agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("_blocks")))
    position = F.bitmap_bit_position(_slot(columns))
    bits = F.try_element_at(F.col("_blocks"), F.bitmap_bucket_number(_slot(columns)))
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return rows.join(held, marked, "left_semi"), rows.join(held, marked, "left_anti")
