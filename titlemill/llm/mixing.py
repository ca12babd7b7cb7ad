"""Mixing sources to target weights by systematic sampling (operator 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titlemill.llm.common import WORD, partitions, stored, text_key, whole_text
from titlemill.operators.numbering import with_index

#: A document is used this often at most, so a source's target stops at as many times its size.
MOST_COPIES = 3
PLACE_BITS = 33  # documented layout of monotonically_increasing_id


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int = MOST_COPIES) -> DataFrame:
    """`sizes` (source, source_size) -> the same and target.

    Sources by code point, null last, take `weights` in turn and share the sum of all sizes. A
    target above `most` times its source's size is cut to that, and the excess shared again by
    weight among the others until none is above. Each round reads one row of sums. All sums are of
    whole numbers, so a target is one rounded division.
    """
    turn = F.expr(f"element_at(array({','.join(map(str, weights))}), int(pmod(_place, {len(weights)})) + 1)")
    named = sizes.withColumns({"_null": F.col("source").isNull(), "_key": F.coalesce("source", F.lit(""))})
    ranked = stored(with_index(named, ["_null", "_key"], "_place").withColumn("_weight", turn), "sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most_of = F.col("source_size") * most
    weight = ranked.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0]
    left, shares = total, weight
    while shares:
        # above its share: cap * shares > weight * left, in whole numbers
        above = F.col("_weight") * F.lit(left).cast("decimal(38,0)") > most_of.cast("decimal(38,0)") * shares
        cut = ranked.where(above).agg(
            F.coalesce(F.sum(most_of), F.lit(0)).alias("size"), F.coalesce(F.sum("_weight"), F.lit(0)).alias("weight")
        ).first()
        now = total - cut["size"], weight - cut["weight"]
        if now == (left, shares):
            break
        left, shares = now
    fair = F.col("_weight") * F.lit(left).cast("long") / F.lit(max(shares, 1))
    target = F.when(F.col("_weight") * F.lit(left).cast("decimal(38,0)") > most_of.cast("decimal(38,0)") * shares, most_of.cast("double"))
    return ranked.select("source", "source_size", (target.otherwise(fair) if shares else most_of.cast("double")).alias("target"))


def copies(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 7, most: int = MOST_COPIES) -> DataFrame:
    """`docs` (doc_id, text, source, more) -> doc_id, _hash (of the text), size, source_size, target, copies.

    A row's size is its number of words. Its expected copies are its source's target over its
    source's size. Rows of a source lie in order of size, so that the mix takes every length in
    proportion; expected copies are summed along that order, one random offset per source is
    added, and a row is emitted once for each whole number its sum crosses. The order is a global
    range sort of narrow rows: a source or size that holds most rows spans many tasks, and only
    one count per task and source is summed by window.

    A null or empty text has size 0 and counts like others; a null source is a source, last in
    order; rows that are equal in doc_id, source and text share their copies in any order; other
    columns are ignored; an empty table or one without words gives no copies.
    """
    text = whole_text()
    narrow = stored(
        docs.select(
            "doc_id", "source", F.xxhash64(text).alias("_hash"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "sizes",
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    order = ["source", "size", F.xxhash64("doc_id", "_hash", F.lit(seed)), "doc_id"]
    count = partitions(docs.sparkSession)
    placed = stored(
        narrow.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        "placed",
    ).withColumns(
        {"_part": F.shiftright("_id", PLACE_BITS), "_place": F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}
    )
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("source", "_part")
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .select("source", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    share = offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(
        offsets["source"].alias("_source"), F.col("_part").alias("_of"), "_first", "_before", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_expected"),
        (F.pmod(F.xxhash64(F.coalesce(offsets["source"], F.lit("")), offsets["source"].isNull(), F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)).alias("_offset"),
    )
    rank = F.col("_before") + F.col("_place") - F.col("_first")
    crossed = lambda n: F.floor(n * F.col("_expected") + F.col("_offset"))
    joined = placed.join(share, (placed["_part"] == share["_of"]) & placed["source"].eqNullSafe(share["_source"]))
    return joined.select(
        "doc_id", "_hash", "size", "source_size", "target",
        F.least(crossed(rank + 1) - crossed(rank), F.lit(most)).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), seed: int = 7) -> DataFrame:
    """The rows of `docs` as often as `copies` says, all columns as they are."""
    counts = copies(docs, weights, seed)
    per_key = counts.groupBy(F.struct("doc_id", "_hash").alias("_of")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    # One key column for the join and the window, so that texts are shuffled once.
    keyed = docs.withColumn("_at", text_key(docs))
    joined = keyed.join(per_key, keyed["_at"] == per_key["_of"])
    number = F.row_number().over(Window.partitionBy("_at").orderBy("source"))
    times = F.floor(F.col("_copies") / F.col("_rows")) + (number <= F.col("_copies") % F.col("_rows")).cast("int")
    return (
        joined.withColumn("_times", times.cast("int"))
        .where(F.col("_times") > 0)
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*docs.columns)
    )
