"""Connected components of a table of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every neighbour is linked to the least one of its centre instead of the centre: the larger
    neighbours (`large`), or the smaller ones and the centre itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    renamed = least.withColumnRenamed("a", "_a")
    moved = both.join(renamed, both["a"] == renamed["_a"]).select("a", "b", "m")
    if large:
        made = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return made.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def least_members(links: DataFrame, name: str) -> DataFrame:
    """`links` (a, b) of comparable keys -> a, b: each linked key but the least of its component,
    and that least key. Links are stored after each round; rounds grow with the logarithm of the
    longest path. A key with very many links is met in partial aggregates and joins that split.
    """
    now = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = None
    while True:
        now = stored(_star(_star(now, True), False), name)
        mark = sign(now)
        if mark == before or not mark[0]:
            return now
        before = mark
