"""The first rows of a table in an order, without ordering the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from titlemill.operators.numbering import with_index

#: Accuracy of the quantile sketch: its rank error is about total / ACCURACY.
ACCURACY = 100_000


def first_rows(df: DataFrame, key: Column, tie: str, limit: int) -> DataFrame:
    """The `limit` rows of `df` that come first by (`key`, `tie`); all rows where there are fewer.

    `key` must be numeric and not null (map nulls to a bound first); (`key`, `tie`) should be a
    total order, or which of equal rows are kept is arbitrary. A quantile sketch proposes two cuts
    around the wanted rank, exact counts confirm them (the band widens until they hold), rows below
    the lower cut are taken unsorted, and only the band between the cuts is ordered. Each step is a
    distributed aggregate returning one row; the plan is the same for every limit.
    """
    keyed = df.withColumn("_key", key)
    total = keyed.count()
    if limit <= 0:
        return df.limit(0)
    if limit >= total:
        return df
    share, margin = limit / total, 2.0 / ACCURACY
    while True:
        cuts = keyed.agg(F.percentile_approx("_key", [max(0.0, share - margin), min(1.0, share + margin)], ACCURACY)).first()[0]
        low, high = cuts[0], cuts[1]
        counts = keyed.agg(
            F.count_if(F.col("_key") < low).alias("below"), F.count_if(F.col("_key") <= high).alias("upto")
        ).first()
        if counts["below"] <= limit <= counts["upto"]:
            break
        margin *= 8  # at share +- 1 the cuts are the least and greatest keys, which always hold
    below = counts["below"]
    sure = keyed.where(F.col("_key") < low)
    band = keyed.where(F.col("_key").between(low, high))
    placed = with_index(band, ["_key", tie], "_place").where(F.col("_place") < limit - below).drop("_place")
    return sure.unionByName(placed).drop("_key")
