"""Running a fallible step again for the rows that failed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from titlemill.session import durable

MAX_ATTEMPTS = 3


def run_with_attempts(
    work: DataFrame,
    key: str,
    step: Callable[[DataFrame, int], DataFrame],
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """Apply `step` to all rows, then to those that failed, up to `max_attempts` times.

    `step(rows, attempt)` returns one row per input key with an `error` column, NULL for success.
    Each attempt is materialised, so a model is not asked twice for the same attempt. The result
    has one row per key with `attempts`; a success carries no error of earlier attempts.
    """
    outcome = None
    todo = work
    for attempt in range(1, max_attempts + 1):
        tried = durable(step(todo, attempt).withColumn("attempts", F.lit(attempt)))
        failed = tried.where(F.col("error").isNotNull())
        last = attempt == max_attempts or failed.isEmpty()
        settled = tried if last else tried.where(F.col("error").isNull())
        outcome = settled if outcome is None else outcome.unionByName(settled)
        if last:
            break
        again = failed.select(F.col(key).alias("_again"))
        todo = work.join(again, work[key].eqNullSafe(again["_again"]), "left_semi")
    return outcome
