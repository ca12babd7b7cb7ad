"""Batches that close by count or by time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BATCH_SIZE = 100
MAX_WAIT_MS = 30_000


def count_or_time_batches(
    pending: DataFrame,
    size: int = BATCH_SIZE,
    wait_ms: int | None = MAX_WAIT_MS,
    shards: int | None = None,
) -> DataFrame:
    """shard, reason, ids: a batch whenever a shard holds `size` ids, or `wait_ms` after the first
    id since its last batch came.

    There are as many shards as shuffle partitions unless `shards` says otherwise. Each shard keeps fewer than `size` ids in state. Entries are dealt over shards by id and
    enqueue time, so repeats of one id do not load one shard; draining removes repeats. A bounded
    run (`availableNow`) passes None for `wait_ms`, since waiting for time-outs would keep it
    running, and finds the rest with `unbatched`.
    """

    def collect(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        held, since = (list(state.get[0]), state.get[1]) if state.exists else ([], None)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"shard": [key[0]], "reason": ["time"], "ids": [held]})
            return
        for frame in frames:
            held.extend(frame["id"])
            while len(held) >= size:
                batch, held, since = held[:size], held[size:], None
                yield pd.DataFrame({"shard": [key[0]], "reason": ["count"], "ids": [batch]})
        if held:
            now = 0 if wait_ms is None else state.getCurrentProcessingTimeMs()
            since = now if since is None else since
            state.update((held, since))
            if wait_ms is not None:
                # later arrivals do not push the deadline forward
                state.setTimeoutDuration(max(1, since + wait_ms - now))
        elif state.exists:
            state.remove()

    timeout = (
        GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    )
    shards = shards or int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard = F.pmod(F.xxhash64("id", "enqueued_at"), F.lit(shards)).cast("int")
    return (
        pending.select("id", shard.alias("shard"))
        .groupBy("shard")
        .applyInPandasWithState(
            collect,
            "shard int, reason string, ids array<string>",
            "ids array<string>, since long",
            "append",
            timeout,
        )
    )


def unbatched(pending: DataFrame, batches: DataFrame) -> DataFrame:
    """Ids no emitted batch holds yet: the tail to flush after a bounded run."""
    emitted = batches.select(F.explode("ids").alias("id")).distinct()
    return pending.select("id").distinct().join(emitted, "id", "left_anti")
