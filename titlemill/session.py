"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the plans are written for. Partition counts and memory stay with the cluster.

    Adaptive execution splits skewed probe sides, merges small shuffle partitions and switches to
    a broadcast join only when the measured size of a side is under the threshold.
    """
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get(CHECKPOINT_KEY, None)
    if shared is None:
        # A machine-local folder is only sound where driver and executors share one machine.
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="titlemill-checkpoint-")
    context.setCheckpointDir(shared)


def durable(df: DataFrame) -> DataFrame:
    """Compute `df` once into the shared checkpoint folder and return a reader of that copy.

    Used where a result must not be computed twice (model replies), or where later steps rely on
    the exact partition layout (row numbering). Losing executors afterwards costs nothing.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, for tables a job writes and reads back."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
