"""Model replies kept by the content of their conversation, so a run started again pays for none twice."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from titlemill.operators.model import BATCH_SIZE, ChatModel, structure

SCHEMA = "content string, attempt int, reply string, error string"


def content_key(messages: Column) -> Column:
    """SHA-256 of the conversation as JSON: equal conversations, equal keys, whoever asks."""
    return F.sha2(F.to_json(messages), 256)


class ReplyStore:
    """Replies below ``{folder}/replies``: (content, attempt, reply, error), appended per attempt.

    Every attempt of every run appends the replies it paid for as one write job. A job commits its
    files at its end, so a driver lost during the model calls leaves no half-written part that
    readers would see; one lost after them leaves every reply it paid for. Keys hold the attempt
    too: a retry of a failed or invalid reply is a new call, a repeated run of the same attempt is
    not. The table grows by one narrow row per distinct conversation and attempt.
    """

    def __init__(self, folder: str):
        self.path = f"{folder}/replies"

    def known(self, spark: SparkSession) -> DataFrame:
        """All stored replies, one per (content, attempt); empty before the first write."""
        try:
            stored = spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException:
            return spark.createDataFrame([], SCHEMA)
        # Two rows with one conversation (asked for two names in one attempt) keep one reply.
        best = F.max(F.struct(F.col("error").isNull().alias("ok"), "reply", "error"))
        return stored.groupBy("content", "attempt").agg(best.alias("r")).select("content", "attempt", "r.reply", "r.error")

    def ask(
        self,
        rows: DataFrame,
        key: str,
        messages: Column,
        model: ChatModel,
        attempt: int,
        calls: int,
        batch_size: int = BATCH_SIZE,
    ) -> DataFrame:
        """key, reply, error of each row of `rows`, the model asked only for conversations the
        store lacks for this attempt.

        New conversations are dealt over `calls` partitions, asked once each, and appended before
        any reply is read back: the stored copy is the only one used, so the replies a row sees
        are the ones a later run will find. A null key is asked like any other.
        """
        spark = rows.sparkSession
        talks = rows.select(key, messages.alias("messages")).withColumn("content", content_key(F.col("messages")))
        have = self.known(spark).where(F.col("attempt") == attempt).select("content")
        new = (
            talks.join(have, "content", "left_anti")
            .dropDuplicates(["content"])
            .select("content", "messages")
            .repartition(calls, "content")
        )
        asked = structure(new, "content", F.col("messages"), model, batch_size)
        asked.select("content", F.lit(attempt).alias("attempt"), "reply", "error").write.mode("append").parquet(self.path)
        replies = self.known(spark).where(F.col("attempt") == attempt).drop("attempt")
        return talks.join(replies, "content", "left").select(key, "reply", "error")
