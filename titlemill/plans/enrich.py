"""The whole job: scan, discover, read, structure, validate, merge, queue, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from titlemill.functions.reply import coverage_label, messages, validate, with_founding_year
from titlemill.operators.attempts import MAX_ATTEMPTS, run_with_attempts
from titlemill.operators.discovery import discover, distinct_titles
from titlemill.operators.lookup import salted_lookup
from titlemill.operators.merge import ENRICHED, merge_items, merge_vectors
from titlemill.operators.model import (
    BATCH_SIZE,
    DIMENSION,
    ChatModel,
    EmbeddingModel,
    embed_items,
    structure,
)
from titlemill.operators.pages import with_context
from titlemill.operators.replies import ReplyStore
from titlemill.operators.runlog import FAILED, OK, quarantine, succeeded, write_report
from titlemill.session import durable
from titlemill.sources.items import fetch_for_embedding, scan_unenriched
from titlemill.sources.pending import enqueue
from titlemill.sources.snapshots import Snapshots


@dataclass(frozen=True)
class Enriched:
    """Result of a run, one row per selected item in `outcomes`."""

    outcomes: DataFrame
    items: DataFrame
    log: DataFrame
    quarantine: DataFrame
    pending: DataFrame


def contexts(selected: DataFrame, snapshots: Snapshots) -> DataFrame:
    """name, copies, url, extract, qid, source, extra, context of each distinct title."""
    found = discover(distinct_titles(selected), snapshots)
    return with_context(found, snapshots.page_snapshot, snapshots.site_signals)


def structured(
    texts: DataFrame,
    system: str,
    model: ChatModel,
    batch_size: int = BATCH_SIZE,
    max_attempts: int = MAX_ATTEMPTS,
    concurrency: int | None = None,
    replies: ReplyStore | None = None,
) -> DataFrame:
    """name, error, attempts and the validated record of each text; failures are tried again.

    Texts are dealt over `concurrency` partitions, each of which calls the model in turn; None
    takes the session's number of shuffle partitions. With a reply store, conversations it holds
    for an attempt are read from it and only the others asked (and stored).
    """
    calls = concurrency or parallel_calls(texts)

    def attempt(rows: DataFrame, number: int) -> DataFrame:
        dealt = rows.select("name", "context").repartition(calls, "name")
        talk = messages(system, F.col("context"))
        if replies is None:
            answered = structure(dealt, "name", talk, model, batch_size)
        else:
            answered = replies.ask(dealt, "name", talk, model, number, calls, batch_size)
        return validated(answered)

    def validated(answered: DataFrame) -> DataFrame:
        checked = answered.withColumn("record", validate(F.col("reply")))
        return checked.select(
            "name",
            F.coalesce("error", F.when(~F.col("record.valid"), F.col("record.error"))).alias(
                "error"
            ),
            *[F.col(f"record.{c}").alias(c) for c in [*ENRICHED, "metrics_extra"]],
        )

    return run_with_attempts(texts, "name", attempt, max_attempts)


def parallel_calls(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def enrich(
    items: DataFrame,
    snapshots: Snapshots,
    system: str,
    model: ChatModel,
    now: str,
    limit: int | None = None,
    only: DataFrame | None = None,
    batch_size: int = BATCH_SIZE,
    max_attempts: int = MAX_ATTEMPTS,
    concurrency: int | None = None,
    replies: ReplyStore | None = None,
) -> Enriched:
    """Enrich the oldest `limit` unenriched items, or the (id, title) rows of `only`.

    With `replies`, model replies are kept by conversation and attempt in that store and read from
    it when a run is started again (see `ReplyStore`).

    Items without a title have nothing to look up: they are logged as failed and quarantined.

    Titles, not items, are looked up and sent to the model: equal titles have equal contexts.
    Contexts and replies are materialised, since the steps after them read them several times.
    """
    selected = only if only is not None else scan_unenriched(items, limit)
    if limit or only is not None:
        selected = durable(selected)
    titled = selected.where(F.col("title").isNotNull())
    texts = durable(contexts(titled, snapshots))
    answers = structured(texts, system, model, batch_size, max_attempts, concurrency, replies)
    year = F.col("extra")["founding_year"]
    records = durable(
        texts.select("name", "copies", "source", "extra", F.length("context").alias("chars"))
        .join(answers, "name")
        .withColumn("metrics", with_founding_year(F.col("metrics"), year))
    )
    untitled = selected.where(F.col("title").isNull()).select(
        "id", F.lit("the title is missing").alias("error"), F.lit("").alias("source"),
        F.lit(0).alias("chars"), F.lit(0).alias("attempts"),
    )
    outcomes = salted_lookup(
        titled.withColumnRenamed("title", "name"), records, "name", "copies", "id"
    ).unionByName(untitled, allowMissingColumns=True)
    done = outcomes.where(F.col("error").isNull())
    ok = F.col("error").isNull()
    log = outcomes.select(
        "id",
        F.col("name").alias("title"),
        F.when(ok, F.lit(OK)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(ok, F.col("category")).otherwise(F.lit("")).alias("category"),
        F.when(ok, coverage_label(F.col("metrics.geographic_coverage")))
        .otherwise(F.lit(""))
        .alias("tier"),
        "source",
        F.col("chars").cast("int").alias("context_chars"),
        F.coalesce("error", F.lit("")).alias("error"),
        "attempts",
    )
    return Enriched(
        outcomes=outcomes,
        items=merge_items(items, done.select("id", *ENRICHED, "metrics_extra"), now),
        log=log,
        quarantine=quarantine(log, "structure"),
        pending=done.select("id"),
    )


def run(
    items: DataFrame,
    snapshots: Snapshots,
    system: str,
    chat: ChatModel,
    embedder: EmbeddingModel,
    now: str,
    folder: str,
    limit: int | None = None,
    batch_size: int = BATCH_SIZE,
    dimension: int = DIMENSION,
    max_attempts: int = MAX_ATTEMPTS,
    concurrency: int | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """One production run written below `folder`; returns the item table with vectors.

    Tables: replies, enriched, log, quarantine, items, vectors, report/*. The input is never
    overwritten: a new snapshot is written beside it. Chat replies are kept in `folder`'s reply
    store as they arrive, so the same call with the same folder after a lost driver asks the model
    only for conversations it had not yet answered.
    """
    spark = items.sparkSession
    result = enrich(
        items, snapshots, system, chat, now, limit, only, batch_size, max_attempts, concurrency,
        ReplyStore(folder),
    )
    result.items.write.mode("overwrite").parquet(f"{folder}/enriched")
    result.log.write.mode("overwrite").parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    quarantine(log, "structure").write.mode("overwrite").parquet(f"{folder}/quarantine")

    enriched = spark.read.schema(result.items.schema).parquet(f"{folder}/enriched")
    found = fetch_for_embedding(enriched, succeeded(log))
    found = found.repartition(concurrency or parallel_calls(found), "id")
    embed_items(found, embedder, batch_size, dimension).write.mode("overwrite").parquet(
        f"{folder}/vectors"
    )
    vectors = spark.read.parquet(f"{folder}/vectors")
    write_report(log, vectors, f"{folder}/report")
    written = vectors.where(F.col("embedding").isNotNull())
    merge_vectors(enriched, written).write.mode("overwrite").parquet(f"{folder}/items")
    failed = vectors.where(F.col("embedding").isNull())
    if not failed.isEmpty():
        enqueue(failed, f"{folder}/pending", now)
    return spark.read.schema(result.items.schema).parquet(f"{folder}/items")
