import time

from pyspark.sql import functions as F

from titlemill.sources.pending import enqueue, pending_stream, read_pending
from titlemill.streaming.buffer import count_or_time_batches, unbatched
from titlemill.streaming.drain import EmbeddingStore, apply_vectors, start_drain

NOW = "2024-06-01 00:00:00"


def make_items(spark):
    return spark.range(30).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") == 7, "poison").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
        F.when(F.col("id") != 9, "d").alias("description"),
        F.lit("News").alias("category"),
        F.lit("site").alias("format_type"),
        F.lit("uk").alias("language"),
        F.array(F.lit("x")).alias("tags"),
        F.expr("named_struct('interests', array('i'))").alias("audience"),
        F.expr("named_struct('geographic_coverage', array('g'), 'content_topics', array('c'))").alias("metrics"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )


def test_drain_writes_each_id_once_and_survives_a_restart(spark, tmp_path):
    def embedder(texts):
        return [[float(len(t)), 1.0] if "poison" not in t else [] for t in texts]

    items = make_items(spark)
    store = EmbeddingStore(str(tmp_path / "store"))
    ids = spark.range(20).select(F.col("id").cast("string").alias("id"))
    enqueue(ids.union(ids), store.pending, NOW)
    enqueue(spark.createDataFrame([("99",)], "id string"), store.pending, NOW)

    def flush():
        start_drain(spark, lambda: items, embedder, store, flush=True, dimension=2).awaitTermination()

    def vectors():
        return sorted(r["id"] for r in spark.read.parquet(store.vectors).select("id").collect())

    good = sorted(str(i) for i in range(20) if i not in (7, 9))
    flush()
    assert vectors() == good
    result = spark.read.parquet(store.results).first()
    assert (result["status"], result["processed"], result["failed"], result["total"]) == ("ok", 18, 1, 21)

    # A new query continues from the checkpoint; misses come back until their attempts run out.
    for _ in range(3):
        flush()
    assert vectors() == good
    lost = {r["id"]: r["error"] for r in spark.read.parquet(store.quarantine).collect()}
    assert lost == {
        "7": "dimension 0, not 2",
        "9": "no enriched item with this id",
        "99": "no enriched item with this id",
    }
    enqueue(spark.createDataFrame([("25",)], "id string"), store.pending, NOW)
    flush()
    assert vectors() == sorted(good + ["25"])
    merged = apply_vectors(spark, items, store)
    assert merged.where(F.col("embedding").isNotNull()).count() == 19
    assert merged.count() == 30


def test_buffer_closes_by_count_and_leaves_a_tail(spark, tmp_path):
    folder, out, ck = (str(tmp_path / n) for n in ("pending", "out", "ck"))
    enqueue(spark.range(250).select(F.col("id").cast("string").alias("id")), folder, NOW)
    query = (
        count_or_time_batches(pending_stream(spark, folder), size=10, wait_ms=None, shards=4)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", ck)
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(90)
    batches = spark.read.schema("shard int, reason string, ids array<string>").parquet(out)
    assert {(r["reason"], len(r["ids"])) for r in batches.collect()} == {("count", 10)}
    tail = unbatched(read_pending(spark, folder), batches)
    assert tail.count() == 250 - 10 * batches.count()
    assert tail.count() < 4 * 10


def test_buffer_closes_by_time(spark, tmp_path):
    folder, ck = str(tmp_path / "pending"), str(tmp_path / "ck")
    enqueue(spark.range(5).select(F.col("id").cast("string").alias("id")), folder, NOW)
    query = (
        count_or_time_batches(pending_stream(spark, folder), size=100, wait_ms=500, shards=1)
        .writeStream.format("memory")
        .queryName("timed_batches")
        .option("checkpointLocation", ck)
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        deadline = time.monotonic() + 60
        while time.monotonic() < deadline and not spark.table("timed_batches").count():
            time.sleep(0.5)
        got = spark.table("timed_batches").collect()
        assert [(r["reason"], sorted(r["ids"])) for r in got] == [("time", list("01234"))]
    finally:
        query.stop()
