import json

import pytest
from pyspark.sql import functions as F

from titlemill.plans.enrich import enrich, run
from titlemill.schema import MEDIA_ITEM
from titlemill.sources.snapshots import Snapshots

NOW = "2024-06-01 00:00:00"


def make_items(spark):
    rows = [("1", "Alpha"), ("2", "Alpha"), ("3", "Bad"), ("4", "Done"), ("5", "Beta")]
    known = ("id", "title", "description", "created_at")
    return spark.createDataFrame(rows, "id string, title string").select(
        "id",
        "title",
        F.when(F.col("title") == "Done", "kept").alias("description"),
        F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id as int))").alias("created_at"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in MEDIA_ITEM if f.name not in known],
    )


def snapshots(spark):
    return Snapshots(
        url_status=spark.createDataFrame([("https://beta.ua", 200)], "url string, status int"),
        page_snapshot=spark.createDataFrame(
            [("https://beta.ua", 200, f"<p>{'Beta writes about music. ' * 30}</p>")],
            "url string, status int, body string",
        ),
    )


def models():
    def chat(talks):
        def answer(talk):
            assert talk[0] == {"role": "system", "content": "rules"}
            if "Bad" in talk[1]["content"]:
                return "no"
            return json.dumps({"description": talk[1]["content"], "metrics": {"geographic_coverage": ["Kyiv"]}})

        return [answer(t) for t in talks]

    def embedder(texts):
        return [[float(len(t))] for t in texts]

    return chat, embedder


def test_run(spark, tmp_path):
    chat, embedder = models()
    folder = str(tmp_path / "run")
    items = make_items(spark)
    final = run(items, snapshots(spark), "rules", chat, embedder, NOW, folder, dimension=1)
    got = {r["id"]: r for r in final.collect()}
    assert len(got) == 5
    assert got["1"]["description"] == got["2"]["description"] == "Outlet name: Alpha"
    assert got["3"]["description"] is None and got["3"]["embedding"] is None
    assert got["4"]["description"] == "kept" and got["4"]["updated_at"] is None
    assert got["4"]["embedding"] is None
    assert got["5"]["description"].startswith("Outlet name: Beta\nContent: Beta writes")
    assert got["5"]["metrics"]["geographic_coverage"] == ["Kyiv"]
    assert got["5"]["updated_at"] is not None and len(got["5"]["embedding"]) == 1

    log = {r["id"]: r for r in spark.read.parquet(f"{folder}/log").collect()}
    assert sorted(log) == ["1", "2", "3", "5"]
    assert (log["5"]["status"], log["5"]["source"], log["5"]["tier"]) == ("ok", "slug", "Kyiv")
    assert (log["3"]["status"], log["3"]["attempts"]) == ("failed", 3)
    assert [r["id"] for r in spark.read.parquet(f"{folder}/quarantine").collect()] == ["3"]
    totals = spark.read.parquet(f"{folder}/report/totals").first()
    assert (totals["processed"], totals["ok"], totals["failed"]) == (4, 3, 1)
    assert spark.read.parquet(f"{folder}/report/embeddings").first()["written"] == 3


def test_limit_and_single_item(spark):
    chat, _ = models()
    items = make_items(spark)
    limited = enrich(items, Snapshots(), "rules", chat, NOW, limit=1)
    assert [r["id"] for r in limited.log.collect()] == ["1"]
    single = enrich(
        items, Snapshots(), "rules", chat, NOW, only=items.where("id = '4'").select("id", "title")
    )
    again = {r["id"]: r["description"] for r in single.items.collect()}
    assert again["4"] == "Outlet name: Done" and again["1"] is None


def test_items_without_a_title_are_reported(spark):
    chat, _ = models()
    items = make_items(spark).withColumn("title", F.when(F.col("id") != "5", F.col("title")))
    result = enrich(items, snapshots(spark), "rules", chat, NOW)
    log = {r["id"]: r for r in result.log.collect()}
    assert set(log) == {"1", "2", "3", "5"}
    assert log["5"]["status"] == "failed" and log["5"]["error"] == "the title is missing"
    assert "5" in {r["id"] for r in result.quarantine.collect()}
    assert result.items.count() == 5


def test_model_calls_are_dealt_over_partitions(spark):
    from titlemill.plans.enrich import structured

    seen = spark.sparkContext.accumulator(0)

    def chat(talks):
        seen.add(1)
        return [json.dumps({"description": "x"}) for _ in talks]

    texts = spark.range(200).select(F.col("id").cast("string").alias("name"), F.lit("c").alias("context"))
    made = structured(texts, "rules", chat, batch_size=1000, concurrency=7)
    assert made.count() == 200 and seen.value == 7


class Lost(BaseException):
    """Stands for a driver lost after the model: no handler of the job catches it."""


def test_run_started_again_pays_for_no_reply_twice(spark, tmp_path):
    chat, embedder = models()
    calls = spark.sparkContext.accumulator(0)

    def counted(talks):
        calls.add(len(talks))
        return chat(talks)

    def lost(texts):
        raise Lost()

    folder = str(tmp_path / "run")
    items = make_items(spark)
    with pytest.raises(Exception):
        run(items, snapshots(spark), "rules", counted, lost, NOW, folder, dimension=1)
    paid = calls.value
    assert paid >= 3  # Alpha, Beta and three tries of Bad
    final = run(items, snapshots(spark), "rules", counted, embedder, NOW, folder, dimension=1)
    assert calls.value == paid  # the second run found every reply in the store
    fresh = run(items, snapshots(spark), "rules", chat, embedder, NOW, str(tmp_path / "fresh"), dimension=1)
    strip = lambda rows: sorted((r["id"], r["description"], r["embedding"]) for r in rows)
    assert strip(final.collect()) == strip(fresh.collect())


def test_reply_store_keys_by_conversation_and_attempt(spark, tmp_path):
    from titlemill.operators.replies import ReplyStore

    calls = spark.sparkContext.accumulator(0)

    def echo(talks):
        calls.add(len(talks))
        return [t[-1]["content"].upper() for t in talks]

    store = ReplyStore(str(tmp_path))
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), (None, "z")], "name string, context string")
    talk = F.array(F.struct(F.lit("user").alias("role"), F.col("context").alias("content")))
    first = {r["name"]: r["reply"] for r in store.ask(rows, "name", talk, echo, 1, 2).collect()}
    assert first == {"a": "X", "b": "X", "c": "Y", None: "Z"} and calls.value == 3  # equal conversations asked once
    again = {r["name"]: r["reply"] for r in store.ask(rows, "name", talk, echo, 1, 2).collect()}
    assert again == first and calls.value == 3
    store.ask(rows.where("name = 'c'"), "name", talk, echo, 2, 2).collect()
    assert calls.value == 4  # a later attempt is a new call
