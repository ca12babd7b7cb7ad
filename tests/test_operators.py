import pytest
from pyspark.sql import functions as F

from titlemill.operators import attempts, discovery, lookup, merge, model, numbering, runlog
from titlemill.operators import pages as page_operators
from titlemill.operators.pages import site_signals, wanted_pages, with_context
from titlemill.sources import items as item_source
from titlemill.sources.snapshots import Snapshots, best_hits, wiki_page_links

PAGES = "lang string, title string, page_id bigint, extract string, qid string, fullurl string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def entity(site, year):
    claims = []
    if site:
        claims.append('"P856":[{"mainsnak":{"datavalue":{"type":"string","value":"%s"}}}]' % site)
    if year:
        claims.append(
            '"P571":[{"mainsnak":{"datavalue":{"type":"time","value":{"time":"+%s-01-01"}}}}]' % year
        )
    return '{"claims":{%s}}' % ",".join(claims)


@pytest.fixture(scope="module")
def snapshots(spark):
    hits = [
        ("uk", "Alpha", 1, "Other"), ("uk", "Alpha", 2, "The ALPHA paper"),
        ("uk", "Beta", 1, "Gone"), ("en", "Beta", 1, "Beta"),
        ("en", "Gamma.com", 1, "Gamma"),
        ("uk", "Delta", 1, "Delta"), ("en", "Delta", 1, "Delta en"),
        ("uk", "Slashes", 1, "Slashes"),
        ("uk", "Far", 6, "Far"),
        ("uk", "Empty", 1, "Empty"),
    ]
    pages = [
        ("uk", "The ALPHA paper", 1, " alpha text ", "Q1", "https://uk.w/alpha"),
        ("uk", "Gone", -1, None, None, None),
        ("en", "Beta", 2, "old", "Q9", "https://en.w/old"),
        ("en", "Beta", 3, "beta text", "Q2", "https://en.w/beta"),
        ("en", "Gamma", 4, "g", "Q3", "https://en.w/gamma"),
        ("uk", "Delta", 5, "", None, None),
        ("en", "Delta en", 6, "never used", "Q1", "https://en.w/delta"),
        ("uk", "Slashes", 7, "s", "Q4", "https://uk.w/slashes"),
        ("uk", "Far", 8, "far", "Q1", "https://uk.w/far"),
        ("uk", "Empty", 9, None, "", "https://uk.w/empty"),
    ]
    entities = [
        ("Q1", entity("https://alpha.ua//", 1999)),
        ("Q2", entity(None, 1990)),
        ("Q3", entity(None, None)),
        ("Q4", entity("//", 1980)),
    ]
    search = [
        ("google", "Delta", 2, "https://g/2"), ("google", "Delta", 1, "https://g/1"),
        ("serp", "Delta", 1, "https://s/1"), ("serp", "Far", 1, "https://s/far"),
        ("google", "Blank", 1, ""), ("serp", "Blank", 1, "https://s/blank"),
        ("serp", "Slashes", 1, "https://s/slashes"),
    ]
    status = [
        ("https://gamma.com", 200), ("https://epsilon.ua", 404), ("https://epsilon.com", 301),
        ("https://epsilon.net", 200), ("https://alpha.com.ua", 200),
    ]
    return Snapshots(
        url_status=spark.createDataFrame(status, "url string, status int"),
        wiki_hits=spark.createDataFrame(hits, "lang string, query string, rank int, title string"),
        wiki_pages=spark.createDataFrame(pages, PAGES),
        wd_entities=spark.createDataFrame(entities, "qid string, json string"),
        search_results=spark.createDataFrame(
            search, "engine string, query string, rank int, link string"
        ),
    )


EXPECTED = {
    "Alpha": ("https://alpha.ua", "wikidata", "alpha text", "Q1", {"founding_year": "1999"}),
    "Beta": ("https://en.w/beta", "wikipedia_en", "beta text", "Q2", {}),
    "Gamma.com": ("https://Gamma.com".lower(), "tld_in_name", "g", "Q3", {}),
    "Delta": ("https://g/1", "google", "", None, {}),
    "Slashes": ("https://s/slashes", "serp", "s", "Q4", {"founding_year": "1980"}),
    "Far": ("https://s/far", "serp", None, None, {}),
    "Blank": ("https://s/blank", "serp", None, None, {}),
    "Epsilon": ("https://epsilon.com", "slug", None, None, {}),
    "Nothing here": (None, "none", None, None, {}),
    "Empty": ("https://uk.w/empty", "wikipedia_uk", "", "", {}),
}


def test_discover(spark, snapshots):
    names = spark.createDataFrame([(n,) for n in EXPECTED], "name string")
    got = {
        r["name"]: (r["url"], r["source"], r["extract"], r["qid"], r["extra"])
        for r in discovery.discover(names, snapshots).collect()
    }
    assert got == EXPECTED


def test_discover_without_snapshots(spark):
    names = spark.createDataFrame([("Alpha.com",)], "name string")
    got = discovery.discover(names, Snapshots()).collect()
    assert [(r["url"], r["source"], r["extract"]) for r in got] == [(None, "none", None)]
    assert with_context(discovery.discover(names, Snapshots()), None).first()["context"] == (
        "Outlet name: Alpha.com"
    )


def test_best_hits_and_links(snapshots):
    assert ("Alpha", "The ALPHA paper", None) in rows(best_hits(snapshots.wiki_hits), "query", "uk", "en")
    assert ("Beta", "Q2") in rows(wiki_page_links(snapshots.wiki_pages), "hit_title", "qid")


def test_hot_keys_of_a_lookup_are_split(spark):
    """One address holds most rows: the final plan must deal it over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60_000, 1, 8).select(
            F.col("id"),
            F.when(F.col("id") % 3 != 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
            F.sha2(F.col("id").cast("string"), 256).alias("ballast"),
        )
        table = (
            left.select(F.col("key").alias("k"))
            .groupBy("k")
            .agg(F.count("*").alias("n"))
        )
        joined = lookup.lookup(left, table, [(F.col("key"), "k")]).agg(
            F.sum("n").alias("s"), F.min("ballast").alias("b")
        )
        total = joined.collect()[0]["s"]
        assert total == 40_000 * 40_000 + 20_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salted_lookup_keeps_every_row(spark):
    left = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("name")
    )
    table = left.groupBy("name").agg(F.count("*").alias("n")).withColumn("v", F.length("name"))
    joined = lookup.salted_lookup(left, table, "name", "n", "id")
    assert joined.count() == 5000
    assert joined.select("id").distinct().count() == 5000
    assert joined.where(F.length("name") != F.col("v")).count() == 0


def test_numbering(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"), F.lit(1).alias("t"))
    got = numbering.with_batch(df, ["t", "k"], 100, "batch")
    assert got.columns == ["k", "t", "batch"]
    assert got.where(F.col("batch") != F.floor(F.col("k") / 100)).count() == 0
    assert numbering.with_index(df, ["k"], "i").where(F.col("i") != F.col("k")).count() == 0


def test_limit_takes_the_oldest(spark):
    items = spark.range(500).select(
        F.col("id").cast("string").alias("id"),
        F.col("id").cast("string").alias("title"),
        F.when(F.col("id") % 5 == 0, "x").alias("description"),
        F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, cast(id / 50 as int))").alias("created_at"),
    )
    todo = items.where("description is null").orderBy("created_at", "id").limit(77)
    assert rows(item_source.scan_unenriched(items, 77), "id") == rows(todo.select("id", "title"), "id")
    assert item_source.scan_unenriched(items, 0).count() == 400
    assert item_source.dispatch_estimate(items, 77).first()["queued"] == 77
    assert item_source.dispatch_estimate(items).first()["queued"] == 400


def test_merge(spark):
    items = spark.createDataFrame(
        [("1", "a", "old", None), ("2", "b", "old", None), ("3", "c", None, None)],
        "id string, title string, description string, updated_at timestamp",
    )
    updates = spark.createDataFrame(
        [("1", 1, "first"), ("1", 2, None), ("3", 1, "new"), ("9", 1, "unknown")],
        "id string, seq int, description string",
    )
    merged = merge.merge_items(items, updates, "2024-06-01 00:00:00")
    assert merged.columns == items.columns
    got = rows(merged, "id", "description", F.col("updated_at").isNotNull())
    assert got == [("1", None, True), ("2", "old", False), ("3", "new", True)]


def test_merge_against_a_bucketed_table_shuffles_updates_only(spark):
    items = spark.range(100).select(
        F.col("id").cast("string").alias("id"), F.lit("d").alias("description")
    )
    item_source.write_bucketed(items, "bucketed_items", 4)
    updates = items.where(F.col("id") < "3").select("id", F.lit(1).alias("seq"), F.lit("n").alias("description"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.merge_items(spark.table("bucketed_items"), updates, "2024-06-01 00:00:00")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        left = plan.split("SortMergeJoin")[1].split("SortAggregate")[0]
        assert "Exchange" not in left.split("FileScan")[0]
        assert merged.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unwritten_keeps_single_misses(spark):
    asked = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "id string")
    written = spark.createDataFrame([("2",)], "id string")
    assert rows(merge.unwritten(asked, written), "id") == [("1",), ("3",)]


def test_structure_isolates_bad_conversations(spark):
    calls = spark.sparkContext.accumulator(0)

    def chat(talks):
        calls.add(1)
        if any("bad" in t[-1]["content"] for t in talks):
            raise RuntimeError("refused")
        return [t[-1]["content"].upper() for t in talks]

    df = spark.createDataFrame([(i, "bad" if i == 5 else f"t{i}") for i in range(10)], "i int, c string")
    talk = F.array(F.struct(F.lit("user").alias("role"), F.col("c").alias("content")))
    got = rows(model.structure(df.coalesce(1), "i", talk, chat, 5), "i", "reply", "error")
    assert got[5] == (5, None, "refused")
    assert got[4] == (4, "T4", None) and got[9] == (9, "T9", None)
    assert calls.value == 2 + 5


def test_embed_checks_count_and_dimension(spark):
    def embedder(texts):
        if len(texts) > 1 and "drop" in texts:
            return [[1.0, 2.0]] * (len(texts) - 1)
        return [[float(len(t)), 0.0] if t != "thin" else [1.0] for t in texts]

    df = spark.createDataFrame([("a", "aa"), ("b", "thin"), ("c", "drop"), ("d", "dddd")], "id string, t string")
    made = df.coalesce(1).select("id", model.embed(embedder, 100, 2)(F.col("t")).alias("v"))
    got = rows(made, "id", "v.embedding", "v.error")
    assert got == [
        ("a", [2.0, 0.0], None), ("b", None, "dimension 1, not 2"), ("c", [4.0, 0.0], None), ("d", [4.0, 0.0], None),
    ]


def test_attempts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 9)], "k string, needed int")

    def step(todo, attempt):
        return todo.select("k", F.when(F.col("needed") > attempt, F.lit(f"try {attempt}")).alias("error"))

    got = rows(attempts.run_with_attempts(df, "k", step), "k", "error", "attempts")
    assert got == [("a", None, 1), ("b", None, 2), ("c", "try 3", 3)]


def test_run_log(spark, tmp_path):
    log = spark.createDataFrame(
        [("1", "ok", "slug", 10, ""), ("2", "ok", "slug", 30, ""), ("3", "ok", "google", 20, ""), ("4", "failed", "slug", 5, "e" * 100)],
        "id string, status string, source string, context_chars int, error string",
    ).select("*", *[F.lit("x").alias(c) for c in ("title", "category", "tier")], F.lit(1).alias("attempts"))
    assert runlog.totals(log).first()[:] == (4, 3, 1, 10, 30, 60)
    assert [tuple(r) for r in runlog.source_distribution(log).collect()] == [("slug", 2), ("google", 1)]
    assert runlog.failure_list(log).first()["error"] == "e" * 80
    runlog.write_report(log, None, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "succeeded")).count() == 3


def test_site_signals(spark):
    long = "This sentence is long enough to be kept as a paragraph."
    feed = "<?xml version='1.0'?><rss><item><category>c</category></item></rss>"
    page = lambda *ps: "<html><title>t</title><body>" + "".join(f"<p>{p}</p>" for p in ps)
    snapshot = spark.createDataFrame(
        [
            ("https://a.ua", 200, page(long)),
            ("https://a.ua/about", 404, page(long, long, long)),
            ("https://a.ua/pro-nas", 200, page(long, long)),
            ("https://a.ua/contacts", 200, page(long, long, long)),
            ("https://a.ua/feed", 200, ""),
            ("https://a.ua/rss", 200, feed),
            ("https://b.ua/", 200, page(long, long)),
            ("https://b.ua/about", 200, page(long)),
            ("https://b.ua/feed", 200, "<html>"),
            ("https://b.ua/rss", 200, feed),
            ("https://c.ua", 500, page(long)),
        ],
        "url string, status int, body string",
    )
    got = {r["site_url"]: (r["about_text"], r["rss_categories"]) for r in site_signals(snapshot).collect()}
    assert got["https://a.ua"] == (f"{long} {long}", ["c"])
    assert got["https://b.ua/"] == (None, None)
    assert "https://c.ua" not in got


def test_sites_are_found_with_and_without_a_slash(spark):
    long = "This sentence is long enough to be kept as a paragraph."
    page = lambda text: f"<html><title>t</title><body><p>{text}</p>"
    snapshot = spark.createDataFrame(
        [("https://t3.ua/", 200, page(long)), ("https://t3.ua//", 200, page("x" * 50)), ("https://t4.ua", 200, page("y" * 50))],
        "url string, status int, body string",
    )
    found = spark.createDataFrame(
        [("T3", "https://t3.ua", "slug"), ("T4", "https://t4.ua/", "slug"), ("T5", None, "none")],
        "name string, url string, source string",
    ).withColumn("extract", F.lit(None).cast("string"))
    signals = site_signals(snapshot)
    assert sorted(r["site_url"] for r in signals.collect()) == ["https://t3.ua/", "https://t4.ua"]
    for given in ((snapshot, None), (None, signals)):
        got = {r["name"]: r["context"] for r in with_context(found, *given).collect()}
        assert long in got["T3"] and "y" * 50 in got["T4"] and got["T5"] == "Outlet name: T5"
    status = spark.createDataFrame([("https://t3.ua/", 200)], "url string, status int")
    tried = discovery.first_reachable(found.where("name = 'T3'"), "name", F.array("url"), status)
    assert [tuple(r) for r in tried.collect()] == [("T3", "https://t3.ua")]


def test_repeated_ids_do_not_multiply(spark):
    items = spark.createDataFrame([("1", None), ("1", None), ("2", None)], "id string, embedding array<float>")
    vectors = spark.createDataFrame([("1", [1.0]), ("1", [2.0])], "id string, embedding array<float>")
    got = merge.merge_vectors(items, vectors).collect()
    assert len(got) == 3 and len({str(r["embedding"]) for r in got if r["id"] == "1"}) == 1
    updates = spark.createDataFrame(
        [("1", "a", {"k": "v"}, 1), ("1", "b", {"k": "w"}, 1)], "id string, description string, metrics_extra map<string,string>, seq int"
    )
    both = [merge.last_per_key(u, "id", "seq").first() for u in (updates, updates.orderBy(F.desc("description")))]
    assert both[0] == both[1]


def test_only_pages_that_a_name_leads_to_are_read(spark, monkeypatch):
    long = "This sentence is long enough to be kept as a paragraph."
    urls = [
        f"https://s{i}.ua{path}"
        for i in range(300)
        for path in ("", "/", "/about", "/rss", "/other", "/about/rss")
    ]
    snapshot = spark.createDataFrame([(u, 200, f"<p>{long} {u}</p>") for u in urls], "url string, status int, body string")
    bases = ["https://s7.ua", "https://s8.ua", "https://s8.ua", None, "https://none.ua"]
    sites = spark.createDataFrame([(b,) for b in bases], "base string")
    kept = {r["url"] for r in wanted_pages(snapshot, sites).collect()}
    wanted = {f"https://s{i}.ua{path}" for i in (7, 8) for path in ("", "/", "/about", "/rss")}
    assert wanted <= kept and len(kept) < len(urls) / 10
    assert wanted_pages(snapshot, sites.limit(0)).count() == 0

    read = []
    whole = page_operators.site_signals
    monkeypatch.setattr(page_operators, "site_signals", lambda pages: read.append(pages.count()) or whole(pages))
    found = spark.createDataFrame(
        [("A", "https://s7.ua/", "slug"), ("B", "https://s9.ua", "wikipedia_uk"), ("C", None, "none")],
        "name string, url string, source string",
    ).withColumn("extract", F.lit(None).cast("string"))
    got = {r["name"]: r["context"] for r in with_context(found, snapshot).collect()}
    assert read and read[0] < len(urls) / 10
    assert got == {r["name"]: r["context"] for r in with_context(found, None, whole(snapshot)).collect()}
    assert long in got["A"]
