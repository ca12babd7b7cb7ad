"""Item and snapshot tables derived from the driver's tables.

Every rule has a twin in `oracles.py`. All of them cover whole tables and whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from titlemill.functions.slug import compact_candidates, slug_candidates, url_in_title
from titlemill.sources.files import read_table
from titlemill.sources.snapshots import Snapshots

LATIN = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "абцдефгхіжклмнопщрстуваєиз"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _words(text: Column, start: int, count: int) -> Column:
    """`count` words from word `start` on; the text behind them is not split."""
    return F.slice(F.split(text, " ", start + count), start, count)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items: English ones wait for a description, Spanish ones have an empty one."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.array_join(_words(text, 1, 4), " ").alias("title"),
        F.when(F.col("lang") == "en", F.lit(None).cast("string"))
        .when(F.col("lang") == "es", "")
        .otherwise(text)
        .alias("description"),
        F.when(F.col("lang") == "de", "Technology").otherwise("Cooking").alias("category"),
        _words(text, 5, 4).alias("tags"),
        F.struct(_words(text, 9, 2).alias("interests")).alias("audience"),
        F.struct(
            _words(text, 11, 3).alias("geographic_coverage"),
            F.when(F.col("lang") == "fr", _words(text, 14, 2)).alias("content_topics"),
        ).alias("metrics"),
        F.col("source").alias("format_type"),
        F.col("lang").alias("language"),
        F.expr("timestampadd(MINUTE, cast(floor(doc_id / 10) as int), timestamp_ntz'2024-01-01')").alias(
            "created_at"
        ),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with titles of four shapes: plain, Cyrillic, and two that spell an address."""
    text = F.col("text")
    plain = F.array_join(_words(text, 1, 4), " ")
    shape = F.col("n_chars") % 4
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(shape == 0, plain)
        .when(shape == 1, F.translate(F.lower(plain), LATIN, CYRILLIC))
        .when(shape == 2, F.concat(F.get(_words(text, 1, 1), F.lit(0)), F.lit(".in.ua")))
        .otherwise(F.concat(F.lit("The "), F.array_join(_words(text, 1, 2), " "), F.lit(".com")))
        .alias("title"),
        "text",
        "lang",
        "doc_id",
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outlets(spark, sf_dir).groupBy(F.col("title").alias("name")).agg(
        F.count("*").alias("copies")
    )


def url_status(names: DataFrame) -> DataFrame:
    name = F.col("name")
    urls = F.concat(
        slug_candidates(name), compact_candidates(name), F.array_compact(F.array(url_in_title(name)))
    )
    status = F.when(F.length("url") % 3 == 0, 200).otherwise(404)
    return names.select(F.explode(urls).alias("url")).distinct().select("url", status.alias("status"))


def wiki_hits(names: DataFrame) -> DataFrame:
    size = F.length("name")
    langs = F.filter(
        F.array(
            F.when((size % 4).isin(0, 1), F.lit("uk")), F.when((size % 4).isin(1, 2), F.lit("en"))
        ),
        lambda lang: lang.isNotNull(),
    )
    rank = F.col("rank")
    title = F.when(
        (size + rank) % 3 == 0, F.concat_ws(" ", F.lit("The"), "name", rank.cast("string"))
    ).otherwise(F.concat_ws(" ", F.get(F.split("name", " "), F.lit(0)), rank.cast("string")))
    return (
        names.select("name", F.explode(langs).alias("lang"))
        .select("name", "lang", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("rank"))
        .select("lang", F.col("name").alias("query"), "rank", title.alias("title"))
    )


def wiki_pages(hits: DataFrame) -> DataFrame:
    size = F.length("title")
    return hits.select("lang", "title").distinct().select(
        "lang",
        "title",
        F.when(size % 6 == 0, -1).otherwise(size).cast("bigint").alias("page_id"),
        F.when(size % 5 == 0, "")
        .otherwise(F.concat(F.lit("  "), F.repeat(F.concat("title", F.lit(" — ")), F.lit(120))))
        .alias("extract"),
        F.when(size % 4 != 0, F.concat(F.lit("Q"), size.cast("string"))).alias("qid"),
        F.concat(
            F.lit("https://"), "lang", F.lit(".wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_"))
        ).alias("fullurl"),
    )


def wd_entities(pages: DataFrame) -> DataFrame:
    def claim(code: str, kind: str, value: Column) -> Column:
        head = f'"{code}":[{{"mainsnak":{{"datavalue":{{"type":"{kind}","value":'
        return F.concat(F.lit(head), value, F.lit("}}}]"))

    number = F.substr("qid", F.lit(2)).cast("int")
    site = F.concat(F.lit('"https://site'), number.cast("string"), F.lit('.example/"'))
    born = F.concat(
        F.lit('{"time":"+'), (number + 1900).cast("string"), F.lit('-01-01T00:00:00Z"}')
    )
    old = F.concat(F.lit('{"time":"-'), (number + 1000).cast("string"), F.lit('-01-01T00:00:00Z"}'))
    claims = (
        F.when(
            number % 4 == 1,
            F.concat(claim("P856", "string", site), F.lit(","), claim("P571", "time", born)),
        )
        .when(number % 4 == 2, claim("P856", "wikibase-entityid", site))
        .otherwise(claim("P571", "time", old))
    )
    return (
        pages.where(F.col("qid").isNotNull())
        .select("qid")
        .distinct()
        .select("qid", F.concat(F.lit('{"claims":{'), claims, F.lit("}}")).alias("json"))
    )


def search_results(names: DataFrame) -> DataFrame:
    size = F.length("name")
    engines = F.filter(
        F.array(
            F.when(size % 3 == 0, F.lit("google")), F.when((size % 5).isin(0, 1), F.lit("serp"))
        ),
        lambda e: e.isNotNull(),
    )
    return (
        names.select("name", F.explode(engines).alias("engine"))
        .select("name", "engine", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("rank"))
        .select(
            "engine",
            F.col("name").alias("query"),
            "rank",
            F.concat_ws(
                "", F.lit("https://"), "engine", F.lit(".example/"), size.cast("string"), F.lit("/"), F.col("rank").cast("string")
            ).alias("link"),
        )
    )


def _escape(text: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _paragraphs(text: Column) -> Column:
    return F.concat(
        F.lit("<p>"), F.replace(_escape(text), F.lit("\n"), F.lit("</p>\n<p>")), F.lit("</p>")
    )


def sites(outlets: DataFrame) -> DataFrame:
    """base, title, text, lang: one document per guessed address.

    Texts are small beside the pages made of them and the work to read those, so they are dealt
    over a fixed number of partitions, which adaptive execution does not merge by size.
    """
    spark = outlets.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism
    )
    return (
        outlets.select(
            F.get(slug_candidates(F.col("title")), F.lit(1)).alias("base"),
            "doc_id",
            F.struct("title", "text", "lang").alias("doc"),
        )
        .where(F.col("base").isNotNull())
        .groupBy("base")
        .agg(F.min_by("doc", "doc_id").alias("doc"))
        .select("base", "doc.*")
        .repartition(parts, F.xxhash64("base"))  # not by "base": dealt so already, and then merged
    )


def home_page() -> Column:
    """Home page of a site. French ones carry linked data, Spanish ones a description."""
    markup = F.concat(
        F.lit('<script type="application/ld+json">'),
        F.to_json(
            F.struct(
                F.lit("NewsMediaOrganization").alias("@type"),
                F.concat("title", F.lit(" media")).alias("name"),
                F.concat(F.lit("Says "), "title").alias("description"),
            )
        ),
        F.lit("</script>"),
    )
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"),
        _escape(F.col("title")),
        F.lit("</title>"),
        F.when(F.col("lang") == "fr", markup).otherwise(""),
        F.when(
            F.col("lang") == "es",
            F.concat(
                F.lit('<meta property="og:description" content="About '),
                _escape(F.col("title")),
                F.lit('">'),
            ),
        ).otherwise(""),
        F.lit("</head><body><nav><p>menu</p></nav><div class=\"page content\">"),
        _paragraphs(F.col("text")),
        F.lit("</div></body></html>"),
    )


def about_page() -> Column:
    text = F.concat("title", F.lit("\n"), "text", F.lit("\n"), "text")
    return F.concat(F.lit("<html><body>"), _paragraphs(text), F.lit("</body></html>"))


def feed_page() -> Column:
    categories = F.transform(
        F.split("text", " "),
        lambda w: F.concat(F.lit("<item><category>"), _escape(F.regexp_replace(w, "[^a-zA-Z]", "")), F.lit("</category></item>")),
    )
    return F.concat(
        F.lit('<?xml version="1.0"?><rss><channel>'),
        F.array_join(categories, ""),
        F.lit("</channel></rss>"),
    )


def page_snapshot(sites: DataFrame) -> DataFrame:
    """Home pages, about pages of English sites, feeds of German and English ones."""
    lang = F.col("lang")
    rows = F.array(
        F.struct(F.lit("").alias("path"), F.lit(200).alias("status"), home_page().alias("body")),
        F.struct(
            F.when(lang == "en", "/about-us").alias("path"),
            F.when(F.length("base") % 2 == 0, 200).otherwise(500).alias("status"),
            about_page().alias("body"),
        ),
        F.struct(
            F.when(lang.isin("de", "en"), "/rss").alias("path"),
            F.lit(200).alias("status"),
            F.when(lang.isin("de", "en"), feed_page()).alias("body"),
        ),
        F.struct(
            F.when(lang == "de", "/feed.xml").alias("path"),
            F.lit(200).alias("status"),
            F.lit("<html>no feed</html>").alias("body"),
        ),
    )
    return (
        sites.select("base", F.inline(rows))
        .where(F.col("path").isNotNull())
        .select(F.concat("base", "path").alias("url"), "status", "body")
    )


def snapshots(spark: SparkSession, sf_dir: str) -> Snapshots:
    titles = names(spark, sf_dir)
    hits = wiki_hits(titles)
    pages = wiki_pages(hits)
    return Snapshots(
        url_status=url_status(titles),
        wiki_hits=hits,
        wiki_pages=pages,
        wd_entities=wd_entities(pages),
        search_results=search_results(titles),
        page_snapshot=page_snapshot(sites(outlets(spark, sf_dir))),
    )


def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per document: valid ones, and by language and length the ways to go wrong."""
    text = F.col("text")
    size = F.col("n_chars")
    fields = F.struct(
        F.when(size % 7 != 0, text).alias("description"),
        F.when(F.col("lang") == "en", "Science").otherwise(F.col("lang")).alias("category"),
        F.when(size % 5 != 0, F.split(text, " ")).alias("tags"),
        F.when(
            F.col("lang") == "fr",
            F.struct(
                F.lit("18-35").alias("age_range"),
                _words(text, 1, 3).alias("interests"),
                F.struct(F.col("lang").alias("primary_language")).alias("demographics"),
            ),
        ).alias("audience"),
        F.when(
            size % 3 != 0,
            F.struct(
                F.when(size % 2 == 0, _words(text, 1, 2)).alias("geographic_coverage"),
                F.when(size % 4 == 0, "weekly").otherwise("hourly").alias("publishing_frequency"),
                F.when(size % 4 == 1, "strong").alias("social_media_presence"),
                F.lit("A").alias("reach_tier"),
                F.col("source").alias("custom"),
            ),
        ).alias("metrics"),
    )
    whole = F.to_json(fields)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(size % 11 == 0, F.concat(F.lit("{"), whole)).otherwise(whole).alias("reply"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log: errors failed, everything else succeeded with its type as source."""
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("title"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        F.when(failed, "").otherwise("News").alias("category"),
        F.when(failed, "").otherwise("?").alias("tier"),
        F.col("event_type").alias("source"),
        F.floor(F.col("value") * 10).cast("int").alias("context_chars"),
        F.when(failed, F.concat(F.repeat(F.col("props"), F.lit(12)), F.lit(" failed")))
        .otherwise("")
        .alias("error"),
        F.when(failed, 3).otherwise(1).alias("attempts"),
    )


def pending_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of events as queued ids: many repeats, and ids no item has."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("ts").cast("timestamp").alias("enqueued_at"),
        F.lit(0).alias("attempts"),
    )
