"""Finding a website for a title through an ordered chain of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from titlemill.functions.slug import slug_candidates, url_in_title
from titlemill.functions.text import nz, spread_nulls, strip_slashes
from titlemill.operators.lookup import lookup
from titlemill.sources.snapshots import (
    LANGUAGES,
    Snapshots,
    best_hits,
    entity_claims,
    first_links,
    live,
    reachable_urls,
    wiki_page_links,
    wiki_page_texts,
)

def _nothing(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def distinct_titles(items: DataFrame) -> DataFrame:
    """name, copies: discovery depends on the title alone, so each title is looked up once.

    The count is combined before the shuffle, so a title held by many items costs one row per
    task there.
    """
    return items.groupBy(F.col("title").alias("name")).agg(F.count("*").alias("copies"))


def first_reachable(rows: DataFrame, key: str, candidates: Column, url_status: DataFrame) -> DataFrame:
    """key, url: the first reachable candidate of each row; rows without one are absent."""
    tried = rows.select(key, F.posexplode(candidates).alias("position", "url"))
    # a semi join needs no distinct side
    known = url_status.where(live()).select(strip_slashes(F.col("url")).alias("live_url"))
    return (
        lookup(tried, known, [(strip_slashes(F.col("url")), "live_url")], "left_semi")
        .groupBy(key)
        .agg(F.min_by("url", "position").alias("url"))
    )


def wiki_best(snapshots: Snapshots) -> DataFrame:
    """name, lang, hit_title, qid, fullurl, website, founding_year of the first language with a page.

    Narrow columns only: page texts and entity documents stay behind.
    """
    hits = best_hits(snapshots.wiki_hits)
    tries = hits.select(
        F.col("query").alias("name"),
        F.inline(
            F.filter(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("turn"),
                            F.lit(lang).alias("lang"),
                            F.col(lang).alias("hit_title"),
                        )
                        for i, lang in enumerate(LANGUAGES)
                    ]
                ),
                lambda t: nz(t["hit_title"]).isNotNull(),
            )
        ),
    )
    links = wiki_page_links(snapshots.wiki_pages).select(
        F.col("lang").alias("page_lang"), F.col("hit_title").alias("page_title"), "qid", "fullurl"
    )
    same = [(F.col("lang"), "page_lang"), (F.col("hit_title"), "page_title")]
    pages = lookup(tries, links, same, "inner")
    columns = ["lang", "hit_title", "qid", "fullurl"]
    first = (
        pages.groupBy("name")
        .agg(F.min_by(F.struct(*columns), "turn").alias("page"))
        .select("name", "page.*")
    )
    if snapshots.wd_entities is None:
        return first.select(
            "*", _nothing("website"), _nothing("founding_year")
        )
    claims = entity_claims(snapshots.wd_entities).withColumnRenamed("qid", "entity")
    key = spread_nulls(nz(F.col("qid")), F.col("name"))
    return lookup(first, claims, [(key, "entity")]).drop("entity")


def _candidates(website: Column, found: Column) -> Column:
    """What is still worth probing: nothing once an official website is known, the address in the
    title otherwise, and guessed addresses only where no other source has a link."""
    entry = "array<struct<position:int,url:string>>"
    none = F.array().cast(entry)
    spelled = url_in_title(F.col("name"))
    guessed = F.transform(
        slug_candidates(F.col("name")),
        lambda u, i: F.struct((i + 1).cast("int").alias("position"), u.alias("url")),
    )
    return F.when(website.isNotNull(), none).otherwise(
        F.concat(
            F.when(
                spelled.isNotNull(),
                F.array(F.struct(F.lit(0).alias("position"), spelled.alias("url"))),
            ).otherwise(none),
            F.when(found.isNull(), guessed.cast(entry)).otherwise(none),
        )
    )


def discover(names: DataFrame, snapshots: Snapshots) -> DataFrame:
    """name, url, extract, qid, source, extra for each row of `names` (one row per name).

    Order of precedence: official website, address in the title, encyclopedia page, the two search
    engines, guessed address. The chain moves narrow rows; page texts join last, by page.
    """
    rows = names
    if snapshots.wiki_hits is not None and snapshots.wiki_pages is not None:
        rows = rows.join(wiki_best(snapshots), "name", "left")
    else:
        missing = ["lang", "hit_title", "qid", "fullurl", "website", "founding_year"]
        rows = rows.select("*", *[_nothing(c) for c in missing])
    if snapshots.search_results is not None:
        links = first_links(snapshots.search_results).withColumnRenamed("query", "name")
        rows = rows.join(links, "name", "left")
    else:
        rows = rows.select("*", _nothing("google"), _nothing("serp"))

    if snapshots.url_status is not None:
        rows = _probe(rows, snapshots.url_status)
    else:
        rows = rows.select("*", _nothing("spelled"), _nothing("guessed"))

    official = F.col("website").isNotNull()
    # A website of slashes only strips to nothing: later sources then apply.
    site = F.when(official, nz(strip_slashes(F.col("website"))))
    own = F.when(official, site).otherwise(F.coalesce("spelled", nz(F.col("fullurl"))))
    source = (
        F.when(
            own.isNotNull(),
            F.when(official, F.lit("wikidata"))
            .when(F.col("spelled").isNotNull(), F.lit("tld_in_name"))
            .otherwise(F.concat(F.lit("wikipedia_"), F.col("lang"))),
        )
        .when(F.col("google").isNotNull(), F.lit("google"))
        .when(F.col("serp").isNotNull(), F.lit("serp"))
        .when(F.col("guessed").isNotNull(), F.lit("slug"))
        .otherwise(F.when(official, F.lit("wikidata")).otherwise(F.lit("none")))
    )
    year = F.when(official, F.col("founding_year"))
    resolved = rows.select(
        *names.columns,
        F.coalesce(own, "google", "serp", "guessed", F.when(official, F.lit(""))).alias("url"),
        "qid",
        source.alias("source"),
        F.when(year.isNotNull(), F.create_map(F.lit("founding_year"), year))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("extra"),
        "lang",
        "hit_title",
    )
    return _with_extract(resolved, snapshots.wiki_pages).select(
        *names.columns, "url", "extract", "qid", "source", "extra"
    )


def _probe(rows: DataFrame, url_status: DataFrame) -> DataFrame:
    """Add spelled and guessed: the reachable address in the title, the first reachable guess."""
    own = F.when(F.col("website").isNull(), nz(F.col("fullurl")))
    found = F.coalesce(own, F.col("google"), F.col("serp"))
    official = nz(strip_slashes(F.col("website")))
    tried = rows.select(
        "*", F.inline_outer(_candidates(official, found)).alias("position", "try_url")
    )
    # an address answers alike with and without a slash at its end
    known = reachable_urls(url_status).select(strip_slashes(F.col("url")).alias("live_url")).distinct()
    key = spread_nulls(strip_slashes(F.col("try_url")), F.col("name"))
    answered = lookup(tried, known, [(key, "live_url")])
    live = F.when(F.col("live_url").isNotNull(), F.struct("position", "try_url"))
    return (
        answered.groupBy(*rows.columns)
        .agg(
            F.max(F.when(live["position"] == 0, live["try_url"])).alias("spelled"),
            F.min(F.when(live["position"] > 0, live)).alias("guess"),
        )
        .select("*", F.col("guess.try_url").alias("guessed"))
        .drop("guess")
    )


def _with_extract(resolved: DataFrame, wiki_pages: DataFrame | None) -> DataFrame:
    if wiki_pages is None:
        return resolved.select("*", _nothing("extract"))
    texts = wiki_page_texts(wiki_pages).select(
        F.col("lang").alias("text_lang"), F.col("hit_title").alias("text_title"), "extract"
    )
    # Titles without a page carry a key that matches nothing and spreads evenly.
    key = spread_nulls(F.col("hit_title"), F.col("name"))
    lang = F.coalesce("lang", F.lit(""))
    return lookup(resolved, texts, [(key, "text_title"), (lang, "text_lang")])
