"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from titlemill.functions import html, reply as R, slug, vectors as V
from titlemill.functions.feed import feed_categories, looks_like_feed
from titlemill.operators import attempts, discovery, merge, model, numbering, pages, runlog
from titlemill.operators.replies import ReplyStore
from titlemill.plans.enrich import contexts, enrich
from titlemill.schema import MEDIA_ITEM
from titlemill.session import durable, scratch_folder
from titlemill.sources import items as item_source, snapshots as snap
from titlemill.sources.pending import pending_stream as pending_source
from titlemill.streaming.buffer import count_or_time_batches, unbatched
from titlemill.streaming.drain import EmbeddingStore, apply_vectors, start_drain
from workloads import derive, stubs
from workloads.derive import table

Query = Callable[[SparkSession, str], DataFrame]
NOW = "2024-06-01 00:00:00"
RUN_CAP = 500


def _joined(array: Column) -> Column:
    return F.array_join(array, "|")


def _label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))


# Scans


def unenriched_scan(spark, sf_dir):
    return item_source.scan_unenriched(derive.items(spark, sf_dir))


def oldest_unenriched(spark, sf_dir):
    return item_source.scan_unenriched(derive.items(spark, sf_dir), limit=RUN_CAP)


def unenriched_count(spark, sf_dir):
    return item_source.count_unenriched(derive.items(spark, sf_dir))


def dispatch_estimate(spark, sf_dir):
    return item_source.dispatch_estimate(derive.items(spark, sf_dir), limit=RUN_CAP)


def rerun_one(spark, sf_dir):
    return item_source.single_item(derive.items(spark, sf_dir), "7")


def backlog(spark, sf_dir):
    return runlog.backlog(derive.items(spark, sf_dir), _label_ids(spark, sf_dir))


def embedding_fetch(spark, sf_dir):
    ids = _label_ids(spark, sf_dir)
    found = item_source.fetch_for_embedding(derive.items(spark, sf_dir), ids.union(ids))
    return found.select(
        "id", "title", "description", "category", _joined(F.col("tags")).alias("tags"), "format_type", "language"
    )


def embedding_text(spark, sf_dir):
    return derive.items(spark, sf_dir).select("id", V.item_embedding_text().alias("text"))


# Slugs and candidates


def _slug_inputs(spark, sf_dir) -> DataFrame:
    titles = derive.outlets(spark, sf_dir).select(F.concat(F.lit("d"), "id").alias("id"), "title")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"),
        F.replace("s_name", F.lit("#"), F.lit("_ \t")).alias("title"),
    )
    return titles.union(suppliers)


def latin_slug(spark, sf_dir):
    return _slug_inputs(spark, sf_dir).select("id", slug.latin_slug(F.col("title")).alias("slug"))


def slug_variant_b(spark, sf_dir):
    return _slug_inputs(spark, sf_dir).select("id", slug.short_slug(F.col("title")).alias("slug"))


def tld_from_name(spark, sf_dir):
    titles = derive.outlets(spark, sf_dir).select(F.concat(F.lit("d"), "id").alias("id"), "title")
    hosts = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.regexp_extract("url", "https?://([^/]*)", 1).alias("title"),
    )
    return titles.union(hosts).select("id", slug.url_in_title(F.col("title")).alias("url"))


def slug_candidates(spark, sf_dir):
    return derive.outlets(spark, sf_dir).select(
        "id", F.posexplode(slug.slug_candidates(F.col("title"))).alias("position", "url")
    )


def candidates_variant_b(spark, sf_dir):
    return derive.outlets(spark, sf_dir).select(
        "id",
        _joined(slug.compact_candidates(F.col("title"))).alias("urls"),
        slug.first_compact_candidate(F.col("title")).alias("unprobed"),
    )


# Discovery


def first_reachable(spark, sf_dir):
    names = derive.names(spark, sf_dir)
    return discovery.first_reachable(
        names, "name", slug.compact_candidates(F.col("name")), derive.url_status(names)
    )


def wiki_best_hit(spark, sf_dir):
    return snap.best_hits(derive.wiki_hits(derive.names(spark, sf_dir)))


def entity_claims(spark, sf_dir):
    hits = derive.wiki_hits(derive.names(spark, sf_dir))
    return snap.entity_claims(derive.wd_entities(derive.wiki_pages(hits)))


def encyclopedia_pages(spark, sf_dir):
    pages_table = derive.wiki_pages(derive.wiki_hits(derive.names(spark, sf_dir)))
    return snap.wiki_page_links(pages_table).join(
        snap.wiki_page_texts(pages_table), ["lang", "hit_title"]
    )


def search_links(spark, sf_dir):
    return snap.first_links(derive.search_results(derive.names(spark, sf_dir)))


def discovery_chain(spark, sf_dir):
    found = discovery.discover(derive.names(spark, sf_dir), derive.snapshots(spark, sf_dir))
    return found.select(
        "name", "copies", "url", "extract", "qid", "source", F.col("extra")["founding_year"].alias("founding_year")
    )


# Pages


def page_lookup(spark, sf_dir):
    crawl = table(spark, sf_dir, "pages")
    status = F.when(F.length("html") % 7 == 0, 404).otherwise(200)
    snapshot = crawl.select("url", status.alias("status"), F.col("html").alias("body"))
    bodies = snap.page_bodies(snapshot)
    wanted = crawl.select("page_id", "url")
    return wanted.join(bodies, "url", "left").select(
        "page_id", "url", F.md5("body").alias("body_md5"), F.length("body").alias("body_chars")
    )


def about_lookup(spark, sf_dir):
    return pages.about_pages(derive.page_snapshot(derive.sites(derive.outlets(spark, sf_dir))))


def feed_lookup(spark, sf_dir):
    found = pages.feed_pages(derive.page_snapshot(derive.sites(derive.outlets(spark, sf_dir))))
    return found.select("base", _joined(F.col("rss_categories")).alias("categories"))


def page_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.page_title(F.col("html")).alias("title"))


def page_meta(spark, sf_dir):
    page = F.col("page")
    return (
        derive.sites(derive.outlets(spark, sf_dir))
        .select("base", derive.home_page().alias("page"))
        .select("base", html.meta_content(page, "property", "og:description").alias("og_desc"))
    )


def page_body(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.body_text(F.col("html")).alias("body"))


def jsonld_block(spark, sf_dir):
    kind = F.when(F.col("s_nationkey") % 3 == 0, "NewsMediaOrganization").otherwise("Person")
    block = F.to_json(
        F.struct(
            kind.alias("@type"),
            F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("string").alias("description"),
        )
    )
    page = F.concat(
        F.lit('<html><script type="application/ld+json">{oops</script><script type="application/ld+json">'),
        F.when(F.col("s_nationkey") % 2 == 0, block).otherwise(F.concat(F.lit("["), block, F.lit("]"))),
        F.lit("</script></html>"),
    )
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", html.organisation_markup(page).alias("org"))
        .select("s_suppkey", "org.name", "org.description")
    )


def feed_categories_query(spark, sf_dir):
    text = F.col("text")
    tag = F.when(F.col("p_size") % 2 == 0, "rss").otherwise("atom")
    words = F.split("p_name", " ")
    rss = F.concat(
        F.lit("<?xml version='1.0'?><rss><channel><item>"),
        F.array_join(F.transform(words, lambda w: F.concat(F.lit("<category> "), w, F.lit(" </category>"))), ""),
        F.lit("<category>"), "p_type", F.lit("</category></item></channel>"),
        F.when(F.col("p_size") % 5 != 0, "</rss>").otherwise(""),
    )
    atom = F.concat(
        F.lit("<?xml version='1.0'?><feed xmlns='http://www.w3.org/2005/Atom'><entry><category term='"),
        "p_type", F.lit("'/></entry></feed>"),
    )
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", F.when(tag == "rss", rss).otherwise(atom).alias("text"))
        .select("p_partkey", _joined(feed_categories(F.when(looks_like_feed(text), text))).alias("categories"))
    )


def site_signals(spark, sf_dir):
    found = pages.site_signals(derive.page_snapshot(derive.sites(derive.outlets(spark, sf_dir))))
    return found.where(F.col("signals.page_title") != "").select(
        F.col("site_url").alias("url"),
        F.col("signals.name").alias("name"),
        F.col("signals.description").alias("description"),
        F.col("signals.og_desc").alias("og_desc"),
        F.col("signals.page_title").alias("page_title"),
        F.col("signals.body_text").alias("body_text"),
        "about_text",
        _joined(F.col("rss_categories")).alias("categories"),
    )


def context_route(spark, sf_dir):
    found = contexts(derive.outlets(spark, sf_dir), derive.snapshots(spark, sf_dir))
    return found.select("name", "source", "context")


# Replies


def structure_validate(spark, sf_dir):
    record = F.col("record")
    return (
        derive.model_replies(spark, sf_dir)
        .select("id", R.validate(F.col("reply")).alias("record"))
        .select(
            "id",
            F.col("record.valid").alias("valid"),
            F.col("record.description").alias("description"),
            F.col("record.category").alias("category"),
            _joined(F.col("record.tags")).alias("tags"),
            F.col("record.audience.age_range").alias("age_range"),
            _joined(F.col("record.audience.interests")).alias("interests"),
            F.col("record.audience.demographics.primary_language").alias("primary_language"),
            F.col("record.audience.demographics.geo").alias("geo"),
            R.coverage_label(record["metrics"]["geographic_coverage"]).alias("coverage"),
            F.col("record.metrics.publishing_frequency").alias("frequency"),
            _joined(F.col("record.metrics.ad_formats_available")).alias("ad_formats"),
            F.col("record.metrics.social_media_presence").alias("presence"),
            F.to_json("record.metrics_extra").alias("extra"),
        )
    )


def model_messages(spark, sf_dir):
    return (
        table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", F.posexplode(R.messages(F.col("role"), F.col("text"))))
        .select(
            "conv_id", "turn", F.col("pos").alias("position"),
            F.col("col.role").alias("role"), F.col("col.content").alias("content"),
        )
    )


# Merges


def _item_updates(spark, sf_dir) -> DataFrame:
    """Two updates per even-sized document, one for an id no item has."""
    docs = table(spark, sf_dir, "documents")
    seq = F.col("seq")
    return docs.where(F.col("lang") != "de").select(
        F.when(F.col("lang") == "es", F.concat(F.lit("x"), F.col("doc_id").cast("string")))
        .otherwise(F.col("doc_id").cast("string"))
        .alias("id"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("n_chars") % 2 == 0, 2).otherwise(1))).alias("seq"),
        "lang",
    ).select(
        "id",
        seq.cast("bigint").alias("seq"),
        F.when(F.col("lang") == "en", F.concat(F.lit("new "), seq.cast("string"))).alias("description"),
        F.lit("Science").alias("category"),
        F.array(F.lit("t"), seq.cast("string")).alias("tags"),
        F.lit(None).cast("struct<interests:array<string>>").alias("audience"),
        F.lit(None).cast("struct<geographic_coverage:array<string>,content_topics:array<string>>").alias("metrics"),
    )


def merge_items(spark, sf_dir):
    merged = merge.merge_items(derive.items(spark, sf_dir), _item_updates(spark, sf_dir), NOW)
    return merged.select(
        "id", "title", "description", "category", _joined(F.col("tags")).alias("tags"),
        F.to_json("metrics.geographic_coverage").alias("coverage"),
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


def merge_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")
    merged = merge.merge_vectors(derive.items(spark, sf_dir), vectors)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    return merged.select(
        "id", F.size("embedding").alias("dimension"), F.round(total * 1000).cast("bigint").alias("milli_sum"),
        F.col("updated_at").isNull().alias("untouched"),
    )


def requeue_missing(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("id"))
    return merge.unwritten(_label_ids(spark, sf_dir), vectors)


def remaining_work(spark, sf_dir):
    todo = item_source.scan_unenriched(derive.items(spark, sf_dir))
    return merge.remaining(todo, _label_ids(spark, sf_dir))


# Vectors


def unit_vector(spark, sf_dir):
    unit = V.unit_length(F.col("embedding"))
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", F.posexplode(unit).alias("position", "x"))
        .select("vec_id", "position", F.round(F.col("x") * 1e6).cast("bigint").alias("micro"))
    )


def vector_literal(spark, sf_dir):
    text = F.col("text")
    values = F.split(F.substring(text, 2, F.length(text) - 2), ",")
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", V.vector_literal(F.col("embedding")).alias("text"))
        .select("vec_id", F.substring(text, 1, 1).alias("head"), F.posexplode(values).alias("position", "v"))
        .select("vec_id", "head", "position", F.round(F.col("v").cast("double") * 1e6).cast("bigint").alias("micro"))
    )


# Numbering and reports


def batch_numbers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    numbered = numbering.with_index(orders, ["o_orderdate", "o_orderkey"], "position")
    return numbered.select(
        "o_orderkey", "position",
        F.floor(F.col("position") / 50).alias("wave"), F.floor(F.col("position") / 100).alias("batch"),
    )


def run_totals(spark, sf_dir):
    return runlog.totals(derive.run_log(spark, sf_dir))


def source_distribution(spark, sf_dir):
    return runlog.source_distribution(derive.run_log(spark, sf_dir))


def success_list(spark, sf_dir):
    return runlog.success_list(derive.run_log(spark, sf_dir))


def failed_list(spark, sf_dir):
    return runlog.failure_list(derive.run_log(spark, sf_dir))


def quarantine(spark, sf_dir):
    return runlog.quarantine(derive.run_log(spark, sf_dir), "structure")


# Models


def model_structuring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    replies = model.structure(docs, "id", R.messages(stubs.SYSTEM, F.col("text")), stubs.chat)
    record = R.validate(F.col("reply"))
    return replies.select("id", record.alias("r")).select(
        "id", F.col("r.valid").alias("valid"), F.md5("r.description").alias("description_md5"),
        _joined(F.col("r.tags")).alias("tags"), R.coverage_label(F.col("r.metrics")["geographic_coverage"]).alias("coverage"),
    )


def model_embedding(spark, sf_dir):
    found = item_source.fetch_for_embedding(derive.items(spark, sf_dir), _label_ids(spark, sf_dir))
    vectors = model.embed_items(found, stubs.embedder, dimension=stubs.DIMENSION)
    return vectors.select("id", _joined(F.col("embedding").cast("array<int>").cast("array<string>")).alias("embedding"), "error")


def embedding_totals(spark, sf_dir):
    found = item_source.fetch_for_embedding(derive.items(spark, sf_dir), _label_ids(spark, sf_dir))
    return runlog.write_totals(model.embed_items(found, stubs.embedder, dimension=stubs.DIMENSION))


def attempts_rerun(spark, sf_dir):
    def step(rows: DataFrame, attempt: int) -> DataFrame:
        needed = F.length("text") % 4 + 1
        error = F.when(needed > attempt, F.concat(F.lit("needs "), needed.cast("string")))
        return rows.select("id", error.alias("error"))

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return attempts.run_with_attempts(docs, "id", step)


def _enrich_items(spark, sf_dir):
    fields = [
        T.StructField(f.name, f.dataType)
        for f in MEDIA_ITEM
        if f.name not in ("id", "title", "description", "category")
    ]
    return derive.outlets(spark, sf_dir).select(
        "id",
        "title",
        F.when(F.col("lang") == "fr", "done").alias("description"),
        F.lit("old").alias("category"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
    )


def _enrich_rows(result):
    log = result.log.select("id", "status", "source", "context_chars", "attempts", "tier")
    return result.items.select(
        "id",
        "title",
        F.md5("description").alias("description_md5"),
        "category",
        F.array_size("tags").alias("n_tags"),
        F.col("metrics.founding_year").alias("founding_year"),
    ).join(log, "id", "left")


def enrich_job(spark, sf_dir):
    items = _enrich_items(spark, sf_dir)
    return _enrich_rows(enrich(items, derive.snapshots(spark, sf_dir), stubs.SYSTEM, stubs.chat, NOW))


def resumed_enrich_job(spark, sf_dir):
    """enrich_job run again after a driver lost past the model: the first run's replies are in the
    store, and the second run's model refuses every call, so any reply paid twice shows as a
    failure and the rows differ from enrich_job's."""
    store = ReplyStore(scratch_folder(spark, "replies"))
    items, snapshots = _enrich_items(spark, sf_dir), derive.snapshots(spark, sf_dir)
    enrich(items, snapshots, stubs.SYSTEM, stubs.chat, NOW, replies=store)  # replies are stored as they arrive
    return _enrich_rows(enrich(items, snapshots, stubs.SYSTEM, stubs.refuse, NOW, replies=store))


# Streams


def pending_stream(spark, sf_dir):
    store = EmbeddingStore(scratch_folder(spark, "drain"))
    items = durable(derive.items(spark, sf_dir))
    derive.pending_ids(spark, sf_dir).write.mode("append").parquet(store.pending)
    for _ in range(3):
        start_drain(
            spark, lambda: items, stubs.embedder, store, flush=True, dimension=stubs.DIMENSION
        ).awaitTermination()
    return apply_vectors(spark, items, store).where(F.col("embedding").isNotNull()).select(
        "id", _joined(F.col("embedding").cast("array<int>").cast("array<string>")).alias("embedding")
    )


def count_or_time(spark, sf_dir):
    store = EmbeddingStore(scratch_folder(spark, "buffer"))
    pending = derive.pending_ids(spark, sf_dir)
    pending.write.mode("append").parquet(store.pending)
    query = (
        count_or_time_batches(pending_source(spark, store.pending), wait_ms=None)
        .writeStream.format("parquet")
        .option("path", store.results)
        .option("checkpointLocation", store.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batches = spark.read.schema("shard int, reason string, ids array<string>").parquet(store.results)
    closed = batches.select(F.explode("ids").alias("id")).distinct()
    return closed.union(unbatched(pending, batches))


QUERIES: dict[str, Query] = {
    "unenriched_scan": unenriched_scan,
    "oldest_unenriched": oldest_unenriched,
    "unenriched_count": unenriched_count,
    "dispatch_estimate": dispatch_estimate,
    "rerun_one": rerun_one,
    "backlog": backlog,
    "embedding_fetch": embedding_fetch,
    "embedding_text": embedding_text,
    "latin_slug": latin_slug,
    "slug_variant_b": slug_variant_b,
    "tld_from_name": tld_from_name,
    "slug_candidates": slug_candidates,
    "candidates_variant_b": candidates_variant_b,
    "first_reachable": first_reachable,
    "wiki_best_hit": wiki_best_hit,
    "entity_claims": entity_claims,
    "encyclopedia_pages": encyclopedia_pages,
    "search_links": search_links,
    "discovery_chain": discovery_chain,
    "page_lookup": page_lookup,
    "about_lookup": about_lookup,
    "feed_lookup": feed_lookup,
    "page_title": page_title,
    "page_meta": page_meta,
    "page_body": page_body,
    "jsonld_block": jsonld_block,
    "feed_categories": feed_categories_query,
    "site_signals": site_signals,
    "context_route": context_route,
    "structure_validate": structure_validate,
    "model_messages": model_messages,
    "merge_items": merge_items,
    "merge_vectors": merge_vectors,
    "requeue_missing": requeue_missing,
    "remaining_work": remaining_work,
    "unit_vector": unit_vector,
    "vector_literal": vector_literal,
    "batch_numbers": batch_numbers,
    "run_totals": run_totals,
    "source_distribution": source_distribution,
    "success_list": success_list,
    "failed_list": failed_list,
    "quarantine": quarantine,
    "model_structuring": model_structuring,
    "model_embedding": model_embedding,
    "embedding_totals": embedding_totals,
    "attempts_rerun": attempts_rerun,
    "enrich_job": enrich_job,
    "resumed_enrich_job": resumed_enrich_job,
    "pending_stream": pending_stream,
    "count_or_time": count_or_time,
}
