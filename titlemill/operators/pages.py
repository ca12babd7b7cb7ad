"""Reading sites: home page, about page and feed of each crawled address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from titlemill.functions.context import best_description, longer_about, route_context, site_context
from titlemill.functions.feed import feed_categories, looks_like_feed
from titlemill.functions.html import (
    MAX_BODY,
    body_text,
    body_text_of,
    meta_of,
    meta_tags,
    organisation_markup,
    title_of,
    visible,
)
from titlemill.functions.text import let, nz, spread_nulls, strip_slashes
from titlemill.operators.lookup import lookup
from titlemill.session import durable
from titlemill.sources.snapshots import page_bodies

# Sub-pages looked for below a site's address, in this order.
ABOUT_PATHS = ["/about", "/about-us", "/про-нас", "/pro-nas", "/contacts", "/about/us"]
FEED_PATHS = ["/feed", "/rss", "/feed.xml", "/rss.xml", "/atom.xml"]

# Bits of the map of wanted addresses: 4 MB, whatever the number of titles.
WANTED_BITS = 1 << 25


def page_signals(body: Column) -> Column:
    """Everything read from a home page, as one struct."""

    def read(clean: Column) -> Column:
        found = F.struct(
            organisation_markup(body).alias("org"),
            meta_tags(clean).alias("metas"),
            clean.alias("clean"),
        )
        return let(found, build)

    def build(page: Column) -> Column:
        org, metas, clean = page["org"], page["metas"], page["clean"]
        return F.struct(
            nz(org["name"]).alias("name"),
            nz(org["description"]).alias("description"),
            nz(org["url"]).alias("url"),
            meta_of(metas, "property", "og:title").alias("og_title"),
            meta_of(metas, "property", "og:description").alias("og_desc"),
            meta_of(metas, "name", "description").alias("meta_desc"),
            title_of(clean).alias("page_title"),
            body_text_of(clean).alias("body_text"),
        )

    return let(visible(body), read)


def _ending(url: Column, paths: list[str]) -> tuple[Column, Column]:
    """(position of the path `url` ends with or NULL, address above that path)."""
    position = F.lit(None).cast("int")
    base = F.lit(None).cast("string")
    for i, path in enumerate(paths):
        ends = F.endswith(url, F.lit(path))
        position = F.when(ends, F.lit(i)).otherwise(position)
        base = F.when(ends, F.left(url, F.length(url) - len(path))).otherwise(base)
    return position, base


def sub_pages(page_snapshot: DataFrame, paths: list[str], value: Column, name: str) -> DataFrame:
    """base, `name`: `value` of the first sub-page in `paths` that has a body.

    A crawled address says itself which site it belongs to, so sub-pages are found by cutting
    their path off, with one row per sub-page instead of one probe per site and path.
    """
    position, base = _ending(F.col("url"), paths)
    return (
        page_bodies(page_snapshot)
        .select(base.alias("base"), position.alias("position"), "body")
        .where(F.col("position").isNotNull())
        .select("base", "position", value.alias(name))
        .groupBy("base")
        .agg(F.min(F.struct("position", name)).alias("first"))
        .select("base", f"first.{name}")
    )


def about_pages(page_snapshot: DataFrame) -> DataFrame:
    """base, about_body: text of the about page of a site."""
    return sub_pages(page_snapshot, ABOUT_PATHS, body_text(F.col("body")), "about_body")


def feed_pages(page_snapshot: DataFrame) -> DataFrame:
    """base, rss_categories of the feed of a site; NULL where the feed address holds no feed."""
    feed = F.when(looks_like_feed(F.col("body")), F.col("body"))
    return sub_pages(page_snapshot, FEED_PATHS, feed_categories(feed), "rss_categories")


def _slot(address: Column) -> Column:
    return F.pmod(F.xxhash64(address), F.lit(WANTED_BITS)) + 1


def wanted_pages(page_snapshot: DataFrame, sites: DataFrame) -> DataFrame:
    """The pages that a site in `sites` (base) may be read from: its home page and its sub-pages.

    Few sites of a crawl are named by a title, and reading a page costs far more than finding it
    unwanted. The wanted addresses are hashed to a bitmap of fixed size, so bodies are neither
    read nor shuffled for it. Two addresses may share a bit: some unwanted pages stay, and fall
    out when sites are joined by address; no wanted one is lost.
    """
    slot = F.col("slot")
    blocks = (
        sites.where(F.col("base").isNotNull())
        .select(_slot(F.col("base")).alias("slot"))
        .groupBy(F.bitmap_bucket_number(slot).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    )
    wanted = blocks.agg(F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("_blocks"))

    def marked(address: Column) -> Column:
        position = F.bitmap_bit_position(_slot(address))
        bits = F.try_element_at(F.col("_blocks"), F.bitmap_bucket_number(_slot(address)))
        byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.getbit(byte, (position % 8).cast("int"))
        return address.isNotNull() & F.coalesce(bit == 1, F.lit(False))

    url = F.col("url")
    roles = [strip_slashes(url), _ending(url, ABOUT_PATHS)[1], _ending(url, FEED_PATHS)[1]]
    condition = marked(roles[0]) | marked(roles[1]) | marked(roles[2])
    return page_snapshot.join(F.broadcast(wanted), condition, "left_semi")


def site_signals(page_snapshot: DataFrame) -> DataFrame:
    """base, site_url, signals, about_text, rss_categories: each live page taken as a home page.

    One scan reads every role of a page: as a home page, and as a sub-page of the site above it.
    Bodies are cut to signals where they are read and never shuffled. Copies of a page collapse
    before the first shuffle, so the window holds one home page per spelling of an address and one
    page per known path. Of spellings that differ in slashes at the end the shortest stays. The
    result depends on the crawl alone: stored with the crawl and handed over as
    `Snapshots.site_signals`, it spares later runs the pages.
    """
    body = F.col("body")
    about_position, about_base = _ending(F.col("url"), ABOUT_PATHS)
    feed_position, feed_base = _ending(F.col("url"), FEED_PATHS)
    is_feed = feed_position.isNotNull() & looks_like_feed(body)
    read = page_bodies(page_snapshot).select(
        "url",
        page_signals(body).alias("signals"),
        feed_categories(F.when(is_feed, body)).alias("categories"),
    )

    def entry(kind: str, base: Column, position: Column) -> Column:
        home, about = F.lit(kind == "home"), F.lit(kind == "about")
        return F.struct(
            base.alias("base"),
            F.when(home, F.col("url")).alias("site_url"),
            F.lit(kind).alias("kind"),
            position.alias("position"),
            F.when(home, F.col("signals")).alias("signals"),
            F.when(about, F.col("signals.body_text")).alias("about_body"),
            F.when(~home & ~about, F.col("categories")).alias("categories"),
        )

    roles = F.array(
        entry("home", strip_slashes(F.col("url")), F.lit(0)),
        entry("about", about_base, about_position),
        entry("feed", feed_base, feed_position),
    )
    entries = read.select(F.inline(F.filter(roles, lambda r: r["position"].isNotNull())))
    pages = (
        entries.groupBy("base", "site_url", "kind", "position")
        .agg(F.min(F.struct("signals", "about_body", "categories")).alias("page"))
        .select("base", "site_url", "kind", "position", "page.*")
    )
    site = Window.partitionBy("base")

    def first(kind: str, value: str) -> Column:
        found = F.when(F.col("kind") == kind, F.struct("position", value))
        return F.min(found).over(site)[value]

    joined = pages.select(
        "base",
        "site_url",
        F.min("site_url").over(site).alias("shortest"),
        "kind",
        "signals",
        first("about", "about_body").alias("about_body"),
        first("feed", "categories").alias("rss_categories"),
    ).where((F.col("kind") == "home") & (F.col("site_url") == F.col("shortest")))
    about = F.substring(longer_about(F.col("about_body"), F.col("signals.body_text")), 1, MAX_BODY)
    return joined.select("base", "site_url", "signals", about.alias("about_text"), "rss_categories")


def with_context(
    discovered: DataFrame, page_snapshot: DataFrame | None, stored_signals: DataFrame | None = None
) -> DataFrame:
    """Add `context`: the text a model reads about each discovered name.

    Sites are looked up by address without slashes at its end, in `stored_signals` if there are
    any, else in those pages that a name leads to. The names are then read twice and
    materialised for it.
    """
    url, source = F.col("url"), F.col("source")
    wants_site = nz(url).isNotNull() & ~F.startswith(source, F.lit("wikipedia"))
    if page_snapshot is None and stored_signals is None:
        rows = discovered.select(
            "*",
            F.lit(None).cast("string").alias("about_text"),
            F.lit(None).cast("array<string>").alias("rss_categories"),
            F.struct(
                *[
                    F.lit(None).cast("string").alias(c)
                    for c in ("name", "description", "og_desc", "meta_desc", "body_text")
                ]
            ).alias("signals"),
        )
    else:
        # Many names may share one address: the names are the probe side, which adaptive
        # execution splits; names without a site carry keys that spread evenly.
        address = F.when(wants_site, strip_slashes(url))
        key = spread_nulls(address, F.col("name"))
        known = stored_signals
        if known is None:
            discovered = durable(discovered)
            known = site_signals(wanted_pages(page_snapshot, discovered.select(address.alias("base"))))
        sites = known.select(F.col("base").alias("_base"), "signals", "about_text", "rss_categories")
        rows = lookup(discovered, sites, [(key, "_base")])
    site = site_context(
        F.col("name"),
        F.col("signals.name"),
        best_description(
            F.col("signals.description"), F.col("signals.og_desc"), F.col("signals.meta_desc")
        ),
        F.col("about_text"),
        F.col("signals.body_text"),
        F.col("rss_categories"),
    )
    context = route_context(F.col("name"), url, F.col("extract"), source, site)
    return rows.select(*discovered.columns, context.alias("context"))
