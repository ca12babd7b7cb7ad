"""Flattening signals into the bounded text a model reads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from titlemill.functions.text import has_items, let, nz

MAX_TOTAL = 6000
MAX_ARTICLE = MAX_TOTAL - 100
THIN_SITE = 500


def best_description(markup: Column, shared: Column, meta: Column) -> Column:
    """First non-empty of the linked-data, social and plain descriptions."""
    return F.coalesce(nz(markup), nz(shared), nz(meta))


def longer_about(about: Column, body: Column) -> Column:
    """The about-page text, if it says more than the home page."""
    return F.when(F.length(about) > F.length(F.coalesce(body, F.lit(""))), about)


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), nz(value))


def site_context(
    title: Column,
    official: Column,
    description: Column,
    about: Column,
    body: Column,
    categories: Column,
) -> Column:
    """Labelled lines for what a site says about itself, cut to 6000 characters."""
    lines = [
        F.concat(F.lit("Outlet name: "), F.coalesce(title, F.lit(""))),
        F.when(F.lower(official) != F.lower(title), _line("Official name: ", official)),
        _line("Description: ", description),
        F.coalesce(_line("About: ", about), _line("Content: ", body)),
        F.when(
            has_items(categories),
            F.concat(F.lit("Content categories: "), F.array_join(categories, ", ")),
        ),
    ]
    return F.substring(F.concat_ws("\n", *lines), 1, MAX_TOTAL)


def article_context(title: Column, extract: Column) -> Column:
    """The encyclopedia extract as context."""
    return F.concat(
        F.lit("Outlet name: "),
        title,
        F.lit("\nWikipedia article:\n"),
        F.substring(extract, 1, MAX_ARTICLE),
    )


def route_context(
    title: Column, url: Column, extract: Column, source: Column, site: Column
) -> Column:
    """Choose between article, site, both, and the bare title. `site` is a `site_context`."""
    from_article = F.startswith(F.coalesce(source, F.lit("none")), F.lit("wikipedia"))
    has_extract = nz(extract).isNotNull()
    article = article_context(title, extract)
    return (
        F.when(from_article & has_extract, article)
        .when(
            nz(url).isNotNull() & ~from_article,
            let(
                site,
                lambda s: F.when(
                    has_extract & (F.length(s) < THIN_SITE), F.concat(article, F.lit("\n\n"), s)
                ).otherwise(s),
            ),
        )
        .when(has_extract, article)
        .otherwise(F.concat(F.lit("Outlet name: "), title))
    )
