"""Embedding text and vector columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from titlemill.functions.text import has_items, nz

MAX_CHARS = 8000


def embedding_text(
    title: Column,
    description: Column,
    category: Column,
    format_type: Column,
    language: Column,
    tags: Column,
    interests: Column,
    coverage: Column,
    topics: Column,
) -> Column:
    """The text that stands for an item in a vector index, cut to 8000 characters.

    Sections keep this order, and one that is NULL or empty leaves no trace.
    """

    def labelled(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"{label}: "), nz(value))

    def listed(label: str, values: Column) -> Column:
        return F.when(
            has_items(values), F.concat(F.lit(f"{label}: "), F.array_join(values, ", "))
        )

    parts = [
        nz(title),
        nz(description),
        labelled("Category", category),
        labelled("Format", format_type),
        labelled("Language", language),
        listed("Tags", tags),
        listed("Audience interests", interests),
        listed("Geographic coverage", coverage),
        listed("Content topics", topics),
    ]
    return F.substring(F.concat_ws(". ", *parts), 1, MAX_CHARS)


def item_embedding_text() -> Column:
    """`embedding_text` over the columns of the item table."""
    return embedding_text(
        F.col("title"),
        F.col("description"),
        F.col("category"),
        F.col("format_type"),
        F.col("language"),
        F.col("tags"),
        F.col("audience.interests"),
        F.col("metrics.geographic_coverage"),
        F.col("metrics.content_topics"),
    )


def vector_literal(vector: Column) -> Column:
    """`[0.12345678,...]`, the text form vector columns accept."""
    digits = F.transform(vector, lambda x: F.format_string("%.8f", x.cast("double")))
    return F.concat(F.lit("["), F.array_join(digits, ","), F.lit("]"))


def unit_length(vector: Column) -> Column:
    """The vector divided by its length; a zero vector stays as it is."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    norm = F.coalesce(F.nullif(F.sqrt(squares), F.lit(0.0)), F.lit(1.0))
    return F.zip_with(
        vector,
        F.array_repeat(norm, F.size(vector)),
        lambda x, n: x.cast("double") / n,
    )
