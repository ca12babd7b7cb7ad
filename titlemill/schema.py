"""Explicit schemas. Nothing in the package relies on schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

STRINGS = T.ArrayType(T.StringType())

DEMOGRAPHICS = T.StructType(
    [
        T.StructField("primary_language", T.StringType()),
        T.StructField("geo", T.StringType()),
        T.StructField("gender_split", T.StringType()),
    ]
)

AUDIENCE = T.StructType(
    [
        T.StructField("age_range", T.StringType()),
        T.StructField("interests", STRINGS),
        T.StructField("demographics", DEMOGRAPHICS),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("geographic_coverage", STRINGS),
        T.StructField("publishing_frequency", T.StringType()),
        T.StructField("ad_formats_available", STRINGS),
        T.StructField("social_media_presence", T.StringType()),
        T.StructField("content_topics", STRINGS),
        T.StructField("founding_year", T.StringType()),
    ]
)

# The typed part of a model reply; unknown keys of `metrics` are kept apart as a map.
REPLY = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tags", STRINGS),
        T.StructField("audience", AUDIENCE),
        T.StructField("metrics", METRICS),
    ]
)

VECTOR = T.ArrayType(T.FloatType())

# One record of the item table. Further columns of a caller's table pass through every operator.
MEDIA_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tags", STRINGS),
        T.StructField("audience", AUDIENCE),
        T.StructField("metrics", METRICS),
        T.StructField("metrics_extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("format_type", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("embedding", VECTOR),
    ]
)

# One entry of the pending queue. `attempts` counts earlier drains that could not write the id.
PENDING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("enqueued_at", T.TimestampType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tier", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("context_chars", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)
