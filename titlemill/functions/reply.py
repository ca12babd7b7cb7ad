"""Messages for a structuring model, and validation of its replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from titlemill.functions.text import has_items, is_one_of, let, nz
from titlemill.schema import REPLY

# What a reply may contain, and what replaces a value outside it.
CATEGORIES = [
    "News", "Business", "Technology", "Sports", "Fashion", "Agriculture",
    "Video", "Entertainment", "Science", "Health", "Politics",
]
FREQUENCIES = ["daily", "weekly", "monthly", "breaking_news"]
PRESENCES = ["strong", "moderate", "weak", "none"]
DEFAULT_CATEGORY = "News"
DEFAULT_FREQUENCY = "daily"
DEFAULT_PRESENCE = "moderate"
DEFAULT_AD_FORMATS = ["Banner", "Native"]
MAX_TAGS = 50

# Keys of `metrics` with a typed field, and keys that are no longer accepted.
TYPED_METRICS = [
    "geographic_coverage", "publishing_frequency", "ad_formats_available",
    "social_media_presence", "content_topics", "founding_year",
]
RETIRED_METRICS = ["reach_tier", "pricing_tier", "data_source"]


def messages(system: str | Column, context: Column) -> Column:
    """The conversation sent to the model: a system prompt, then the context."""
    prompt = F.lit(system) if isinstance(system, str) else system

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(turn("system", prompt), turn("user", context))


def _texts(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull())


def _default_audience() -> Column:
    return F.struct(
        F.lit("25-44").alias("age_range"),
        F.array().cast("array<string>").alias("interests"),
        F.struct(
            F.lit("unknown").alias("primary_language"),
            F.lit("unknown").alias("geo"),
            F.lit("50M/50F").alias("gender_split"),
        ).alias("demographics"),
    )


def _tags(listed: Column, text: Column) -> Column:
    # A bare string becomes one tag.
    single = F.when(nz(text).isNotNull(), F.array(text))
    return F.slice(F.coalesce(_texts(listed), single, F.array().cast("array<string>")), 1, MAX_TAGS)


def validate(reply: Column) -> Column:
    """Coerce a reply to the record schema.

    Returns struct(valid, error, description, category, tags, audience, metrics, metrics_extra).
    `valid` is false for text that is no JSON object and for a reply without a description.
    """
    parsed = F.try_parse_json(reply)
    tags = F.try_variant_get(parsed, "$.tags", "variant")
    bound = F.struct(
        F.when(parsed.isNotNull(), F.from_json(reply, "map<string,string>")).alias("keys"),
        F.from_json(reply, REPLY).alias("data"),
        F.when(
            F.schema_of_variant(tags) == "STRING", F.try_variant_get(parsed, "$.tags", "string")
        ).alias("tag_text"),
    )

    def build(both: Column) -> Column:
        keys, data = both["keys"], both["data"]
        metrics = data["metrics"]
        extra = F.map_filter(
            F.from_json(keys["metrics"], "map<string,string>"),
            lambda k, _: ~k.isin(*TYPED_METRICS, *RETIRED_METRICS),
        )
        described = F.coalesce(F.map_contains_key(keys, "description"), F.lit(False))
        has_audience = F.coalesce(F.map_contains_key(keys, "audience"), F.lit(False))
        return F.struct(
            described.alias("valid"),
            F.when(keys.isNull(), F.lit("reply is not a JSON object"))
            .when(~described, F.lit("reply has no description"))
            .alias("error"),
            data["description"].alias("description"),
            F.when(is_one_of(data["category"], CATEGORIES), data["category"])
            .otherwise(F.lit(DEFAULT_CATEGORY))
            .alias("category"),
            _tags(data["tags"], both["tag_text"]).alias("tags"),
            F.when(has_audience, data["audience"]).otherwise(_default_audience()).alias("audience"),
            F.struct(
                F.coalesce(
                    _texts(metrics["geographic_coverage"]), F.array().cast("array<string>")
                ).alias("geographic_coverage"),
                F.when(
                    is_one_of(metrics["publishing_frequency"], FREQUENCIES),
                    metrics["publishing_frequency"],
                )
                .otherwise(F.lit(DEFAULT_FREQUENCY))
                .alias("publishing_frequency"),
                F.coalesce(
                    _texts(metrics["ad_formats_available"]),
                    F.array(*[F.lit(f) for f in DEFAULT_AD_FORMATS]),
                ).alias("ad_formats_available"),
                F.when(
                    is_one_of(metrics["social_media_presence"], PRESENCES),
                    metrics["social_media_presence"],
                )
                .otherwise(F.lit(DEFAULT_PRESENCE))
                .alias("social_media_presence"),
                _texts(metrics["content_topics"]).alias("content_topics"),
                metrics["founding_year"].alias("founding_year"),
            ).alias("metrics"),
            F.coalesce(extra, F.create_map().cast("map<string,string>")).alias("metrics_extra"),
        )

    return let(bound, build)


def with_founding_year(metrics: Column, year: Column) -> Column:
    """Metrics with the year found during discovery, where one was found."""
    return F.when(nz(year).isNotNull(), metrics.withField("founding_year", year)).otherwise(metrics)


def coverage_label(coverage: Column) -> Column:
    """The covered places as one label, `?` for none."""
    return F.when(has_items(coverage), F.array_join(coverage, ", ")).otherwise(F.lit("?"))


def as_json(value: Column) -> Column:
    """Encode a struct or map for a JSON column."""
    return F.to_json(value)
