import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from titlemill.functions import vectors as V

SCHEMA = """title string, description string, category string, format_type string,
language string, tags array<string>, audience struct<interests:array<string>>,
metrics struct<geographic_coverage:array<string>,content_topics:array<string>>"""
NAMES = ["title", "description", "category", "format_type", "language", "tags", "audience", "metrics"]
FULL = dict(
    title="T",
    description="D",
    category="Technology",
    format_type="site",
    language="uk",
    tags=["tech", "startup"],
    audience={"interests": ["AI", "startups"]},
    metrics={"geographic_coverage": ["Kyiv", "Lviv"], "content_topics": ["fintech"]},
)
CASES = [
    (dict(title="Solo Title"), "Solo Title"),
    (dict(title=""), ""),
    (dict(title="", description="D"), "D"),
    (dict(title="T", description=None), "T"),
    (dict(title="T", description=""), "T"),
    (dict(title="T", category="Technology"), "T. Category: Technology"),
    (dict(title="T", tags=["a", "b"]), "T. Tags: a, b"),
    (dict(title="T", tags=[]), "T"),
    (dict(title="T", audience={"interests": ["AI", "x"]}), "T. Audience interests: AI, x"),
    (dict(title="T", audience={"interests": []}), "T"),
    (dict(title="T", metrics={"geographic_coverage": ["K"]}), "T. Geographic coverage: K"),
    (dict(title="T", metrics={"content_topics": ["f", "b"]}), "T. Content topics: f, b"),
    (
        FULL,
        "T. D. Category: Technology. Format: site. Language: uk. Tags: tech, startup. "
        "Audience interests: AI, startups. Geographic coverage: Kyiv, Lviv. Content topics: fintech",
    ),
]


@pytest.fixture(scope="module")
def texts(spark):
    def run(items):
        rows = []
        for i, item in enumerate(items):
            item = dict(item)
            if item.get("metrics"):
                item["metrics"] = {"geographic_coverage": None, "content_topics": None} | item["metrics"]
            rows.append((i, *[item.get(n) for n in NAMES]))
        df = spark.createDataFrame(rows, "i int, " + SCHEMA)
        return [
            r["t"]
            for r in df.select("i", V.item_embedding_text().alias("t")).orderBy("i").collect()
        ]

    return run


def test_embedding_text(texts):
    assert texts([c[0] for c in CASES]) == [c[1] for c in CASES]


def test_overflow(texts):
    made = texts([dict(title="T", description="d" * 9000)])[0]
    assert len(made) == 8000 and made.startswith("T. ddd")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.text("ab. ", max_size=4500), min_size=3, max_size=3), min_size=5, max_size=9))
def test_bound_and_separators(texts, items):
    for made in texts([dict(title=t, description=d, tags=[x]) for t, d, x in items]):
        assert len(made) <= 8000


def test_list_typed_fields_come_from_json(spark):
    replies = ['{"interests":"AI"}', '{"interests":["AI"]}', "{}"]
    df = spark.createDataFrame([(r,) for r in replies], "r string")
    got = df.select(F.from_json("r", "interests array<string>")["interests"].alias("x")).collect()
    assert [r["x"] for r in got] == [None, ["AI"], None]


def test_unit_length_and_literal(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    rows = df.select(V.unit_length(F.col("v")).alias("u"), V.vector_literal(F.col("v")).alias("t"))
    got = rows.collect()
    assert [math.isclose(a, b) for a, b in zip(got[0]["u"], [0.6, 0.8])] == [True, True]
    assert got[1]["u"] == [0.0, 0.0]
    assert got[0]["t"] == "[3.00000000,4.00000000]"
