import json

import pytest

from titlemill.functions import reply as R

VALID = {
    "description": "An outlet.",
    "category": "Technology",
    "tags": ["a", "b"],
    "audience": {
        "age_range": "18-35",
        "interests": ["tech", "startups"],
        "demographics": {"primary_language": "uk", "geo": "Kyiv", "gender_split": "60M/40F"},
    },
    "metrics": {
        "geographic_coverage": ["Kyiv", "Lviv"],
        "publishing_frequency": "weekly",
        "ad_formats_available": ["Pre-roll"],
        "social_media_presence": "strong",
    },
}
ABSENT = object()


def changed(**changes):
    out = json.loads(json.dumps(VALID))
    for path, value in changes.items():
        node = out
        *parents, leaf = path.split("__")
        for parent in parents:
            node = node[parent]
        if value is ABSENT:
            del node[leaf]
        else:
            node[leaf] = value
    return json.dumps(out)


def pick(row, path):
    for part in path.split("__"):
        row = row[part]
    return row


CASES = (
    [("category", {"category": c}, c) for c in R.CATEGORIES]
    + [("category", {"category": c}, "News") for c in ("Cooking", None, "", ABSENT, 5)]
    + [
        ("tags", {"tags": [f"tag_{i}" for i in range(80)]}, [f"tag_{i}" for i in range(50)]),
        ("tags", {"tags": ["a", "b", "c"]}, ["a", "b", "c"]),
        ("tags", {"tags": ABSENT}, []),
        ("tags", {"tags": None}, []),
        ("tags", {"tags": ""}, []),
        ("tags", {"tags": False}, []),
        ("tags", {"tags": [1, 2, 3]}, ["1", "2", "3"]),
        ("tags", {"tags": ["a", None]}, ["a"]),
        ("tags", {"tags": "one"}, ["one"]),
        ("metrics__geographic_coverage", {}, ["Kyiv", "Lviv"]),
        ("metrics__geographic_coverage", {"metrics__geographic_coverage": "Kyiv"}, []),
        ("metrics__geographic_coverage", {"metrics__geographic_coverage": ABSENT}, []),
        ("metrics__geographic_coverage", {"metrics__geographic_coverage": None}, []),
        ("metrics__geographic_coverage", {"metrics": ABSENT}, []),
        ("metrics__geographic_coverage", {"metrics": None}, []),
        ("metrics__publishing_frequency", {}, "weekly"),
        ("metrics__publishing_frequency", {"metrics__publishing_frequency": "hourly"}, "daily"),
        ("metrics__publishing_frequency", {"metrics": ABSENT}, "daily"),
        ("metrics__social_media_presence", {}, "strong"),
        ("metrics__social_media_presence", {"metrics__social_media_presence": None}, "moderate"),
        ("metrics__ad_formats_available", {}, ["Pre-roll"]),
        ("metrics__ad_formats_available", {"metrics__ad_formats_available": "x"}, ["Banner", "Native"]),
        ("metrics__content_topics", {"metrics__content_topics": ["x"]}, ["x"]),
        ("metrics__content_topics", {}, None),
        ("audience__interests", {}, ["tech", "startups"]),
        ("audience__interests", {"audience": ABSENT}, []),
        ("audience__age_range", {"audience": ABSENT}, "25-44"),
        ("audience__demographics__gender_split", {"audience": ABSENT}, "50M/50F"),
        ("audience", {"audience": None}, None),
        ("metrics_extra", {"metrics__reach_tier": "A", "metrics__pricing_tier": "B"}, {}),
        (
            "metrics_extra",
            {"metrics__data_source": "x", "metrics__custom": {"a": [1]}, "metrics__n": 7},
            {"custom": '{"a":[1]}', "n": "7"},
        ),
        ("valid", {"description": None}, True),
        ("description", {"description": None}, None),
        ("valid", {"description": ABSENT}, False),
        ("error", {"description": ABSENT}, "reply has no description"),
    ]
)


@pytest.fixture(scope="module")
def validated(evaluate):
    return evaluate(R.validate, [changed(**changes) for _, changes, _ in CASES])


@pytest.mark.parametrize("case", range(len(CASES)))
def test_validate(validated, case):
    path, _, expected = CASES[case]
    assert pick(validated[case], path) == expected


def test_replies_that_are_no_object(evaluate):
    got = evaluate(R.validate, ["{broken", "[1]", '"text"', "", None, "```json\n{}\n```"])
    assert [(g["valid"], g["error"]) for g in got] == [(False, "reply is not a JSON object")] * 6


def test_founding_year_and_label(spark):
    df = spark.createDataFrame([(changed(), "1999"), (changed(metrics=None), "")], "r string, y string")
    record = R.validate(df["r"])
    metrics = R.with_founding_year(record["metrics"], df["y"])
    rows = df.select(
        metrics["founding_year"], R.coverage_label(metrics["geographic_coverage"])
    ).collect()
    assert [tuple(r) for r in rows] == [("1999", "Kyiv, Lviv"), (None, "?")]


def test_messages(spark):
    df = spark.createDataFrame([("context",)], "c string")
    made = df.select(R.messages("rules", df["c"])).first()[0]
    assert [(m["role"], m["content"]) for m in made] == [("system", "rules"), ("user", "context")]


def test_as_json(spark):
    df = spark.createDataFrame([(changed(),)], "r string")
    text = df.select(R.as_json(R.validate(df["r"])["audience"])).first()[0]
    assert json.loads(text) == VALID["audience"]
