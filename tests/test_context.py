from pyspark.sql import functions as F

from titlemill.functions import claims
from titlemill.functions import context as C


def test_site_context(spark):
    rows = [
        ("T", None, None, None, None, None),
        ("T", "t", "d", "about", "body", ["x", "y"]),
        ("T", "Official", "", "", "body", []),
        ("T", None, None, None, "b" * 7000, None),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, title string, official string, d string, about string, body string, cats array<string>",
    )
    made = C.site_context(*[F.col(c) for c in ("title", "official", "d", "about", "body", "cats")])
    got = [r[0] for r in df.orderBy("i").select(made).collect()]
    assert got[0] == "Outlet name: T"
    assert got[1] == (
        "Outlet name: T\nDescription: d\nAbout: about\nContent categories: x, y"
    )
    assert got[2] == "Outlet name: T\nOfficial name: Official\nContent: body"
    assert len(got[3]) == 6000


def test_route_context(spark):
    rows = [
        ("T", "u", "E", "wikipedia_uk", "S", "Outlet name: T\nWikipedia article:\nE"),
        ("T", "u", "E", "slug", "S", "Outlet name: T\nWikipedia article:\nE\n\nS"),
        ("T", "u", "E", "slug", "s" * 500, "s" * 500),
        ("T", "u", "", "slug", "S", "S"),
        ("T", None, "E", "none", None, "Outlet name: T\nWikipedia article:\nE"),
        ("T", "", None, "none", None, "Outlet name: T"),
        ("T", "u", "", "wikipedia_en", "S", "Outlet name: T"),
        ("T", "u", "e" * 6500, "wikipedia_en", "S", "Outlet name: T\nWikipedia article:\n" + "e" * 5900),
    ]
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, t string, u string, e string, s string, site string, want string",
    )
    made = C.route_context(*[F.col(c) for c in ("t", "u", "e", "s", "site")])
    for r in df.select("i", made.alias("have"), "want").collect():
        assert r["have"] == r["want"], r["i"]


def test_descriptions_and_about(spark):
    df = spark.createDataFrame(
        [("", None, "m", "ab", "a"), ("l", "o", "m", "a", "ab"), (None, "", "", "a", None)],
        "l string, o string, m string, about string, body string",
    )
    got = df.select(
        C.best_description(df["l"], df["o"], df["m"]), C.longer_about(df["about"], df["body"])
    ).collect()
    assert [tuple(r) for r in got] == [("m", "ab"), ("l", None), (None, "a")]


def test_claims(evaluate):
    def entity(claim, value):
        return '{"claims":{"%s":[{"mainsnak":{"datavalue":%s}}]}}' % (claim, value)

    sites = {
        entity("P856", '{"type":"string","value":"https://a.ua/"}'): "https://a.ua/",
        entity("P856", '{"type":"entity","value":"x"}'): None,
        '{"claims":{"P856":[]}}': None,
        '{"claims":{"P856":[{"mainsnak":{}},{"mainsnak":{"datavalue":{"type":"string","value":"x"}}}]}}': None,
        "{}": None,
        "broken": None,
    }
    assert evaluate(claims.official_website, list(sites)) == list(sites.values())
    years = {
        entity("P571", '{"type":"time","value":{"time":"+1999-01-01T00:00:00Z"}}'): "1999",
        entity("P571", '{"type":"time","value":{"time":"-0044-03-15T00:00:00Z"}}'): "-0044",
        entity("P571", '{"type":"string","value":"1999"}'): None,
        "{}": None,
    }
    assert evaluate(claims.founding_year, list(years)) == list(years.values())
