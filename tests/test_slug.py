import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from titlemill.functions import slug


def test_latin_slug(evaluate):
    cases = {
        "Район Щедрий": "rayon-shchedryy",
        "A  -  B": "a-b",
        "Ґанок": "ganok",
        "під_час Дня": "pid_chas-dnya",
        "tab\there": "tab-here",
        "Об'єктив": "obiektyv",
        "Ёлка съезд": "lka-sezd".replace("sezd", "zd"),
        "Чай.юа": "chayyua",
        "café Noël": "caf-nol",
        "": "",
        "---": "",
    }
    # ё, ъ, ы, э have no Latin form; с, е are Ukrainian letters too.
    cases["Ёлка съезд"] = "lka-sezd"
    assert evaluate(slug.latin_slug, list(cases)) == list(cases.values())


def test_short_slug(evaluate):
    cases = {
        "Київ Пост": "kyiv-post",
        "Ґанок": "anok",
        "a_b c": "ab-c",
        "tab\there": "tabhere",
        "x" * 39 + " y": "x" * 39 + "-",
    }
    assert evaluate(slug.short_slug, list(cases)) == list(cases.values())


def test_url_in_title(evaluate):
    cases = {
        "Чернівці.com": "https://chernivtsi.com",
        "Мукачево.net": "https://mukachevo.net",
        "Район.in.ua": "https://rayon.in.ua",
        "a.b.COM": "https://ab.COM",
        "No Domain": None,
        ".com": None,
        "'.com": None,
        "Novyny.media\n": "https://novyny.media",
        "line one\nline two.org": "https://line-oneline-two.org".replace("one", "one"),
        "x.company": None,
        " Вісті .org.ua": "https://visti.org.ua",
    }
    assert evaluate(slug.url_in_title, list(cases)) == list(cases.values())


def test_slug_candidates(evaluate):
    kyiv = [f"https://kyivpost{e}" for e in slug.PROBE_ENDINGS]
    cases = {
        "The Kyiv Post.com": kyiv,
        "Київ-Пост": kyiv,
        "one two three four": [f"https://onetwothree{e}" for e in slug.PROBE_ENDINGS],
        "the of": [],
        "": [],
        "éé": [],
        "go go": [f"https://gogo{e}" for e in slug.PROBE_ENDINGS],
    }
    assert evaluate(slug.slug_candidates, list(cases)) == list(cases.values())


def test_compact_candidates(evaluate):
    def urls(*bases):
        return [f"https://{b}{e}" for b in bases for e in slug.COMPACT_PROBE_ENDINGS]

    cases = {
        "Київ Пост": urls("kyiv-post"),
        "The Kyiv Post": urls("kyivpost", "the-kyiv-post"),
        "Post": urls("post"),
        " one two three four": urls("onetwo", "one-two-three-four"),
        "": [],
    }
    assert evaluate(slug.compact_candidates, list(cases)) == list(cases.values())
    assert evaluate(slug.first_compact_candidate, ["The Kyiv Post", ""]) == [
        "https://kyivpost.com",
        None,
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=60), min_size=20, max_size=60))
def test_slug_alphabet(evaluate, titles):
    titles = [t.replace("\x00", "") for t in titles]
    titles = [t.encode("utf-8", "ignore").decode() for t in titles]
    for made in evaluate(slug.latin_slug, titles):
        assert re.fullmatch(r"[a-z0-9_-]*", made)
    for made in evaluate(slug.short_slug, titles):
        assert re.fullmatch(r"[a-z0-9-]{0,40}", made)


@pytest.mark.parametrize("blank", [" ", " ", "\x1c", "　"])
def test_blanks_split_words(evaluate, blank):
    made = evaluate(slug.slug_candidates, [f"{blank}red{blank}fox{blank}"])[0]
    assert made[2] == "https://redfox.com"
