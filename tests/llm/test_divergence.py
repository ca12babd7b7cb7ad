"""Source divergence against its DuckDB twin, and the accumulator against plain sums."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from titlemill.llm import divergence
from titlemill.llm.queries import SOURCE_DIVERGENCE_SQL

SCHEMA = "doc_id long, text string, lang string, source string, part string, rank string"


def fixture():
    draw = random.Random(2)
    vocab = ["Alpha", "beta", "GAMMA", "délta", "eps", "zeta", "ETA", "theta", "x", "naïve", "日本"]
    rows = []
    for i in range(80):
        text = " ".join(draw.choice(vocab[: draw.randint(3, len(vocab))]) for _ in range(draw.randint(0, 25)))
        rows.append((i, text + " 12,ab_cd", ["en", "fr"][i % 2], ["s1", "s2", "s3", None][i % 4], "x", "y"))
    rows += [
        (100, None, "en", "s1", None, None), (101, "", None, None, None, None), (102, "Alpha beta", None, "s9", None, None),
        (103, "only once", "de", "a", None, None), (104, "only twice", "de", "b", None, None),  # a lang that keeps no term
        (105, "one source " * 3, "it", "s", None, None), (105, "one source " * 3, "it", "s", None, None),
        (106, "one source", "it", "s", None, None), (107, "a" * 5000, "en", "s2", None, None),
    ]
    return rows


def oracle(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "part", "rank"]))
    return sorted(map(tuple, con.execute(SOURCE_DIVERGENCE_SQL).fetchall()))


def test_matches_sql(spark):
    rows = fixture()
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == oracle(rows)
    parts = {(r["lang"], r["part"]) for r in got}
    assert ("de", "pair") in parts and not any(r["value"] for r in got if r["lang"] == "de")  # no kept term: zeros
    assert ("it", "pair") not in parts  # one source has no peer
    assert all(r["rank"] <= divergence.TOP_TERMS for r in got if r["part"] == "term")


def test_terms_are_summed_in_the_task(spark, monkeypatch):
    rows = fixture()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("coalesce(lang, '') lang", "coalesce(source, '') source", "coalesce(text, '') text").coalesce(1)
    want = {}
    for i, r in enumerate(rows):
        found = re.findall(divergence.TERM, r[1] or "")
        for t in ("".join(c.lower() if c.isascii() else c for c in w) for w in found):
            c, d = want.setdefault((r[2] or "", r[3] or "", t), (Counter(), set()))
            c[t] += 1
            d.add(i)
    got = divergence.term_counts(docs).collect()
    assert len(got) == len(want)  # one row per group and term of a task, not one per text and term
    assert {(r["lang"], r["source"], r["term"]): (r["c"], r["d"]) for r in got} == {k: (c[k[2]], len(d)) for k, (c, d) in want.items()}
    monkeypatch.setattr(divergence, "COUNTED", 5)  # emitted often, the sums stay whole
    assert sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()) == oracle(rows)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_accumulator_in_small_chunks(monkeypatch):
    draw = np.random.default_rng(3)
    size, n_terms = 5, 40
    base = draw.integers(1, 1000, size)
    dense = np.tile(base, (n_terms, 1))
    posts = []
    for t in range(n_terms):
        for g in range(size):
            if draw.random() < 0.4:
                dense[t, g] = draw.integers(1, 5000)
                posts.append((f"t{t}", g, dense[t, g]))
    postings = pd.DataFrame(posts, columns=["term", "g", "p"]).assign(lang="en")
    peers = pd.DataFrame({"peer": range(size), "b": base})
    monkeypatch.setattr(divergence, "CELLS", 7)  # a few terms per chunk
    got = divergence.accumulate(postings, peers)
    acc = np.zeros((size, size), dtype=np.int64)
    acc[got["g"], got["h"]] = got["partial"]
    touched = sorted({t for t, _, _ in posts})
    for g in range(size):
        for h in range(size):
            if g != h:
                rows = [int(t[1:]) for t in touched]
                want = sum((dense[t, g] - dense[t, h]) ** 2 // dense[t, h] - (base[g] - base[h]) ** 2 // base[h] for t in rows)
                assert acc[g, h] == want
