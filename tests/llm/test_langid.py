"""Language ID against a plain-Python model of the same rule, with nulls, repeats and odd rows."""

import math
import random
import zlib
from collections import Counter

import pytest
import regex

from titlemill.llm import langid

SCHEMA = "doc_id long, text string, lang string, source string, extra string"
ALPHABETS = {"aa": "abcde", "bb": "fghij", "cc": "klmnoé"}


def sentence(draw, letters, count):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(1, 6))) for _ in range(count))


def corpus():
    draw = random.Random(5)
    rows = []
    for i in range(60):
        lang = list(ALPHABETS)[i % 3]
        rows.append((i, sentence(draw, ALPHABETS[lang], draw.randint(3, 30)), lang, "s", "x"))
    rows += [
        (100, None, "aa", None, None), (101, "", "bb", "s", None), (102, "123 !!", None, "s", None),
        (103, "zzz qqq", None, None, None), (104, "abc fgh", "aa", "t", None), (104, "abc fgh", "aa", "t", None),
        (None, "klm nop", "cc", None, None), (105, "ÄBCDE abcde", None, "s", None), (106, "a" * 3000, None, "s", None),
    ]
    return rows


def brute(rows):
    words = lambda t: regex.findall(r"\p{L}+", (t or "").lower())
    learned = [r for r in rows if r[2] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    wc = Counter((w, r[2]) for r in learned for w in words(r[1]))
    gc = Counter()
    for (w, lang), c in wc.items():
        for n in range(1, langid.NGRAM + 1):
            p = w if n == 1 else f" {w} "
            for i in range(len(p) - n + 1):
                gc[(n, p[i:i + n], lang)] += c
    langs = sorted({lang for _, lang in wc}, key=lambda s: s.encode())
    v = [len({w for w, _ in wc})] + [len({g for m, g, _ in gc if m == n}) for n in range(1, langid.NGRAM + 1)]
    total = {(lang, 0): sum(c for (w, la), c in wc.items() if la == lang) for lang in langs}
    for (n, g, lang), c in gc.items():
        total[(lang, n)] = total.get((lang, n), 0) + c
    floor = {(lang, n): -math.log(total[(lang, n)] + v[n]) for lang in langs for n in range(langid.NGRAM + 1)}
    known = {w for w, _ in wc}

    def unit(w):
        if w in known:
            return {lang: floor[(lang, 0)] + math.log(wc[(w, lang)] + 1) for lang in langs}
        for n in range(langid.NGRAM, 0, -1):
            p = w if n == 1 else f" {w} "
            gs = [p[i:i + n] for i in range(len(p) - n + 1)]
            if any((n, g, lang) in gc for g in gs for lang in langs):
                return {lang: floor[(lang, n)] + sum(math.log(gc[(n, g, lang)] + 1) for g in gs if (n, g, lang) in gc) / len(gs) for lang in langs}
        return {lang: 0.0 for lang in langs}

    out = {}
    for r in rows:
        ws = words(r[1])
        if not ws or not langs:
            out[(r[0], r[1])] = ("und", 0.0)
            continue
        s = {lang: sum(unit(w)[lang] for w in ws) for lang in langs}
        best = max(langs, key=lambda la: (s[la], [-b for b in la.encode()]))
        out[(r[0], r[1])] = (best, 1.0 / sum(math.exp(s[la] - s[best]) for la in langs))
    return out


def test_matches_brute_force(spark):
    rows = corpus()
    got = langid.predict(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    by_id = {(r[0]): r for r in rows}
    for g in got:
        text = by_id[g["doc_id"]][1] if g["doc_id"] is not None else "klm nop"
        lang, score = want[(g["doc_id"], text)]
        assert g["lang_pred"] == lang, g
        assert g["score"] == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert 0.0 <= g["score"] <= 1.0
        assert g["held_out"] == (g["doc_id"] is not None and zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2)


@pytest.mark.parametrize("entries", [0, 12])
def test_rare_entries_are_met_by_joins(spark, monkeypatch, entries):
    rows = [r for r in corpus() if r[0] is not None]
    monkeypatch.setattr(langid, "HOT_ENTRIES", entries)  # nothing, or a few words and grams, broadcast
    monkeypatch.setattr(langid, "SLICE_WORDS", 7)
    want = brute(rows)
    for g in langid.predict(spark.createDataFrame(rows, SCHEMA)).collect():
        lang, score = want[(g["doc_id"], next(r[1] for r in rows if r[0] == g["doc_id"]))]
        assert g["lang_pred"] == lang and g["score"] == pytest.approx(score, rel=1e-6, abs=1e-9), g


def test_edge_rows(spark):
    got = langid.predict(spark.createDataFrame(corpus(), SCHEMA)).collect()
    pred = {}
    for g in got:
        pred.setdefault(g["doc_id"], []).append(g)
    assert pred[100][0]["lang_pred"] == "und" and pred[100][0]["score"] == 0.0  # null text
    assert pred[101][0]["lang_pred"] == "und"  # empty text
    assert pred[102][0]["lang_pred"] == "und"  # no letter
    assert pred[103][0]["lang_pred"] in ALPHABETS  # letters unseen in training still get a learned lang
    assert len(pred[104]) == 2 and pred[104][0]["score"] == pred[104][1]["score"]  # repeated rows
    assert pred[None][0]["lang_pred"] == "cc"
    assert pred[106][0]["lang_pred"] == "aa"


def test_held_out_accuracy(spark):
    draw = random.Random(8)
    rows = [(i, sentence(draw, ALPHABETS[list(ALPHABETS)[i % 3]], 20), list(ALPHABETS)[i % 3], "s", None) for i in range(300)]
    got = {g["doc_id"]: g for g in langid.predict(spark.createDataFrame(rows, SCHEMA)).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert held and sum(got[r[0]]["lang_pred"] == r[2] for r in held) / len(held) >= 0.95


def test_empty_and_unlearned(spark):
    assert langid.predict(spark.createDataFrame([], SCHEMA)).count() == 0
    got = langid.predict(spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)).collect()
    assert [(g["lang_pred"], g["score"]) for g in got] == [("und", 0.0)]
