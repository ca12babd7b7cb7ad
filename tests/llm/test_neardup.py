"""Parts of the near-duplicate search against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from titlemill.llm import neardup


def tuples(text, width):
    found = text.encode().lower().split()
    width = min(width, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1)) if found else frozenset()


def near_copies(seed, rows, count, edits):
    draw = random.Random(seed)
    base = [f"word{draw.randrange(5000)}" for _ in range(count)]
    texts = []
    for _ in range(rows):
        own = list(base)
        for _ in range(draw.randint(0, edits)):
            own[draw.randrange(count)] = f"edit{draw.randrange(5000)}"
        texts.append(" ".join(own))
    return texts


def test_each_set_is_compared_in_one_cluster(spark, monkeypatch):
    """Trees part a group of near copies differently; its full sets are moved once all the same."""
    rows = list(enumerate(near_copies(1, 60, 120, 8)))
    seen, real = [], neardup.links

    def spy(compared, *args):
        seen.extend(bytes(r["sid"]) for r in compared.select("sid").collect())
        return real(compared, *args)

    monkeypatch.setattr(neardup, "links", spy)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = [tuples(t, 3) for _, t in rows]
    assert set(Counter(seen).values()) == {1} and len(seen) <= len(set(sets))
    parent = list(range(len(rows)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 85 * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: root(i) for i in range(len(rows))}


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("width", [1, 3, 5])
def test_shingles_of_a_block(kind, width):
    """Empty texts, other blanks than ASCII ones, null bytes, words of any length; a slice of a column."""
    draw = random.Random(2)
    signs = ["a", "B", "Z", "[", "@", "é", "É", "İ", " ", " ", "\t", "\n", "\x0b", "\r", "\x1c", "\x00", "\xa0", "ab", "中"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.choice([0, 1, 2, 5, 40, 300]))) for _ in range(400)]
    texts += ["", " ", "one", " one ", "ONE", "a\x00", "a", *("x" * n for n in range(1, 140)), f"{'y' * 64} {'y' * 65} a", ""]
    tokens, sizes = neardup.shingles(pa.array(["not read", *texts, "nor this"], kind)[1:-1], width)
    assert sizes.tolist() == [len(tuples(t, width)) for t in texts] and sizes.sum() == len(tokens)
    names, ends = {}, np.cumsum(sizes)
    for text, size, end in zip(texts, sizes, ends, strict=True):
        own = tokens[end - size : end]
        assert (own[1:] > own[:-1]).all()
        assert names.setdefault(tuples(text, width), own.tobytes()) == own.tobytes()
    assert len(set(names.values())) == len(names)
    none, empty = neardup.shingles(pa.array([], kind), width)
    assert len(none) == len(empty) == 0


@pytest.mark.parametrize("many", [2, 9, 300])
def test_overlaps(many):
    """Tokens that most sets have, some have, and one has only."""
    draw = random.Random(many)
    base, rare = ([draw.getrandbits(64) for _ in range(n)] for n in (150, 2 * many))
    sets = [
        {t for t in base if draw.random() < 0.8} | set(draw.sample(rare, 4)) | {draw.getrandbits(64) for _ in range(draw.randint(0, 9))}
        for _ in range(many)
    ]
    flat = np.concatenate([np.array(sorted(s), dtype=np.uint64) for s in sets])
    overlap = neardup.Overlaps(flat, np.array([len(s) for s in sets]))
    for at in (0, many // 2, many - 1):
        rest = [i for i in range(many) if i != at and draw.random() < 0.9] or [1 - min(at, 1)]
        assert overlap(at, np.array(rest)).tolist() == [len(sets[at] & sets[i]) for i in rest]


def test_a_text_of_one_block(spark, monkeypatch):
    """Texts over the size of a block, and blocks of one text, give the same components."""
    rows = list(enumerate([*near_copies(3, 6, 90, 3), *near_copies(4, 4, 400, 9), None, "", "two words", "Two  words"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {tuple(r) for r in neardup.near_duplicates(df).collect()}
    monkeypatch.setattr(neardup, "SHINGLED", 100)
    assert {tuple(r) for r in neardup.near_duplicates(df).collect()} == whole
    assert {r[3] for r in whole if r[0] >= 12} == {12}
