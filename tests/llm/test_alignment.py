"""Token alignment against a brute-force version: common end offsets by set intersection."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from titlemill.llm import alignment
from titlemill.llm.tokens import byte_symbols

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_a string, links string"


def texts():
    draw = random.Random(4)
    words = ["the", "tokenizer", "aligns", "bytes", "über", "naïve", "日本語", "x", "  ", "\n", "<|endoftext|>", "<s>", "123,456"]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    return [None, "", " ", "one", "two  words", prose(40), prose(40), prose(300), "a" * 3000, "ｆｕｌｌ ｗｉｄｔｈ", "é́", prose(2000)]


def brute_text(text):
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    unbyte = {c: i for i, c in enumerate(byte_symbols())}
    if not text:
        return [], [], []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    tok_a = [bytes(unbyte[c] for c in a.id_to_token(x)) for x in ids_a]
    tok_b = []
    for x in ids_b:
        p = b.id_to_piece(x)
        tok_b.append(bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode())
    target = (" " + text).encode()
    if b"".join(tok_a) != target or b"".join(tok_b) != target:
        return [], [], []
    ends_a = list(np.cumsum([len(t) for t in tok_a]))
    ends_b = list(np.cumsum([len(t) for t in tok_b]))
    common = sorted(set(ends_a) & set(ends_b))
    return ids_a, ids_b, [(ends_a.index(e), ends_b.index(e)) for e in common]


def brute(rows):
    per = [brute_text(r[1]) for r in rows]
    counts = Counter((ia[ea], ib[eb]) for ia, ib, ends in per for ea, eb in ends)
    best = Counter()
    for (x, y), c in counts.items():
        best[y] = max(best[y], c)
    out = []
    for r, (ia, ib, ends) in zip(rows, per, strict=True):
        links = [(ia[ea], ib[eb]) for ea, eb in ends]
        groups, sa, sb = [], 0, 0
        for ea, eb in ends:
            groups.append(",".join(map(str, ia[sa:ea + 1])) + "|" + ",".join(map(str, ib[sb:eb + 1])))
            sa, sb = ea + 1, eb + 1
        out.append((r[0], len(ia), len(ib), len(ends), len(links), sum(counts[k] == best[k[1]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ends else ""))
    return sorted(out, key=lambda t: (t[0] is None, t[0] or 0, t))


def test_matches_brute_force(spark):
    rows = [(i, t, "en", None, "x", "y") for i, t in enumerate(texts())] + [(None, "the bytes", None, None, None, None), (5, texts()[5], "en", None, None, None)]
    got = alignment.alignment(spark.createDataFrame(rows, SCHEMA), A, B).collect()
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(g[c] for c in cols) for g in got), key=lambda t: (t[0] is None, t[0] or 0, t)) == brute(rows)


def test_null_empty_and_empty_table(spark):
    got = {g["doc_id"]: g for g in alignment.alignment(spark.createDataFrame([(1, None, None, None, None, None), (2, "", None, None, None, None)], SCHEMA), A, B).collect()}
    for g in got.values():
        assert (g["n_a"], g["n_b"], g["n_groups"], g["n_links"], g["n_best"], g["count_sum"], g["groups_sha256"]) == (0, 0, 0, 0, 0, 0, "")
    assert alignment.alignment(spark.createDataFrame([], SCHEMA), A, B).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40))
def test_groups_are_the_common_ends(a, b):
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    total = max(ends_a[-1], ends_b[-1])
    ends_a[-1] = ends_b[-1] = total  # both streams cover the same bytes
    ends_a = np.unique(ends_a)
    ends_b = np.unique(ends_b)
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    want = [(int(np.searchsorted(ends_a, e)), int(np.searchsorted(ends_b, e))) for e in common]
    assert alignment.groups(ends_a.tolist(), ends_b.tolist()) == want


def odd_texts():
    draw = random.Random(9)
    words = ["the", "bytes,", "über", "日本語", "", " ", "\n", "\t", "x\n", "\ny", " ", "z　", "\x1c", "▁", "a▁b", "<s>", "<|endoftext|>", "1", "'s", "́"]
    return ["", " ", "  ", "\n", " x", "x ", "x\n", *(" ".join(draw.choices(words, k=draw.randint(1, 9))) for _ in range(400)),
            *(" ".join(f"w{draw.randint(0, 400)}" for _ in range(60)) for _ in range(40))]


def test_parts_give_what_whole_texts_give(monkeypatch):
    texts = odd_texts()
    for most in (400_000, 50):  # 50: parts are dropped and met again
        monkeypatch.setattr(alignment, "REMEMBERED", most)
        aligner = alignment.Aligner(A, B)
        assert aligner.by_part
        for begin in range(0, len(texts), 20):
            some = texts[begin:begin + 20]
            sizes, sums, rows, keys = aligner(some)
            for row, text in enumerate(some):
                size, own, links = aligner._whole(text)
                assert (tuple(sizes[row]), sums[row], sorted(keys[rows == row])) == (size, own, sorted(links)), repr(text)


def test_a_word_is_encoded_once_per_task(monkeypatch):
    aligner, seen = alignment.Aligner(A, B), []
    align_text = alignment.align_text
    monkeypatch.setattr(alignment, "align_text", lambda text, tables: seen.append(text) or align_text(text, tables))
    for _ in range(3):
        sizes, *_ = aligner(["the bytes of the text " * 50 + "end"] * 4)
        assert (sizes[:, 0] > 200).all()
    assert sum(map(len, seen)) < 40
