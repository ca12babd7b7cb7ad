"""Alignment of two tokenizations of the same bytes by diagonal run skipping (operator 11).

Tokenizer A (a byte-level BPE in a ``tokenizers`` .json file) encodes a blank and the text;
tokenizer B (a ``sentencepiece`` model, which adds the blank itself) encodes the text. Each token
covers the bytes it stands for: A's entry decoded byte-level, B's piece in UTF-8 with U+2581 as a
blank and ``<0xHH>`` as byte HH. Where both joined streams equal the blank and the text, the byte
offsets at which an A token and a B token both end cut the two streams into groups; the link of a
group pairs its last A token with its last B token, whose byte ranges end together.

The method: both tokenizations become arrays of end offsets. From the current pair of indexes,
exponential probing compares growing slices of the two arrays along the current diagonal (index
shift); a slice that agrees throughout is a stretch of one-to-one groups and is jumped at once.
At the first disagreement the group is resolved locally, each side advanced by binary search to
the other's end until the two meet, and the shift becomes the new difference of the indexes.

A single blank between two characters that are no white space always begins a token of both: A's
pattern starts a match there and looks no further back, and no piece of B has a mark inside. So a
text is cut at such blanks, and each distinct part is encoded and aligned once per task; groups and
links of a text are those of its parts in order. Where the two files do not allow this, or a part
does not round-trip, the whole text is encoded and aligned instead.

On Spark: texts are encoded and aligned in Arrow blocks of bounded bytes (`mapInArrow`); each
row keeps its distinct (A id, B id) link pairs with multiplicities. Corpus-wide pair counts and
each B id's highest count are group-bys with partial aggregation; they go back to the rows by a
join that splits hot pairs (`lookup`). Texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, stored, whole_text
from titlemill.llm.tokens import byte_symbols
from titlemill.operators.lookup import lookup

LINK_SCHEMA = "array<struct<a:int,b:int,m:long>>"
MARK = "▁"
#: Distinct parts, and characters in them, that a task remembers before it drops those met once.
REMEMBERED = 400_000
REMEMBERED_CHARS = 16 << 20
#: Where a text is cut: before a single blank between two characters that are no white space.
CUT = re.compile(r"(?<=\S)(?= \S)")
#: New parts that are encoded at a time.
TOGETHER = 128
#: Bits of a token id in a link's key.
ID_BITS = 20


@lru_cache(maxsize=2)
def _tokenizers(a_path: str, b_path: str):
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(a_path)
    a.encode_special_tokens = True  # special strings inside texts are plain text
    unbyte = {c: b for b, c in enumerate(byte_symbols())}
    a_bytes = [b""] * a.get_vocab_size(with_added_tokens=True)
    for entry, at in a.get_vocab(with_added_tokens=True).items():
        a_bytes[at] = bytes(unbyte[c] for c in entry) if all(c in unbyte for c in entry) else entry.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for at in range(b.get_piece_size()):
        piece = b.id_to_piece(at)
        if b.is_byte(at):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        elif b.is_control(at) or b.is_unknown(at):
            b_bytes.append(b"")
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    return a, a_bytes, [len(x) for x in a_bytes], b, b_bytes, [len(x) for x in b_bytes]


def groups(ends_a, ends_b) -> list[tuple[int, int]]:
    """(last A index, last B index) of every group, in order; both sequences rise strictly to one total.

    Diagonal run skipping: slices of 1, 2, 4, ... positions along the current diagonal are
    compared whole; a wholly equal slice is jumped, the first unequal position starts an irregular
    group resolved by binary search on both sides. Takes Python lists of ints: slices and searches
    run in C, with no per-call cost of an array library on runs of a few tokens.
    """
    out: list[tuple[int, int]] = []
    n_a, n_b = len(ends_a), len(ends_b)
    i = j = 0
    while i < n_a and j < n_b:
        width = 1
        while i < n_a and j < n_b:  # exponential probing along the diagonal j - i
            m = min(width, n_a - i, n_b - j)
            if ends_a[i:i + m] == ends_b[j:j + m]:
                out.extend(zip(range(i, i + m), range(j, j + m)))
                i, j, width = i + m, j + m, width * 2
                continue
            k = 0
            while ends_a[i + k] == ends_b[j + k]:  # the first unequal place, within this slice
                k += 1
            out.extend(zip(range(i, i + k), range(j, j + k)))
            i, j = i + k, j + k
            break
        if i >= n_a or j >= n_b:
            break
        end_a, end_b = ends_a[i], ends_b[j]
        while end_a != end_b:  # an irregular group: the side behind catches up
            if end_a < end_b:
                i = bisect_left(ends_a, end_b, i)
                end_a = ends_a[i]
            else:
                j = bisect_left(ends_b, end_a, j)
                end_b = ends_b[j]
        out.append((i, j))
        i, j = i + 1, j + 1
    return out


def align_text(text: str | None, tables) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """A ids, B ids and group ends of one text; no tokens where the text is null or empty, or
    where either joined stream differs from the blank and the text."""
    a, a_bytes, a_len, b, b_bytes, b_len = tables
    if not text:
        return [], [], []
    target = (" " + text).encode("utf-8", "surrogatepass")
    ids_a = a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids  # no offsets
    ids_b = b.encode(text)
    if b"".join(map(a_bytes.__getitem__, ids_a)) != target or b"".join(map(b_bytes.__getitem__, ids_b)) != target:
        return [], [], []
    sizes_a, sizes_b = list(map(a_len.__getitem__, ids_a)), list(map(b_len.__getitem__, ids_b))
    if 0 in sizes_a or 0 in sizes_b:
        return [], [], []  # an empty token would make ends ambiguous
    return ids_a, ids_b, groups(list(accumulate(sizes_a)), list(accumulate(sizes_b)))


def written(ids_a: list[int], ids_b: list[int], ends: list[tuple[int, int]]) -> list[str]:
    """``a1,a2|b1`` of each group: its A ids, then its B ids."""
    text_a, text_b, join = list(map(str, ids_a)), list(map(str, ids_b)), ",".join
    out, x, u = [], 0, 0
    for i, j in ends:
        if x == i and u == j:
            out.append(f"{text_a[i]}|{text_b[j]}")
        else:
            out.append(f"{join(text_a[x:i + 1])}|{join(text_b[u:j + 1])}")
        x, u = i + 1, j + 1
    return out


def digest(ids_a: list[int], ids_b: list[int], ends: list[tuple[int, int]]) -> str:
    """sha256 of the written groups joined by ``;``; '' without groups."""
    return hashlib.sha256(";".join(written(ids_a, ids_b, ends)).encode()).hexdigest() if ends else ""


def cuts_at_blanks(a_path: str, b_path: str) -> bool:
    """Do both files encode a text's parts as they encode the text, where it is cut by CUT?"""
    import sentencepiece

    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:
        return False
    with open(a_path, encoding="utf-8") as file:
        a = json.load(file)
    before, model = a["pre_tokenizer"] or {}, a["model"]
    plain_a = (
        a["normalizer"] is a["truncation"] is a["padding"] is None
        and before.get("type") == "ByteLevel" and before.get("use_regex") is True and before.get("add_prefix_space") is False
        and model.get("type") == "BPE" and not model.get("dropout") and all(t["special"] for t in a["added_tokens"])
    )
    b = sentencepiece_model_pb2.ModelProto()
    b.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=b_path).serialized_model_proto())
    norm, piece = b.normalizer_spec, b.SentencePiece
    plain_b = (
        b.trainer_spec.model_type == b.trainer_spec.BPE and not b.trainer_spec.treat_whitespace_as_suffix
        and not norm.precompiled_charsmap and not norm.normalization_rule_tsv
        and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        and all(p.type in (piece.NORMAL, piece.UNKNOWN, piece.CONTROL, piece.BYTE) for p in b.pieces)
        and not any(MARK in p.piece[1:] and p.piece.strip(MARK) for p in b.pieces)
    )
    return plain_a and plain_b and max(len(b.pieces), len(model["vocab"]) + len(a["added_tokens"])) < 1 << ID_BITS


def _edged(part: str) -> bool:
    """Does the plain split give a part whose blank CUT would not cut at?"""
    return not part or part[0].isspace() or part[-1].isspace()


def _places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), then those of begin[1], and so on."""
    return np.arange(int(count.sum())) + np.repeat(begin - np.cumsum(count) + count, count)


class Aligner:
    """Aligns texts, remembering the parts that lie between cuts."""

    def __init__(self, a_path: str, b_path: str):
        self.tables = _tokenizers(a_path, b_path)
        self.lengths = np.array(self.tables[2])
        self.by_part = cuts_at_blanks(a_path, b_path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.edged: set[str] = set()
        self.held = 0
        self.digests: list[str | None] = []  # None: the part does not round-trip
        self.odd = 0  # parts that do not
        self.sizes = np.zeros((0, 3), dtype=np.int64)  # A ids, B ids, groups
        self.keys = np.zeros(0, dtype=np.int64)  # a << ID_BITS | b of each part's links, part by part
        self.starts = np.zeros(1, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)

    def _drop(self) -> None:
        """Drops the parts met once since the last time, or all if too many remain."""
        keep, names = np.flatnonzero(self.uses > 1), list(self.known)
        known = {names[k]: i for i, k in enumerate(keep.tolist())}
        held = sum(map(len, known))
        if 2 * len(keep) > REMEMBERED or 2 * held > REMEMBERED_CHARS:
            self._forget()
            return
        counts = self.sizes[keep, 2]
        self.keys = self.keys[_places(self.starts[keep], counts)]
        self.known, self.held, self.digests = known, held, [self.digests[k] for k in keep.tolist()]
        self.edged = {p for p in self.edged if p in known}
        self.sizes, self.starts = self.sizes[keep], np.concatenate([[0], np.cumsum(counts)])
        self.uses = np.zeros(len(keep), dtype=np.int64)

    def _learn(self, parts: set[str], edged: bool) -> None:
        """Remembers `parts`: those that can stand side by side are aligned as texts made of them."""
        lone = list(filter(_edged, parts)) if edged else []
        plain = list(parts.difference(lone))
        sizes, keys = [self.sizes], [self.keys]
        for some in [*(plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)), *([p] for p in lone)]:
            todo = [some]
            while todo:
                own = todo.pop()
                made = self._together(own)
                if made is None and len(own) > 1:
                    todo += [[p] for p in own]
                    continue
                self.odd += made is None
                size, key, digests = made or (np.zeros((1, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), [None])
                self.known.update(zip(own, range(len(self.digests), len(self.digests) + len(own)), strict=True))
                self.held += sum(map(len, own))
                self.digests += digests
                sizes.append(size)
                keys.append(key)
        self.sizes, self.keys = np.concatenate(sizes), np.concatenate(keys)
        self.starts = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(self.sizes[:, 2])])

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]] | None:
        """Sizes, link keys and written groups of parts that make one text; None if it does not round-trip."""
        ids_a, ids_b, ends = align_text(" ".join(parts), self.tables)
        if not ends:
            return None
        texts, begin, digests = written(ids_a, ids_b, ends), 0, []
        ids_a, ids_b, last = np.array(ids_a), np.array(ids_b), np.fromiter(chain.from_iterable(ends), np.int64, 2 * len(ends)).reshape(-1, 2)
        edges = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        group_ends = np.cumsum(self.lengths[ids_a])[last[:, 0]]
        cuts = np.searchsorted(group_ends, edges, side="right")  # groups up to each part's end
        if not (group_ends[cuts - 1] == edges).all():
            return None  # a group lies over a part's end
        sizes = np.column_stack([last[cuts - 1] + 1, cuts])
        sizes[1:] -= sizes[:-1].copy()
        for end in cuts.tolist():
            digests.append(";".join(texts[begin:end]))
            begin = end
        return sizes, ids_a[last[:, 0]] << ID_BITS | ids_b[last[:, 1]], digests

    def _cut(self, texts: list[str]) -> tuple[list[list[str]], set[str], bool]:
        """The parts of each text, each without the blank in front, none of an empty text; the new
        ones; and whether white space may stand at the edge of one."""
        cut = [t.split(" ") if t else [] for t in texts]
        seen = set().union(*cut)
        new = seen.difference(self.known)
        self.edged.update(filter(_edged, new))
        edged = seen & self.edged
        if edged:
            cut = [p if edged.isdisjoint(p) else [c[1:] for c in CUT.split(" " + t)] for t, p in zip(texts, cut, strict=True)]
            new = set().union(*cut).difference(self.known)
        return cut, new, bool(edged)

    def _whole(self, text: str) -> tuple[tuple[int, int, int], str, np.ndarray]:
        ids_a, ids_b, ends = align_text(text, self.tables)
        keys = np.array([ids_a[i] << ID_BITS | ids_b[j] for i, j in ends], dtype=np.int64)
        return (len(ids_a), len(ids_b), len(ends)), digest(ids_a, ids_b, ends), keys

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Sizes (A ids, B ids, groups) and digest of each text, and of all links the text and the key."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self._drop()
        cut, new, edged = self._cut(texts) if self.by_part else ([[] for _ in texts], set(), False)
        if new:
            self._learn(new, edged)
        known, digests = self.known.__getitem__, self.digests.__getitem__
        sums, rows, alone = [], [], []
        for row, (text, parts) in enumerate(zip(texts, cut, strict=True)):
            at = list(map(known, parts))
            own = list(map(digests, at))
            if text and (not self.by_part or self.odd and None in own):
                alone.append(row)
                at, own = [], []
            rows.append(at)
            sums.append(hashlib.sha256(";".join(own).encode()).hexdigest() if own else "")
        lengths = np.array([len(at) for at in rows], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(rows), dtype=np.int64, count=int(lengths.sum()))
        of = np.repeat(np.arange(len(texts)), lengths)
        self.uses = np.bincount(flat, minlength=len(self.digests)) + np.pad(self.uses, (0, len(self.digests) - len(self.uses)))
        own = self.sizes[flat]
        before = np.concatenate([np.zeros((1, 3), dtype=np.int64), np.cumsum(own, axis=0)])
        ends = np.cumsum(lengths)
        sizes = before[ends] - before[ends - lengths]
        link_row, link_key = [np.repeat(of, own[:, 2])], [self.keys[_places(self.starts[flat], own[:, 2])]]
        for row in alone:
            sizes[row], sums[row], keys = self._whole(texts[row])
            link_row.append(np.full(len(keys), row))
            link_key.append(keys)
        return sizes, sums, np.concatenate(link_row), np.concatenate(link_key)


LINK_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("m", pa.int64())]))


def align_block(batch: pa.RecordBatch, aligner: Aligner) -> pa.RecordBatch:
    """Counts, digest and distinct links (a, b, m) of each text of a (doc_id, text) block."""
    sizes, sums, rows, keys = aligner([t or "" for t in batch.column(1).to_pylist()])
    # blocks have under 2^23 rows
    found, mult = np.unique(rows << 2 * ID_BITS | keys, return_counts=True)
    offsets = np.searchsorted(found, np.arange(batch.num_rows + 1) << 2 * ID_BITS)
    low = (1 << ID_BITS) - 1
    parts = [pa.array(found >> ID_BITS & low, pa.int32()), pa.array(found & low, pa.int32()), pa.array(mult, pa.int64())]
    links = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, ["a", "b", "m"]))
    return pa.record_batch(
        [batch.column(0), *[pa.array(sizes[:, k], pa.int64()) for k in range(3)], pa.array(sums, pa.string()), links.cast(LINK_TYPE)],
        names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
    )


def aligned_rows(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, groups_sha256 and its distinct links (a, b, m)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in blocks(batches, "text"):
            yield align_block(batch, aligner)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(F.col("doc_id"), whole_text().alias("text"))
    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, links {LINK_SCHEMA}"
    return narrow.mapInArrow(run, schema)


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """`docs` (doc_id, text, more) -> one row per row: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    A pair's count is the number of links in the whole table that join its A id to its B id;
    ``n_best`` counts the row's links whose count is the highest of any pair with its B id (ties
    all count), ``count_sum`` sums the counts of its links. Null, empty or not round-tripping
    texts give zeros and '' (unhashed). Repeated rows are each counted and each get a row; a null
    doc_id stays null; other columns are not read; an empty table gives an empty result.
    """
    rows = stored(aligned_rows(docs, a_path, b_path).withColumn("_rid", F.monotonically_increasing_id()), "alignment-rows")
    links = rows.select("_rid", F.explode("links").alias("l")).select("_rid", "l.a", "l.b", "l.m")
    pairs = links.groupBy("a", "b").agg(F.sum("m").alias("count"))
    best = pairs.groupBy("b").agg(F.max("count").alias("best"))
    stats = pairs.join(best, "b").select(F.col("a").alias("_a"), F.col("b").alias("_b"), "count", "best")
    per_row = (
        lookup(links, stats, [(F.col("a"), "_a"), (F.col("b"), "_b")], "inner")
        .groupBy("_rid")
        .agg(
            F.sum(F.col("m") * F.col("count")).alias("count_sum"),
            F.sum(F.when(F.col("count") == F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        )
    )
    return rows.join(per_row, "_rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
