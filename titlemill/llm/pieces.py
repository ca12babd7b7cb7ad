"""SentencePiece encoding and decoding with a prefix table (operator 3)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, whole_text

MARK = "▁"
#: Distinct words whose ids a task remembers before it starts anew; bounds its memory.
REMEMBERED = 400_000


class PrefixTable:
    """Merge-type encoder: the last piece of every prefix is unique and found by local tests.

    A piece that ends at a prefix is its last piece exactly if it is compatible with the last piece
    of what stands before it, that is if merging both together leaves both whole. The ids are then
    read backwards. Blanks join no piece from the left, so the work is done word by word.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if byte[i]}
        plain = [i for i in range(size) if not special[i] and not byte[i]]
        self.ids = {self.pieces[i]: i for i in plain}
        self.blank_runs = {len(p): i for p, i in self.ids.items() if not p.strip(MARK)}
        joined = [p for p in self.ids if p.strip(MARK) and MARK in p[1:]]
        ranked = sorted((p for p in self.ids if p.strip(MARK)), key=lambda p: -model.get_score(self.ids[p]))
        scores = [model.get_score(self.ids[p]) for p in ranked]
        odd = joined or len(set(scores)) < len(scores) or any(c not in self.ids for p in self.ids for c in p)
        if odd or len(self.byte_ids) != 256 or 1 not in self.blank_runs:
            raise ValueError("the model is not a merge model with byte fallback, distinct scores and marks in front")
        self.rank = {p: r for r, p in enumerate(ranked)}
        self.known = {p for p in self.ids if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p in [*self.rank, MARK]:
            self.automaton.add_word(p, self.ids[p])
        self.automaton.make_automaton()
        self.bytes = [
            bytes([int(p[3:5], 16)]) if byte[i] else b"" if special[i] else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.spines: dict[str, tuple | None] = {}
        self.whole: dict[int, bool] = {}
        # per piece, and last for the start of a run: may another piece follow it?
        self.follows: list[dict[int, bool]] = [{} for _ in range(size + 1)]
        self.held = 0
        self.sizes = [len(p) for p in self.pieces]

    def spine(self, piece: str) -> tuple | None:
        """Symbols at the right and at the left edge of `piece` while it is merged, each with the
        rank of the merge that ends it; None if merging its characters does not give the piece."""
        if piece not in self.spines:
            symbols, right, left = list(piece), [], []
            while len(symbols) > 1:
                found = [self.rank.get(a + b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
                best = min((r for r in found if r >= 0), default=-1)
                if best < 0:
                    break
                at = found.index(best)
                if at == 0:
                    left.append((symbols[0], best))
                if at == len(symbols) - 2:
                    right.append((symbols[-1], best))
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            top = (piece, len(self.rank))
            self.spines[piece] = ([*right, top], [*left, top]) if len(symbols) == 1 else None
        return self.spines[piece]

    def compatible(self, first: str, second: str) -> bool:
        """Does merging both together leave a boundary between them?

        The edge symbols on both sides change over time. A merge across the boundary happens if its
        rank comes before both present symbols end; of equal ranks the leftmost goes first.
        """
        right, left = self.spine(first)[0], self.spine(second)[1]
        i = j = 0
        while True:
            across = self.rank.get(right[i][0] + left[j][0])
            if across is not None and across < right[i][1] and across <= left[j][1]:
                return False
            if i == len(right) - 1 and j == len(left) - 1:
                return True
            if j == len(left) - 1 or i < len(right) - 1 and right[i][1] <= left[j][1]:
                i += 1
            else:
                j += 1

    def fits(self, before: int, own: int) -> bool:
        """Can piece `own` follow piece `before`, or begin a run if that is -1?"""
        if own not in self.whole:
            self.whole[own] = self.spine(self.pieces[own]) is not None
        good = self.whole[own] and (before < 0 or self.compatible(self.pieces[before], self.pieces[own]))
        if self.held > 4 * REMEMBERED:
            for known in self.follows:
                known.clear()
            self.held = 0
        self.follows[before][own] = good
        self.held += 1
        return good

    def run(self, text: str) -> list[int]:
        """Ids of known characters. Matches come by their end, so shorter prefixes are settled."""
        last = [-1] * (len(text) + 1)
        follows, sizes = self.follows, self.sizes
        for end, own in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                before = last[end - sizes[own]]
                good = follows[before].get(own)
                if good or good is None and self.fits(before, own):
                    last[end] = own
        ids, end = [], len(text)
        while end:
            own = last[end]
            ids.append(own)
            end -= sizes[own]
        return ids[::-1]

    def blanks(self, count: int) -> list[int]:
        """Marks alone merge last, all with one score: always the leftmost pair that has a piece."""
        runs: list[int] = []
        for _ in range(count):
            runs.append(1)
            while len(runs) > 1 and runs[-2] + runs[-1] in self.blank_runs:
                last = runs.pop()
                runs[-1] += last
        return [self.blank_runs[r] for r in runs]

    def word(self, key: str) -> list[int]:
        """Ids of some blanks followed by a word, which may be missing."""
        blanks = len(key) - len(key.lstrip(" "))
        text, ids = MARK + key[blanks:], []
        if self.known.issuperset(text):
            ids = self.run(text)
        else:
            for known, run in groupby(text, self.known.__contains__):
                part = "".join(run)
                ids += self.run(part) if known else [self.byte_ids[b] for b in part.encode()]
        lone = ids[0] == self.blank_runs[1]  # the mark joins the blanks if it joins no word
        return self.blanks(blanks) + ids[1:] if lone else self.blanks(blanks - 1) + ids


WORDS = re.compile(" +[^ ]*")


def _encoder(table: PrefixTable):
    """texts -> for each the number of ids, the ids joined by commas, the decoded text."""
    names = [str(i) for i in range(len(table.pieces))]
    known: dict[str, tuple[int, str, bytes]] = {}

    def encode(texts: list[str]) -> list[tuple[int, str, str]]:
        cut = [WORDS.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
        for key in set().union(*cut).difference(known):
            ids = table.word(key)
            known[key] = (len(ids), ",".join([names[i] for i in ids]), b"".join([table.bytes[i] for i in ids]))
        result = []
        for keys in cut:
            counts, ids, parts = zip(*map(known.__getitem__, keys), strict=True) if keys else ((), (), ())
            back = b"".join(parts).decode("utf-8", "replace")
            result.append((sum(counts), ",".join(ids), back.removeprefix(" ")))
        return result

    return encode


def encode_decode(docs: DataFrame, model: str, digests: bool = True) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, n_tokens and the ids and decoded text, or digests.

    With `digests`: ids_sha256 (decimal ids joined by commas) and decoded_sha256 in place of ids
    (array<int>) and decoded. `model` is the path of a merge model with byte fallback, readable on
    every executor. A null or empty text has no ids and decodes to the empty text; a null doc_id
    stays null; each repeated row gives a row; other columns are ignored; no row gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(PrefixTable(model))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in blocks(batches, "text"):
            counts, ids, decoded = [], [], []
            for n, joined, back in encode(batch.column(1).to_pylist()):
                counts.append(n)
                ids.append(sha(joined) if digests else [int(i) for i in joined.split(",") if i])
                decoded.append(sha(back) if digests else back)
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, id_column), pa.array(decoded, pa.string())],
                names=names,
            )

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    id_column = pa.string() if digests else pa.list_(pa.int32())
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = [id_type, "long", "string" if digests else "array<int>", "string"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return docs.select(F.col("doc_id"), whole_text().alias("text")).mapInArrow(run, schema)
