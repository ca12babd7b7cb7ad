"""Token counts by rank-synchronous merging of ragged numpy arrays (operator 8)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, whole_text

# The split of texts before merging, and the byte alphabet's printable ranges.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
PRINTABLE = ((33, 126), (161, 172), (174, 255))
#: Distinct pre-tokens whose counts a task remembers before it starts anew; bounds its memory.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next above 255."""
    own = {b for low, high in PRINTABLE for b in range(low, high + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Merge ranks of a byte-level vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = len(ids) + 1
        left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self.none = len(pairs)
        self.first = np.array([ids[c] for c in byte_symbols()], dtype=np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", ()) if t.get("special")]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols that survive in each non-empty piece.

        All pieces lie in one flat array. Each round finds every piece's lowest pair rank, merges
        all its pairs of that rank at once (of overlapping ones every other, from the left), and
        retires pieces without a pair.
        """
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        result = lengths.copy()
        symbols = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        ranks = np.full(len(symbols), self.none)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            lowest = np.minimum.reduceat(ranks, starts)
            live = lowest < self.none
            result[piece[starts[~live]]] = sizes[~live]
            if not live.all():
                keep = np.repeat(live, sizes)
                symbols, piece, ranks = symbols[keep], piece[keep], ranks[keep]
                lowest, sizes = lowest[live], sizes[live]
                if not len(symbols):
                    break
            hit = ranks == np.repeat(lowest, sizes)
            follows = np.r_[False, hit[:-1]] & hit
            run_start = np.maximum.accumulate(np.where(hit & ~follows, np.arange(len(hit)), 0))
            hit &= (np.arange(len(hit)) - run_start) % 2 == 0
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, piece, ranks = symbols[keep], piece[keep], ranks[keep]
            made = np.flatnonzero(hit[keep])
            for touched in (made, made[made > 0] - 1):
                last = (touched + 1 == len(piece)) | (piece[np.minimum(touched + 1, len(piece) - 1)] != piece[touched])
                ranks[touched[last]] = self.none
                pair = touched[~last]
                ranks[pair] = self.rank(symbols[pair], symbols[pair + 1])
        return result


def _counter(path: str):
    table = MergeTable(path)
    find = regex.compile(PRE_TOKEN).findall
    special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        cut = [special.split(t) if special else [t] for t in texts]
        found = [[find(part) for part in parts] for parts in cut]
        new = list({p for parts in found for part in parts for p in part if p not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({p for parts in found for part in parts for p in part})
        if new:
            known.update(zip(new, table.counts([p.encode() for p in new]).tolist(), strict=True))
        get = known.__getitem__
        return [len(parts) - 1 + sum(sum(map(get, part)) for part in parts) for parts in found]

    return count


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, n_bytes, n_tokens, over_limit; one row per row.

    `tokenizer` is the path of a byte-level .json file that every executor can read. Counts are
    those of whole texts without added tokens; a special token's string inside a text counts as
    that token. A null or empty text has 0 bytes and tokens; a null doc_id stays null; repeated
    rows are counted each; other columns are ignored; an empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in blocks(batches, "text"):
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(count(batch.column(1).to_pylist()), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    text = whole_text()
    narrow = docs.select(F.col("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = narrow.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
