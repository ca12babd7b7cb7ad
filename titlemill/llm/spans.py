"""Substring dedup by sliding sentence spans (operator 4)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, stored, whole_text

#: Fewest sentences and words of a span: one starts at each sentence and is as short as both allow.
SPAN = 2
LEAST_WORDS = 10
#: Sentences of more words are cut where their words say so, and after so many words at the latest,
#: so that a long one has spans too, and a passage in it the same ones at any offset.
LONGEST = 24
#: A cut comes after a word whose hash with the next word is the least of so many on either side.
REACH = 6
END = re.compile(r"[.!?]+\s+|\n\s*")
WORD = re.compile(r"\S+\s*")


def sentences(text: str) -> list[str]:
    """Sentences with the blanks that follow them; joined they are the text."""
    found, begin = [], 0
    for match in END.finditer(text):
        found.append(text[begin : match.end()])
        begin = match.end()
    found.append(text[begin:])
    return [
        part
        for s in found
        if s
        for part in ([s] if s.count(" ") < LONGEST or len(s.split()) <= LONGEST else _pieces(s))
    ]


def _pieces(sentence: str) -> list[str]:
    found = WORD.findall(sentence)
    lead = sentence[: len(sentence) - len(sentence.lstrip())]
    own = [xxhash.xxh32_intdigest(w) for w in sentence.split()]
    pairs = [a * 0x9E3779B1 + b & 0xFFFFFFFF for a, b in zip(own, own[1:])]
    parts, begin = [], 0
    for at, value in enumerate(pairs, 1):
        # of equal pairs within reach the first cuts; words that repeat so soon are cut by count
        if at - begin == LONGEST or (
            value < min(pairs[max(at - 1 - REACH, 0) : at - 1], default=1 << 32) and value == min(pairs[at - 1 : at + REACH])
        ):
            parts.append("".join(found[begin:at]))
            begin = at
    parts.append("".join(found[begin:]))
    return [lead + parts[0], *parts[1:]]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def runs(lengths: list[int]) -> list[tuple[int, int]]:
    """First and last-but-one sentence of every span, for sentences of so many words; the last
    sentence of a text ends one in any case."""
    found, end, held = [], 0, 0
    for at, own in enumerate(lengths):
        while end < len(lengths) and (held < LEAST_WORDS or end - at < SPAN):
            held += lengths[end]
            end += 1
        if held < LEAST_WORDS or end - at < SPAN:
            break
        found.append((at, end))
        held -= own
    if found and found[-1][1] < len(lengths):
        found.append((found[-1][0], len(lengths)))
    return found


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id, _hash, number of sentences and the spans (two hash halves, place) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("at", pa.int32()), ("end", pa.int32())]))
        for batch in blocks(batches, "text"):
            counts, spans = [], []
            for text in batch.column(2).to_pylist():
                bodies = [s.split() for s in sentences(text)]
                own = []
                for at, end in runs([len(b) for b in bodies]):
                    value = xxhash.xxh3_128_intdigest("\n".join(map(" ".join, bodies[at:end])))
                    own.append({"a": _signed(value >> 64), "b": _signed(value & (1 << 64) - 1), "at": at, "end": end})
                counts.append(len(bodies))
                spans.append(own)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(spans, kind)],
                names=["doc_id", "_hash", "n_sentences", "spans"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64(whole_text()).alias("_hash"), whole_text().alias("text"))
    schema = f"doc_id {id_type}, _hash long, n_sentences long, spans array<struct<a:long,b:long,at:int,end:int>>"
    return narrow.mapInArrow(run, schema)


def repeated_sentences(docs: DataFrame) -> DataFrame:
    """_doc, _of (text hash), _gone: sentences covered by a span that is not the first of its kind."""
    table = stored(spans_of(docs), "spans")
    rows = table.select("doc_id", "_hash", F.explode("spans").alias("s")).select("doc_id", "_hash", "s.a", "s.b", "s.at", "s.end")
    # partial aggregation first: a span in a third of all rows arrives as one row per task
    first = stored(
        rows.groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash", "at")).alias("first"))
        .where(F.col("n") > 1)
        .select(F.col("a").alias("_a"), F.col("b").alias("_b"), "first"),
        "repeated",
    )
    found = rows.join(first, (rows["a"] == first["_a"]) & (rows["b"] == first["_b"]))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_hash") == F.col("first._hash")) & (F.col("at") == F.col("first.at"))
    return found.where(~same).groupBy(F.col("doc_id").alias("_doc"), F.col("_hash").alias("_of")).agg(
        F.collect_set(F.struct("at", "end")).alias("_gone")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, n_sentences, n_removed, kept_text.

    A span starts at each sentence and runs over SPAN sentences and LEAST_WORDS words, or as many
    more sentences as that takes; spans are compared by 128-bit hash with blanks evened out. The first of equal spans, by doc_id and then place, stays; sentences that any
    other one covers go. Sentences end at . ! ? before a blank, or at a line end, and within
    long ones at places that the words around them set. A null or empty
    text has no sentence and stays empty; a null doc_id comes last in order; equal rows share the
    fate of the first; other columns are ignored; no row gives no row.
    """
    gone = repeated_sentences(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            total, removed, kept = [], [], []
            for text, cut in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = sentences(text)
                out = {i for g in cut or () for i in range(g["at"], g["end"])}
                total.append(len(parts))
                removed.append(len(out))
                kept.append("".join(p for i, p in enumerate(parts) if i not in out) if out else text)
            yield pa.record_batch(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_sentences", "n_removed", "kept_text"],
            )

    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("_hash", F.xxhash64("text"))
    joined = keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["_doc"]) & (keyed["_hash"] == gone["_of"]), "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "_gone").mapInArrow(
        run, f"doc_id {id_type}, n_sentences long, n_removed long, kept_text string"
    )
