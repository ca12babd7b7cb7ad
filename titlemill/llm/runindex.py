"""Substring dedup with a run-length index of shared contexts (operator 1)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, stored, whole_text
from titlemill.operators.lookup import lookup

#: Bytes of a string that is removed where it also starts elsewhere.
LENGTH = 400
#: Bytes that anchor such a string: of all runs of so many bytes in it the one of least hash.
#: Equal strings have equal anchors, at the same place.
SEED = 128
LEVELS = SEED.bit_length() - 1
#: Long texts are anchored in chunks of window starts, which bounds memory and place bits.
CHUNK = 4 << 20
PLACE = np.uint64((1 << 24) - 1)
#: Bytes of contexts that one index holds, about; distinct contexts of an anchor that may share
#: one; window offsets per range of the way for anchors with more.
INDEX_BYTES = 1_500_000
LARGEST = 4096
RANGE = 16


def _byte_values() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes at each place, by doubling the hashed length."""
    values = _byte_values()[data]
    factors = np.random.default_rng(12).integers(1, 1 << 62, LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for level in range(LEVELS):
        step = 1 << level
        values = values[:-step] * factors[level] + values[step:]
        values ^= values >> np.uint64(29)
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(32))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows of LENGTH bytes with one anchor: first start, number, hash, place."""
    span = LENGTH - SEED + 1
    found: list[tuple] = []
    for base in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
        part = data[base : base + CHUNK + LENGTH - 1]
        hashes = seed_hashes(part)
        least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        place = (least & PLACE).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        counts = np.diff(np.r_[cuts, len(place)])
        found.append((cuts + base, counts, hashes[place[cuts]].view(np.int64), place[cuts] + base))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some contexts, with samples at run ends.

    Contexts end in terminators of their own, least of all symbols, ordered like the contexts. For
    each run of equal symbols in the transform, the text places at its two ends are kept, each
    with the length it shares with the neighbour outside the run. All other lengths follow while
    the text is streamed: inside a run, one place further shares one symbol less.
    """

    SYMBOLS = 7

    def __init__(self, contexts: list[bytes]):
        lengths = np.array([len(c) for c in contexts], dtype=np.int64)
        self.begins = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
        size = self.size = len(data)
        self.left = np.repeat(self.begins + lengths, lengths) - np.arange(size)  # bytes to the end
        owner = np.repeat(np.arange(len(contexts), dtype=np.int32), lengths)
        key = np.zeros(size, dtype=np.int64)
        for k in range(self.SYMBOLS):
            symbol = np.zeros(size, dtype=np.int64)
            symbol[: size - k] = data[k:].astype(np.int64) + 1
            symbol[self.left <= k] = 0
            key = (key << 9) | symbol
        ranks, reach = [], self.SYMBOLS
        order = np.argsort(key)
        rank = self._ranked(key, order)
        while True:
            ranks.append((reach, rank))
            if reach >= lengths.max() or rank.max() == size - 1:
                break
            second = np.empty(size, dtype=np.int64)
            inside = self.left > reach
            second[inside] = rank[np.flatnonzero(inside) + reach].astype(np.int64) + len(contexts)
            second[~inside] = owner[~inside]
            key = rank.astype(np.int64) * (size + len(contexts) + 1) + second
            order = np.argsort(key)
            rank = self._ranked(key, order)
            reach *= 2
        before = np.empty(size, dtype=np.int32)
        before[1:] = data[:-1]
        before[self.begins[lengths > 0]] = -1 - np.arange(len(contexts), dtype=np.int32)[lengths > 0]
        symbols = before[order]
        change = np.flatnonzero(symbols[1:] != symbols[:-1])
        self.run_symbols = symbols[np.r_[0, change + 1]]
        self.run_lengths = np.diff(np.r_[0, change + 1, size])
        self.first = (order[np.r_[0, change + 1]], np.r_[0, self._shared(order[change + 1], order[change], ranks, data)])
        self.last = (order[np.r_[change, size - 1]], np.r_[self._shared(order[change], order[change + 1], ranks, data), 0])

    @staticmethod
    def _ranked(key: np.ndarray, order: np.ndarray) -> np.ndarray:
        ordered = key[order]
        rank = np.empty(len(key), dtype=np.int32)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        return rank

    def _shared(self, a: np.ndarray, b: np.ndarray, ranks: list, data: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at `a` and `b`, within their contexts."""
        most = np.minimum(self.left[a], self.left[b])
        shared = np.zeros(len(a), dtype=np.int64)
        for reach, rank in [r for r in ranks[::-1] for _ in range(2)]:
            can = np.flatnonzero(shared + reach <= most)
            same = rank[np.minimum(a[can] + shared[can], self.size - 1)] == rank[np.minimum(b[can] + shared[can], self.size - 1)]
            shared[can[same]] += reach
        for _ in range(self.SYMBOLS):
            can = np.flatnonzero(shared < most)
            same = data[a[can] + shared[can]] == data[b[can] + shared[can]]
            shared[can[same]] += 1
        return shared

    def matching_statistics(self) -> np.ndarray:
        """For each place the longest match that starts at any other place."""
        result = np.zeros(self.size, dtype=np.int64)
        places = np.arange(self.size)
        for sampled, shared in (self.first, self.last):
            streamed = np.zeros(self.size, dtype=np.int64)
            streamed[sampled] = sampled + shared
            np.maximum(result, np.maximum.accumulate(streamed) - places, out=result)
        return result


def repeated_windows(contexts: list[bytes], copies: np.ndarray) -> list[tuple[int, int] | None]:
    """Per context the bytes covered by strings of LENGTH that start elsewhere too: from, to.

    All windows of a context lie around its anchor, so what they cover is one piece. A context
    that stands for several copies is covered whole.
    """
    if not contexts:
        return []
    index = RunIndex(contexts)
    long = index.matching_statistics() >= LENGTH
    result: list[tuple[int, int] | None] = []
    for begin, context, n in zip(index.begins.tolist(), contexts, copies.tolist(), strict=True):
        if n > 1:
            result.append((0, len(context)))
            continue
        starts = np.flatnonzero(long[begin : begin + len(context)])
        result.append((int(starts[0]), int(starts[-1]) + LENGTH) if len(starts) else None)
    return result


def anchored(docs: DataFrame) -> DataFrame:
    """doc_id, _hash and the anchors (key, context hash, start, bytes, anchor's place) of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("k", pa.int64()), ("c", pa.int64()), ("at", pa.int32()), ("len", pa.int32()), ("off", pa.int32())])
        for batch in blocks(batches, "data"):
            columns: list[list] = [[], [], [], [], []]
            ends = [0]
            for data in batch.column(2).to_pylist():
                start, count, key, place = anchors(np.frombuffer(data, dtype=np.uint8))
                size = count + (LENGTH - 1)
                begin, end = start.tolist(), (start + size).tolist()
                hashed = [xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(begin, end, strict=True)]
                for column, values in zip(
                    columns, (key, np.array(hashed, dtype=np.uint64).view(np.int64), start, size, place - start), strict=True
                ):
                    column.append(values)
                ends.append(ends[-1] + len(begin))
            flat = [np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in columns]
            rows = pa.StructArray.from_arrays([pa.array(f, t.type) for f, t in zip(flat, kind, strict=True)], fields=list(kind))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
            yield pa.record_batch([batch.column(0), batch.column(1), lists], names=["doc_id", "_hash", "anchors"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64(whole_text()).alias("_hash"), F.encode(whole_text(), "utf-8").alias("data"))
    return narrow.mapInArrow(
        run, f"doc_id {id_type}, _hash long, anchors array<struct<k:long,c:long,at:int,len:int,off:int>>"
    )


def _with_rows(docs: DataFrame, lists: DataFrame, columns: list[str], how: str) -> DataFrame:
    """`docs` joined to `lists` (_doc, _of, more) by id and text hash."""
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("_hash", F.xxhash64("text"))
    on = keyed["doc_id"].eqNullSafe(lists["_doc"]) & (keyed["_hash"] == lists["_of"])
    return keyed.join(lists, on, how).select("doc_id", F.encode("text", "utf-8").alias("data"), *columns)


def shared_contexts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """k, c, n, off, data: each distinct context of anchors with two or more, with its copies."""
    each = rows.groupBy("k", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "_hash", "at", "len", "off")).alias("of")
    )
    lists = each.groupBy(F.col("of.doc_id").alias("_doc"), F.col("of._hash").alias("_of")).agg(
        F.collect_list(F.struct("k", "c", "n", "of.at", "of.len", "of.off")).alias("wanted")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "data"):
            made = [
                (w["k"], w["c"], w["n"], w["off"], data[w["at"] : w["at"] + w["len"]])
                for data, wanted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                for w in wanted
            ]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            arrays = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.record_batch(arrays, names=["k", "c", "n", "off", "data"])

    return _with_rows(docs, lists, ["wanted"], "inner").mapInArrow(run, "k long, c long, n long, off int, data binary").dropDuplicates(["k", "c"])


def indexed_marks(contexts: DataFrame, total: int) -> DataFrame:
    """k, c, low, high: covered bytes of contexts, from one index per bucket of anchors."""
    buckets = max(1, -(-total // INDEX_BYTES))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["k", "c"], ignore_index=True)
        found = repeated_windows([bytes(d) for d in frame["data"]], frame["n"].to_numpy())
        keep = np.array([f is not None for f in found], dtype=bool)
        made = frame.loc[keep, ["k", "c"]]
        spans = np.array([f for f in found if f is not None], dtype=np.int64).reshape(-1, 2)
        return made.assign(low=spans[:, 0], high=spans[:, 1])

    bucketed = contexts.select("k", "c", "n", "data", F.pmod(F.xxhash64("k", F.lit(9)), F.lit(buckets)).alias("_bucket"))
    return bucketed.groupBy("_bucket").applyInPandas(lambda f: run(f[["k", "c", "n", "data"]]), "k long, c long, low long, high long")


def window_marks(contexts: DataFrame) -> DataFrame:
    """The same for anchors with more contexts than one index takes, in two narrow steps.

    Window offsets from the anchor are dealt into ranges; windows of a range have most of their
    bytes in common, and a context needs a look only at ranges whose common bytes occur twice.
    There each window is hashed (128 bits) and counted, with partial aggregation.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for k, c, n, off, data in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                last = len(data) - LENGTH
                for r in range(max(0, off - last) // RANGE, off // RANGE + 1):
                    low = off - r * RANGE  # the last start of the range; its windows share what follows
                    common = data[max(low, 0) : low - RANGE + 1 + LENGTH]
                    made.append((k, c, n, r, xxhash.xxh3_64_intdigest(common + bytes([r])) - (1 << 63)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], names=["k", "c", "n", "r", "key"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for k, c, n, off, data, wanted in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                for r in wanted:
                    for at in range(max(0, off - r * RANGE - RANGE + 1), min(off - r * RANGE, len(data) - LENGTH) + 1):
                        made.append((k, c, n, at, xxhash.xxh3_128_digest(data[at : at + LENGTH])))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], names=["k", "c", "n", "at", "w"])

    cut = stored(contexts.mapInArrow(ranges, "k long, c long, n long, r int, key long"), "ranges")
    twice = cut.groupBy("k", "key").agg(F.sum("n").alias("all")).where(F.col("all") > 1).withColumnsRenamed({"k": "_k", "key": "_key"})
    wanted = cut.join(twice, (cut["k"] == twice["_k"]) & (cut["key"] == twice["_key"])).groupBy(
        F.col("k").alias("_k"), F.col("c").alias("_c")
    ).agg(F.collect_set("r").alias("wanted"))
    chosen = contexts.join(wanted, (contexts["k"] == wanted["_k"]) & (contexts["c"] == wanted["_c"]))
    each = stored(
        chosen.select("k", "c", "n", "off", "data", "wanted").mapInArrow(windows, "k long, c long, n long, at int, w binary"), "windows"
    )
    again = each.groupBy("w").agg(F.sum("n").alias("all")).where(F.col("all") > 1).withColumnRenamed("w", "_w")
    return each.join(again, each["w"] == again["_w"]).groupBy("k", "c").agg(
        F.min("at").cast("long").alias("low"), (F.max("at") + LENGTH).cast("long").alias("high")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Each byte goes that is covered by LENGTH bytes of one text (in UTF-8) which also start at any
    other place, of the same text or another; strings are judged on the input.

    Each window of LENGTH bytes belongs to its anchor. Windows next to each other with one anchor
    make a context; equal windows lie in contexts of equal anchors, so only anchors met twice
    matter, found by counting narrow rows. An anchor whose contexts are all equal needs no index:
    each is covered whole by its copies. The distinct contexts of the others go, by anchor, to buckets of
    bounded size; each builds a run-length index and streams matching statistics. Anchors with
    very many distinct contexts are settled by window instead, exactly as well, so no task gets an
    unbounded group.

    A null or empty text has no byte and no span; texts under LENGTH bytes keep all; the rows of a
    repeated row lose what each other cover; a null doc_id stays null; other columns are ignored;
    no row gives no row.
    """
    table = stored(anchored(docs), "anchors")
    rows = table.select("doc_id", "_hash", F.explode("anchors").alias("a")).select("doc_id", "_hash", "a.*")
    met = (
        rows.groupBy("k")
        .agg(F.count("*").alias("all"), (F.min("c") != F.max("c")).alias("differ"))
        .where(F.col("all") > 1)
        .select(F.col("k").alias("_k"), "differ")
    )
    shared = stored(lookup(rows, met, [(rows["k"], "_k")], "inner").drop("_k"), "shared")
    contexts = stored(shared_contexts(docs, shared.where("differ")), "contexts")
    sizes = contexts.groupBy("k").agg(F.count("*").alias("held"), F.sum(F.length("data")).alias("bytes"))
    large = stored(sizes.where(F.col("held") > LARGEST).select(F.col("k").alias("_k")), "large")
    total = contexts.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    small = contexts.join(large, contexts["k"] == large["_k"], "left_anti")
    marks = indexed_marks(small, total)
    if not large.isEmpty():
        marks = marks.union(window_marks(contexts.join(large, contexts["k"] == large["_k"], "left_semi").select("k", "c", "n", "off", "data")))
    named = stored(marks, "marks").withColumnsRenamed({"k": "_k", "c": "_c"})
    # where all contexts of an anchor are equal, each has a copy and goes whole
    equal = shared.where(~F.col("differ")).select("doc_id", "_hash", "at", (F.col("at") + F.col("len")).alias("end"))
    several = shared.where("differ")
    placed = lookup(several, named, [(several["k"], "_k"), (several["c"], "_c")], "inner").select(
        "doc_id", "_hash", (F.col("at") + F.col("low")).alias("at"), (F.col("at") + F.col("high")).alias("end")
    )
    covered = placed.union(equal).groupBy(F.col("doc_id").alias("_doc"), F.col("_hash").alias("_of")).agg(
        F.collect_list(F.struct(F.col("at").alias("low"), F.col("end").alias("high"))).alias("gone")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "data"):
            sizes, removed, spans, digests = [], [], [], []
            for data, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, end, cut, runs = hashlib.sha256(), 0, 0, 0
                for low, high in sorted((g["low"], g["high"]) for g in gone or ()):
                    if low > end or not runs:
                        runs += 1
                        kept.update(data[end:low])
                        cut += high - low
                    else:
                        cut += max(0, high - end)
                    end = max(end, high)
                kept.update(data[end:])
                sizes.append(len(data))
                removed.append(cut)
                spans.append(runs)
                digests.append(kept.hexdigest())
            numbers = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
            yield pa.record_batch([batch.column(0), *numbers, pa.array(digests)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return _with_rows(docs, covered, ["gone"], "left").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
