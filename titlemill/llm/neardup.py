"""Near-duplicate documents by a chosen-path set similarity join (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, partitions, stored, text_key, whole_text
from titlemill.llm.components import least_members
from titlemill.operators.bits import split_by_keys
from titlemill.operators.lookup import lookup

#: Independent trees. A pair of similarity s shares the first branch of a tree with chance s.
TREES = 10
#: Minwise tokens per document, 16 bits of each, that order deeper branches and estimates.
SLOTS = 64
#: Branches of a deeper node, and how often a node is branched.
BRANCHES = 3
DEPTH = 3
#: Largest node that is compared exhaustively in one task, and most bytes of sets so compared.
LEAF = 4096
LEAF_BYTES = 48 << 20
#: Standard deviations by which an estimate may fall short of the similarity asked for.
MARGIN = 5.0
#: Bytes of texts that are shingled at once, so that their hashes stay in a core's cache.
SHINGLED = 1 << 18
#: Longer words are hashed one by one.
LONG_WORD = 64

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Masks of the first 0 to 8 bytes.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit values, in place."""
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, one after the other, and each text's count of words.

    Letters A-Z are lower-cased and words parted by ASCII blanks only. A word is mixed by eight
    bytes and its length at a time, so the whole block takes a few passes over its bytes.
    """
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, content = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
    held = np.frombuffer(content or b"", np.uint8)[ends[0] : ends[-1]]
    ends -= ends[0]
    # zeros at the end, so that eight bytes can be read from any place
    data = np.zeros(len(held) + 8, dtype=np.uint8)
    data[: len(held)] = held + (((held - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5))
    filled = (held != 32) & ((held - np.uint8(9)) > 4)
    first, last = filled.copy(), filled.copy()
    first[1:] &= ~filled[:-1]
    last[:-1] &= ~filled[1:]
    # a word ends with its text
    cuts = ends[:-1][ends[:-1] < ends[1:]]
    first[cuts] = filled[cuts]
    last[cuts[1:] - 1] = filled[cuts[1:] - 1]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    eight = np.ndarray(len(held) + 1, dtype="<u8", buffer=data, strides=(1,))
    hashes = sizes.astype(np.uint64) * _MIX
    hashes += eight[starts] & _LOW[np.minimum(sizes, 8)]
    _scramble(hashes)
    at, done = np.flatnonzero(sizes > 8), 8
    while len(at) and done < LONG_WORD:
        more = eight[starts[at] + done] & _LOW[np.minimum(sizes[at] - done, 8)]
        hashes[at] = _scramble(hashes[at] * _MIX + more)
        done += 8
        at = at[sizes[at] > done]
    for i in at.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return hashes, np.diff(np.searchsorted(starts, ends))


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles of `width` words, one text after the
    other, and each text's count of them. Fewer words than `width` are one shingle."""
    hashes, words = word_hashes(texts)
    ends = np.cumsum(words)
    sizes = np.where(words > 0, np.maximum(words - width + 1, 1), 0)
    starts = np.cumsum(sizes) - sizes
    tokens, short = np.empty(int(sizes.sum()), dtype=np.uint64), np.zeros(int(sizes.sum()), dtype=bool)
    for count in range(1, min(width, int(words.max(initial=0)) + 1)):
        rows = np.flatnonzero(words == count)
        short[starts[rows]] = True
        tokens[starts[rows]] = _mixed([hashes[ends[rows] - count + k] for k in range(count)])
    run = max(len(hashes) - width + 1, 0)
    whole = np.ones(len(hashes), dtype=bool)
    for k in range(1, width):
        whole[ends[words >= k] - k] = False
    tokens[~short] = _mixed([hashes[k : k + run] for k in range(width)])[whole[:run]]
    for begin, end in zip(starts[sizes > 1].tolist(), (starts + sizes)[sizes > 1].tolist(), strict=True):
        tokens[begin:end].sort()
    new = np.ones(len(tokens), dtype=bool)
    np.not_equal(tokens[1:], tokens[:-1], out=new[1:])
    new[starts[sizes > 0]] = True
    distinct = np.zeros(len(sizes), dtype=np.int64)
    if len(tokens):
        distinct[sizes > 0] = np.add.reduceat(new, starts[sizes > 0], dtype=np.int64)
    return tokens[new], distinct


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    mixed = np.full(len(parts[0]), np.uint64(len(parts)))
    for part in parts:
        mixed *= _MIX
        mixed += part
        _scramble(mixed)
    return mixed


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    odd = draw.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, SLOTS, dtype=np.uint64)


def _minima(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per set and slot the least value; `sizes` of the sets that follow each other, none empty."""
    # tokens are mixed hashes, so a product and a sum order them afresh for each slot
    least, moved = np.empty((len(sizes), SLOTS), dtype=np.uint64), np.empty_like(tokens)
    starts = np.cumsum(sizes) - sizes
    for k, (a, b) in enumerate(zip(*_multipliers(), strict=True)):
        np.multiply(tokens, a, out=moved)
        moved += b
        least[:, k] = np.minimum.reduceat(moved, starts)
    return least


def _cut(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values that hold the next of `counts` values each."""
    ends = np.concatenate([[0], np.cumsum(counts * values.itemsize)])
    if ends[-1] >= 1 << 31:
        raise ValueError("the shingles of a text do not fit into 2 GB")
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, _hash, n_shingles, set id, first branches (64 bits each) and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", SHINGLED):
            tokens, sizes = shingles(batch.column(2), width)
            filled = sizes > 0
            least = _minima(tokens, sizes[filled]) if filled.any() else np.empty((0, SLOTS), dtype=np.uint64)
            content, ends = memoryview(tokens).cast("B"), (np.cumsum(sizes) * 8).tolist()
            ids = [
                hashlib.blake2b(content[end - 8 * size : end], digest_size=16).digest() if size else None
                for end, size in zip(ends, sizes.tolist(), strict=True)
            ]
            firsts = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(filled * TREES)]).astype(np.int32),
                pa.array(least[:, :TREES].ravel().view(np.int64)),
            )
            short = _cut((least & np.uint64(0xFFFF)).astype("<u2").ravel(), filled * SLOTS)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), firsts, short],
                names=["doc_id", "_hash", "n_shingles", "sid", "firsts", "sketch"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64(whole_text()).alias("_hash"), whole_text().alias("text"))
    schema = f"doc_id {id_type}, _hash long, n_shingles long, sid binary, firsts array<long>, sketch binary"
    return narrow.mapInArrow(run, schema)


def _shared(rows: DataFrame, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows of nodes with `least` members to LEAF, and of larger ones with their size `n`."""
    counts = rows.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    named = counts.withColumnRenamed("node", "_node")
    sized = stored(lookup(rows, named, [(rows["node"], "_node")], "inner").drop("_node"), "nodes")
    return sized.where(F.col("n") <= LEAF).drop("n"), sized.where(F.col("n") > LEAF)


def block_nodes(key: str, blocks_of: Column, by: str) -> Column:
    """New nodes of a row, such that any two rows of a key meet in one of them.

    The rows are dealt over `blocks_of` blocks by hash, and every pair of blocks is a node; the
    node of two equal blocks is left out where there are two or more, as others hold its pairs.
    """
    count = blocks_of.cast("long")
    own = F.pmod(F.xxhash64(by, F.lit(3)), count)
    others = F.filter(F.sequence(F.lit(0).cast("long"), count - 1), lambda o: (count == 1) | (o != own))
    return F.transform(others, lambda o: F.xxhash64(key, F.least(own, o), F.greatest(own, o)))


def leaves(reps: DataFrame) -> DataFrame:
    """node, sid, sketch: all nodes to be compared exhaustively."""
    rows = reps.select("sid", F.posexplode("firsts").alias("tree", "first")).select(F.xxhash64("tree", "first").alias("node"), "sid")
    # sketches join only the sets that share a first branch
    own = reps.select(F.col("sid").alias("_sid"), "sketch")
    done, large = [lookup(part, own, [(part["sid"], "_sid")], "inner").drop("_sid") for part in _shared(rows)]
    done, large = done.select("node", "sid", "sketch"), large.select("node", "sid", "sketch", "n")
    for _ in range(DEPTH):
        if large.isEmpty():
            return done
        slots = F.explode(F.array(*[F.pmod(F.xxhash64("node", F.lit(b)), F.lit(SLOTS)) for b in range(BRANCHES)]))
        branched = large.select("node", "sid", "sketch", slots.alias("slot")).distinct()
        value = F.substring("sketch", F.col("slot").cast("int") * 2 + 1, F.lit(2))
        small, large = _shared(branched.select(F.xxhash64("node", "slot", value).alias("node"), "sid", "sketch"))
        done = done.union(small)
    if not large.isEmpty():
        nodes = F.explode(block_nodes("node", F.ceil(F.col("n") * 2 / LEAF), "sid"))
        done = done.union(large.select(nodes.alias("node"), "sid", "sketch"))
    return done


def _groups(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end - begin > 1:
            yield begin, end


def _roots(count: int, near) -> np.ndarray:
    """The least member of the group of each of 0..count-1: near(i, others) says which others are close.

    Every reached item is compared with all that are not yet reached, so no link between two
    groups exists.
    """
    left, root = np.arange(count), np.arange(count)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            close = near(at, left)
            if close.any():
                reached, left = left[close], left[~close]
                root[reached] = root[at]
                queue.extend(reached)
    return root


def _stars(sids: np.ndarray, groups: list[tuple[int, np.ndarray]]) -> pd.DataFrame:
    """a, b: members that have a root other than themselves, and that; `groups` are first rows and roots."""
    moved = [(begin + np.flatnonzero(root != np.arange(len(root))), begin, root) for begin, root in groups]
    left = np.concatenate([np.empty(0, dtype=np.int64), *[at for at, _, _ in moved]])
    right = np.concatenate([np.empty(0, dtype=np.int64), *[begin + root[at - begin] for at, begin, root in moved]])
    return pd.DataFrame({"a": sids[left], "b": sids[right]})


def _by_bucket(rows: DataFrame, seed: int, run) -> DataFrame:
    """a, b: what `run` finds in the rows of some nodes at a time."""
    parts = partitions(rows.sparkSession)
    bucket = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(parts * 4))
    # dealt by number, as adaptive execution would merge small buckets that take long
    bucketed = rows.withColumn("_bucket", bucket).repartition(parts, "_bucket")
    return bucketed.groupBy("_bucket").applyInPandas(lambda f: run(f), "a binary, b binary")


def clusters(rows: DataFrame, similarity: float) -> DataFrame:
    """a, b: sets that estimates not below the margin join in some node, each with the least one."""
    spread = MARGIN * (similarity * (1 - similarity) / SLOTS) ** 0.5
    enough = max(1, int(SLOTS * (similarity - spread)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["node", "sid"], ignore_index=True)
        sketch = np.frombuffer(b"".join(frame["sketch"]), dtype="<u2").reshape(-1, SLOTS)
        found = []
        for begin, end in _groups(frame["node"].to_numpy()):
            own = sketch[begin:end]

            def near(at: int, rest: np.ndarray) -> np.ndarray:
                others = own[rest[0] : rest[-1] + 1] if rest[-1] - rest[0] + 1 == len(rest) else own[rest]  # noqa: B023
                # a bit per slot
                return np.bitwise_count(np.packbits((others == own[at]).ravel()).view(np.uint64)) >= enough  # noqa: B023

            found.append((begin, _roots(end - begin, near)))
        return _stars(frame["sid"].to_numpy(), found)

    return _by_bucket(rows, 5, run)


class Overlaps:
    """Sizes of the intersections of sets of sorted tokens that follow each other.

    Tokens of at least one set in 64 are bits of a row per set; the rarer ones that several sets
    have list these. Either takes no more room than the tokens, and no token of one set only counts.
    """

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray):
        self.many = len(sizes)
        row = np.repeat(np.arange(self.many), sizes)
        _, ids, held = np.unique(tokens, return_inverse=True, return_counts=True)
        common = held >= max(2, self.many / 64)
        here = common[ids]
        place = (np.cumsum(common) - 1)[ids[here]]
        self.bits = np.zeros((self.many, (np.count_nonzero(common) + 63) // 64), dtype=np.uint64)
        if len(place):
            # ids rise within a set, so the bits of one word follow each other
            at = row[here] * self.bits.shape[1] + (place >> 6)
            cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            self.bits.ravel()[at[cuts]] = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), cuts)
        here = ((held > 1) & ~common)[ids]
        rare, row = ids[here], row[here]
        order = np.argsort(rare, kind="stable")
        self.holders, self.begin, self.held = row[order], np.searchsorted(rare[order], rare), held[rare]
        self.own = np.searchsorted(row, np.arange(self.many + 1))

    def __call__(self, at: int, rest: np.ndarray) -> np.ndarray:
        both = np.bitwise_count(self.bits[rest] & self.bits[at]).sum(axis=1, dtype=np.int64)
        own = slice(self.own[at], self.own[at + 1])
        if own.start < own.stop:
            held, begin = self.held[own], self.begin[own]
            places = np.repeat(begin - (np.cumsum(held) - held), held) + np.arange(held.sum())
            both += np.bincount(self.holders[places], minlength=self.many)[rest]
        return both


def with_nodes(members: DataFrame) -> DataFrame:
    """sid, of and the nodes in which a set is compared: one per cluster, or pairs of blocks of a large one."""
    sized = members.join(
        members.groupBy("cluster").agg(F.sum("n_shingles").alias("all")).withColumnRenamed("cluster", "_of"),
        F.col("cluster") == F.col("_of"),
    )
    count = F.when(F.col("all") * 8 <= LEAF_BYTES, F.lit(1)).otherwise(F.ceil(F.col("all") * 16 / LEAF_BYTES))
    return sized.select("sid", "of", block_nodes("cluster", count, "sid").alias("nodes"))


def links(sets: DataFrame, similarity: float) -> DataFrame:
    """a, b: `sets` (sid, nodes, tokens) that links of enough exact similarity join within a node,
    each with the least one of the group."""
    percent = round(similarity * 100)
    dealt = sets.select(F.explode("nodes").alias("node"), "sid", "tokens")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # equal rows give their set more than once
        frame = frame.drop_duplicates(["node", "sid"]).sort_values(["node", "sid"], ignore_index=True)
        found = []
        for begin, end in _groups(frame["node"].to_numpy()):
            own = frame["tokens"].iloc[begin:end]
            sizes = np.array([len(t) // 8 for t in own])
            overlap = Overlaps(np.frombuffer(b"".join(own), dtype=np.uint64), sizes)

            def near(at: int, rest: np.ndarray) -> np.ndarray:
                close = np.zeros(len(rest), dtype=bool)
                # the smaller set must hold the share by itself
                fit = 100 * np.minimum(sizes[at], sizes[rest]) >= percent * np.maximum(sizes[at], sizes[rest])  # noqa: B023
                chosen = rest[fit]
                if len(chosen):
                    both = overlap(at, chosen)  # noqa: B023
                    close[fit] = 100 * both >= percent * (sizes[at] + sizes[chosen] - both)  # noqa: B023
                return close

            found.append((begin, _roots(end - begin, near)))
        return _stars(frame["sid"].to_numpy(), found)

    return _by_bucket(dealt, 6, run)


def near_duplicates(docs: DataFrame, width: int = 3, similarity: float = 0.85, named: bool = False) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, _hash (of the text), n_shingles, component_id, kept.

    With `named` also _root, one value per component whatever its ids are.

    A row's set holds its distinct shingles of `width` words (letters A-Z lower-cased, words parted
    by ASCII blanks; with fewer words the whole sequence is one). Rows are linked if their sets'
    Jaccard similarity reaches `similarity`; component_id is the least doc_id reachable.

    Equal sets become one. Each of TREES trees sends a set down the branch of its minwise token;
    nodes above LEAF branch on by BRANCHES more tokens, up to DEPTH times, and what is larger even
    then is compared by pairs of blocks. A pair at the threshold is missed by all trees with chance
    0.15^10, about 6e-9. Small nodes are compared by sketch, and the clusters that remain, joined
    over all trees, by their full sets. Each member is linked to the least of its group, so a
    group of n copies gives n - 1 links and not n^2.

    A null or empty text, or one of blanks, has no shingles and is linked with nothing; repeated
    rows are linked to each other if they have words; a null doc_id takes part and is never a
    component's least unless all are null; other columns are ignored; no row gives no row.
    """
    rows = stored(sketches(docs, width), "sketches")
    filled = rows.where(F.col("n_shingles") > 0)
    reps = stored(
        filled.groupBy("sid").agg(
            F.first("firsts").alias("firsts"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"),
            F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "_hash")).alias("of"),
        ),
        "sets",
    )
    # one cluster holds what any trees join, so each set is compared in full in one cluster only
    joined = least_members(clusters(leaves(reps), similarity), "clusters").withColumnsRenamed({"a": "sid", "b": "cluster"})
    found = joined.select("cluster", "sid").union(joined.select("cluster", F.col("cluster").alias("sid")).distinct())
    wanted = reps.select(F.col("sid").alias("_sid"), "of", "n_shingles")
    members = stored(
        found.join(wanted, found["sid"] == wanted["_sid"]).select("cluster", "sid", "of", "n_shingles"), "members"
    )
    sets = stored(token_sets(docs, with_nodes(members), width), "tokens")
    moved = least_members(links(sets, similarity), "links").withColumnsRenamed({"a": "_sid", "b": "root"})
    rooted = reps.select("sid", "least").join(moved, F.col("sid") == F.col("_sid"), "left").select(
        "sid", "least", F.coalesce("root", "sid").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component")).withColumnRenamed("root", "_root")
    known = stored(
        rooted.join(lowest, F.col("root") == F.col("_root")).select(
            F.col("sid").alias("_sid"), "component", *(["_root"] if named else [])
        ),
        "named",
    )
    component = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    # a row without words is a component of its own
    alone = F.encode(F.concat_ws(" ", F.lit("alone"), F.col("doc_id").cast("string"), F.col("_hash").cast("string")), "utf-8")
    return rows.join(known, rows["sid"] == known["_sid"], "left").select(
        "doc_id", "_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        *([F.coalesce("_root", alone).alias("_root")] if named else []),
    )


def token_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """sid, nodes, tokens of the rows named in `wanted` (sid, nodes, of: doc_id and text hash).

    Only texts that a bitmap of the wanted keys lets through are shuffled for the join.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", SHINGLED):
            tokens = _cut(*shingles(batch.column(2), width))
            yield pa.record_batch([batch.column(0), batch.column(1), tokens], names=["sid", "nodes", "tokens"])

    keyed = docs.select(F.col("doc_id"), whole_text().alias("text")).withColumn("_hash", F.xxhash64("text"))
    near, _ = split_by_keys(keyed, ["doc_id", "_hash"], wanted.select("of.doc_id", "of._hash"))
    on = near["doc_id"].eqNullSafe(F.col("of.doc_id")) & (near["_hash"] == F.col("of._hash"))
    return near.join(wanted, on).select("sid", "nodes", "text").mapInArrow(run, "sid binary, nodes array<long>, tokens binary")


def representatives(docs: DataFrame) -> DataFrame:
    """The first row of each component of `docs`, all columns as they are.

    The first is the least by doc_id, a null one last, and text hash; of rows equal in both any one.
    A row without words is a component of its own, as near_duplicates has it, unless equal to
    another in id and text.

    Rows equal in id and text lie in one component, so the row of a component of one is kept as it
    is read; only texts that may be of larger components are shuffled.
    """
    found = stored(
        near_duplicates(docs, width=5, similarity=0.8, named=True).select("doc_id", "_hash", "_root"), "roots"
    )
    many = found.groupBy("_root").count().where(F.col("count") > 1).select(F.col("_root").alias("_of"))
    shared = found.join(many, found["_root"] == many["_of"]).select("doc_id", "_hash")
    near, alone = split_by_keys(docs.withColumn("_hash", F.xxhash64(whole_text())), ["doc_id", "_hash"], shared)
    first = found.groupBy("_root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash")).alias("first")
    )
    kept = first.select(F.struct(F.col("first.doc_id"), F.col("first._hash")).alias("_of")).distinct()
    tagged = near.withColumn("_at", text_key(docs))
    # Partial aggregation first: many equal rows arrive as one per task. The join then has the same
    # key column, so texts are shuffled once.
    one = tagged.groupBy("_at").agg(F.first(F.struct(*docs.columns)).alias("_row"))
    return one.join(kept, one["_at"] == kept["_of"]).select("_row.*").union(alone.select(*docs.columns))
