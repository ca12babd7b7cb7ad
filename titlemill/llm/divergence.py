"""How far each source's term distribution lies from its peers' and its language's (operator 12).

Null texts, langs and sources read as ''. Terms are runs of letters outside ASCII punctuation,
digits and blanks (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``), A-Z lower-cased. A language keeps the V
terms found in at least ``MIN_DOCS`` of its documents (rows). Every occurring (lang, source) group
and every lang gives each kept term, counted c >= 0 times there, the integer probability
``p = 1 + floor(SCALE * (c + 1) / (N + V))``, N the group's kept occurrences. The divergence of
p from q is ``f = floor((p - q)^2 / q)``. Part ``pair``: for each other source of the lang, the sum
of f over all kept terms with q the peer's p. Part ``term``: each kept term the group holds with
p above its lang's, valued by f against the lang; the ``TOP_TERMS`` best per group. Ranks count
from 1 per (lang, source, part) by value descending, then item in UTF-8 order. All arithmetic is
integral: p by decimal division, f and sums in 64 bits.

The pair part is Gustavson's row accumulation. Group counts are posted term-major: rows of
(lang, term bucket) hold each term's postings (group, p). A task builds, per term, the dense row
of every group's p (the group's baseline ``1 + floor(SCALE / (N + V))`` where it lacks the term),
and every posting scatters one dense vector over the peers into the lang's S x S accumulator:

    value(g, h) = V * f(b_g, b_h)                                 (every term at baseline)
                + sum over t in g:     f(p_g(t), P[t, h]) - f(b_g, b_h)
                + sum over t in h \\ g: f(b_g, p_h(t)) - f(b_g, b_h)

so no pair of postings is ever emitted; the zero baselines are corrected by the first line. Tasks
return their accumulators, which a group-by sums. Term buckets are sized from the postings count,
so a large lang spreads over many tasks and a hot term holds one posting per source at most.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlemill.llm.common import blocks, stored

# Fixed values of the contract: the term pattern, the scale of p, the least document frequency
# and the longest term report. In UTF-8 the pattern is a set of bytes, A-Z, a-z and all from 0x80:
# TERM_BYTES lower-cases A-Z, keeps the others of the set and makes blanks of the rest.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTES = bytes(b if re.match(TERM, chr(b)) else 32 for b in range(256)).lower()
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
#: Distinct (group, term) a task counts before it hands them on and starts anew.
COUNTED = 400_000
#: Postings per term bucket, and dense cells (postings x peers) a task holds at once.
BUCKET_POSTINGS = 200_000
CELLS = 1_000_000
OUT = "lang string, source string, part string, item string, value long, rank int"


def terms(data: bytes) -> list[bytes]:
    return data.translate(TERM_BYTES).split()


def term_counts(rows: DataFrame) -> DataFrame:
    """`rows` (lang, source, text) -> lang, source, term, c (occurrences), d (rows), summed per task.

    A task sums up to COUNTED distinct terms before it emits them, so a (lang, source, term) may
    have several rows, to be summed once more.
    """

    def emit(held: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        groups, sizes = list(held), [len(c) for c, _ in held.values()]
        found = [t for c, _ in held.values() for t in c]
        at = pa.array(np.repeat(np.arange(len(groups), dtype=np.int32), sizes))
        named = [pa.array([g[i] for g in groups], pa.binary()).view(pa.string()).take(at) for i in (0, 1)]
        yield pa.record_batch(
            [*named, pa.array(found, pa.binary()).view(pa.string()),
             pa.array([n for c, _ in held.values() for n in c.values()], pa.int64()),
             pa.array([d[t] for c, d in held.values() for t in c], pa.int64())],
            names=["lang", "source", "term", "c", "d"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for block in blocks(batches, "text"):
            for lang, source, data in zip(*[block.column(i).to_pylist() for i in range(3)], strict=True):
                if (lang, source) not in held:
                    held[lang, source] = Counter(), Counter()
                    size += 1
                c, d = held[lang, source]
                found, before = terms(data), len(c)
                c.update(found)
                d.update(set(found))
                size += len(c) - before
                if size >= COUNTED:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    binary = rows.select(*[F.encode(c, "utf-8").alias(c) for c in ("lang", "source", "text")])
    return binary.mapInArrow(run, "lang string, source string, term string, c long, d long")


def probability(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exact for any counts."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(38,0)) * CAST({count} + 1 AS DECIMAL(38,0))) div CAST({total} + {kept} AS DECIMAL(38,0))"
    )


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def accumulate(postings: pd.DataFrame, peers: pd.DataFrame) -> pd.DataFrame:
    """Partial pair sums of one (lang, term bucket): postings (term, g, p) against peers (peer, b).

    Returns (lang, g, h, partial) for every cell the postings touched, the diagonal left out.
    """
    if postings.empty or peers.empty:
        return pd.DataFrame({"lang": [], "g": [], "h": [], "partial": []})
    size = int(peers["peer"].max()) + 1
    base = np.zeros(size, dtype=np.int64)
    base[peers["peer"].to_numpy()] = peers["b"].to_numpy()
    acc = np.zeros((size, size), dtype=np.int64)
    postings = postings.sort_values("term", kind="stable")
    term_at = pd.factorize(postings["term"])[0]
    g_all, p_all = postings["g"].to_numpy(np.int64), postings["p"].to_numpy(np.int64)
    step = max(1, CELLS // size)
    starts = np.flatnonzero(np.r_[True, term_at[1:] != term_at[:-1]])
    at = 0
    while at < len(starts):  # chunks of whole terms, about `step` postings each
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        lo, hi = starts[at], (starts[stop] if stop < len(starts) else len(term_at))
        t = term_at[lo:hi] - term_at[lo]
        g, p = g_all[lo:hi], p_all[lo:hi]
        dense = np.tile(base, (int(t[-1]) + 1, 1))  # each term's p of every group
        held = np.zeros(dense.shape, dtype=bool)
        dense[t, g] = p
        held[t, g] = True
        rows = dense[t]  # the term's dense row, once per posting
        # Row g gathers its own terms against every peer ...
        np.add.at(acc, g, _f(p[:, None], rows) - _f(base[g][:, None], base[None, :]))
        # ... and the column of h the terms h holds where the peer g lacks them.
        missing = ~held[t]
        cross = np.where(missing, _f(base[None, :], p[:, None]) - _f(base[None, :], base[g][:, None]), 0)
        np.add.at(acc.T, g, cross)
        at = stop
    np.fill_diagonal(acc, 0)
    touched_g, touched_h = np.nonzero(acc)
    return pd.DataFrame({
        "lang": postings["lang"].iloc[0], "g": touched_g.astype(np.int32), "h": touched_h.astype(np.int32),
        "partial": acc[touched_g, touched_h],
    })


def audit(docs: DataFrame) -> DataFrame:
    """`docs` (text, lang, source, more) -> lang, source, part, item, value, rank.

    Every occurring (lang, source) gets one ``pair`` row per other source of its lang (value 0
    where the lang keeps no term) and up to TOP_TERMS ``term`` rows. Null texts, langs and sources
    read as ''; repeated rows count as documents each; doc_id and other columns are not read. An
    empty table gives an empty result; a lang with one source has no pair rows.
    """
    read = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(read("lang").alias("lang"), read("source").alias("source"), read("text").alias("text"))
    # Each task counts its rows' terms; one group-by gives occurrences and documents per term.
    per_group = stored(
        term_counts(rows).groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d")),
        "divergence-groups",
    )
    kept = stored(
        per_group.groupBy("lang", "term").agg(F.sum("d").alias("df"), F.sum("c").alias("c"))
        .where(F.col("df") >= MIN_DOCS).drop("df"),
        "divergence-kept",
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("n"))
    held = per_group.join(kept.select("lang", "term"), ["lang", "term"])  # group counts of kept terms
    totals = held.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.encode("source", "UTF-8"))
    groups = stored(
        rows.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs.select("lang", "v"), "lang", "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
        .withColumn("g", (F.row_number().over(order) - 1).cast("int"))
        .withColumn("b", F.when(F.col("v") > 0, probability("0", "n", "v")).cast("long")),
        "divergence-peers",
    )

    # Part term: the group's p against its lang's, best TOP_TERMS per group.
    term_rows = (
        held.join(groups.select("lang", "source", F.col("n").alias("n_g"), "v"), ["lang", "source"])
        .join(kept.select("lang", "term", F.col("c").alias("c_l")), ["lang", "term"])
        .join(langs.select("lang", F.col("n").alias("n_l")), "lang")
        .withColumn("p", probability("c", "n_g", "v").cast("long"))
        .withColumn("q", probability("c_l", "n_l", "v").cast("long"))
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence("p", "q").alias("value"))
    )
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.encode("item", "UTF-8"))
    # Spread by item first: the window then needs a shuffle of its own, before which Spark keeps
    # the best TOP_TERMS of each group per task, so a source with a third of all rows is no hot task.
    term_part = (
        term_rows.repartition("lang", "source", "item")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= TOP_TERMS)
    )

    # Part pair: accumulators over term buckets, plus every term at both baselines.
    postings = held.join(groups.select("lang", "source", "g", "n", "v"), ["lang", "source"]).select(
        "lang", "term", "g", probability("c", "n", "v").cast("long").alias("p")
    )
    count = per_group.count()
    buckets = max(1, math.ceil(count / BUCKET_POSTINGS))
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    peers = groups.where(F.col("v") > 0).select(  # fresh names: both sides come from `groups`
        F.col("lang").alias("lang"), F.col("g").alias("peer"), F.col("b").alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
    )
    partial = (
        postings.withColumn("bucket", bucket).groupBy("lang", "bucket")
        .cogroup(peers.groupBy("lang", "bucket"))
        .applyInPandas(lambda a, b: accumulate(a.drop(columns="bucket"), b), "lang string, g int, h int, partial long")
        .groupBy("lang", "g", "h").agg(F.sum("partial").alias("partial"))
    )
    me, peer = groups.alias("me"), groups.alias("peer")
    pairs = (
        me.join(peer, (F.col("me.lang") == F.col("peer.lang")) & (F.col("me.g") != F.col("peer.g")))
        .select(F.col("me.lang").alias("lang"), F.col("me.source").alias("source"), F.col("peer.source").alias("item"),
                F.col("me.g").alias("g"), F.col("peer.g").alias("h"), F.col("me.v").alias("v"),
                F.col("me.b").alias("b_g"), F.col("peer.b").alias("b_h"))
        .join(partial, ["lang", "g", "h"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                F.when(F.col("v") > 0, F.col("v") * divergence("b_g", "b_h") + F.coalesce("partial", F.lit(0))).otherwise(F.lit(0))
                .cast("long").alias("value"))
    )
    pair_part = pairs.withColumn("rank", F.row_number().over(ranked))
    return pair_part.unionByName(term_part).select("lang", "source", "part", "item", F.col("value").cast("long"), F.col("rank").cast("int"))
