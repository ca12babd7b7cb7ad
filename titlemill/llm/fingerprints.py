"""Document fingerprints by order min-hash (operator 2), in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlemill.llm.common import partitions, stored, whole_text, words
from titlemill.llm.rules import bind

#: Words per k-mer, bins of a fingerprint, k-mers per tuple.
WIDTH = 3
BIN_BITS = 6
TUPLE = 2
#: A sorted entry holds a hash above and the k-mer's place in the text below; 2^27 words of one
#: letter fill more than half of the largest text that a column can hold.
PLACE_BITS = 27


def _hash_of(entry: Column) -> Column:
    return F.shiftright(entry, PLACE_BITS)


def _place_of(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _entry(value: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(value, PLACE_BITS), PLACE_BITS).bitwiseOR(place.cast("long"))


def _bin_of(entry: Column) -> Column:
    return F.shiftright(entry, 64 - BIN_BITS)


def signature(text: Column) -> Column:
    """Array of longs, one per bin that has a k-mer: bin in the high half, tuple hash in the low.

    K-mers of words are numbered by occurrence, hashed with their number and dealt over bins by
    hash. Of each bin the TUPLE least are taken, put back into text order and hashed as a tuple,
    so that an edit, a move or a repeat of words changes what it touches. Sorts are of plain longs;
    every other step is linear in the text.
    """

    def kmers(h: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(h) - WIDTH), lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(WIDTH)])
        )
        return F.when(F.size(h) >= WIDTH, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<bigint>")
        )

    def numbered(entries: Column) -> Column:
        """Entries of equal hash lie side by side: the k-th of them gets number k."""
        starts = F.filter(
            F.transform(
                entries,
                lambda e, k: F.when((k == 0) | (_hash_of(F.get(entries, k - 1)) != _hash_of(e)), k).otherwise(-1),
            ),
            lambda k: k >= 0,
        )

        def number(first: Column) -> Column:
            unique = F.transform(entries, lambda e: _entry(F.xxhash64(_hash_of(e), F.lit(0)), _place_of(e)))
            runs = F.flatten(
                F.transform(
                    first, lambda s, j: F.sequence(F.lit(0), F.coalesce(F.get(first, j + 1), F.size(entries)) - s - 1)
                )
            )
            repeated = bind(
                runs,
                lambda r: F.transform(
                    entries, lambda e, k: _entry(F.xxhash64(_hash_of(e), F.get(r, k)), _place_of(e))
                ),
            )
            return F.when(F.size(first) == F.size(entries), unique).otherwise(repeated)

        return bind(starts, number)

    def tuples(entries: Column) -> Column:
        least = F.filter(
            entries, lambda e, k: (k < TUPLE) | (_bin_of(F.get(entries, k - TUPLE)) != _bin_of(e))
        )

        def hashed(picked: Column) -> Column:
            def one(e: Column, k: Column) -> Column:
                opens = (k == 0) | (_bin_of(F.get(picked, k - 1)) != _bin_of(e))
                mate = F.get(picked, k + 1)
                alone = F.coalesce(_bin_of(mate) != _bin_of(e), F.lit(True))
                before = _place_of(e) < _place_of(mate)
                value = (
                    F.when(alone, F.xxhash64(_hash_of(e)))
                    .when(before, F.xxhash64(_hash_of(e), _hash_of(mate)))
                    .otherwise(F.xxhash64(_hash_of(mate), _hash_of(e)))
                )
                bits = F.shiftleft(_bin_of(e) + (1 << BIN_BITS - 1), 32)
                return F.when(opens, bits.bitwiseOR(F.shiftrightunsigned(value, 32))).otherwise(F.lit(-1).cast("long"))

            return F.filter(F.transform(picked, one), lambda x: x >= 0)

        return bind(least, hashed)

    def sorted_entries(k: Column) -> Column:
        return F.sort_array(F.transform(k, _entry))

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    ordered = bind(bind(hashes, kmers), sorted_entries)
    return bind(F.sort_array(bind(ordered, numbered)), tuples)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the bins that either signature fills; 1 if both are empty."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, 32))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def spelled(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.hex(x))), ",")


def with_next(docs: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """`docs` and `_next`, a struct of `columns` of the row that follows by `order`; the last row's
    is the first row.

    Rows are dealt over ranges of `order` (one shuffle of the wide rows) and look ahead inside
    their range. The first row of each range is copied to the range before it, so every range has
    the row that follows its last. Ranges come from approximate quantiles: their bounds and first
    keys are as many as there are shuffle partitions, and are all that is broadcast.
    """
    ranges = partitions(docs.sparkSession)
    keys = [order, "_hash"]
    cuts = docs.select(F.percentile_approx(order, [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0]
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts or ()))])
    place = F.size(F.filter(bounds, lambda b: b <= F.col(order))) if cuts else F.lit(0)
    tagged = docs.withColumn("_range", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(place))
    firsts = stored(tagged.groupBy("_range").agg(F.min(F.struct(*keys)).alias("_first")), "ranges")
    rows = sorted(firsts.collect(), key=lambda r: r["_range"])  # one row per range
    before = {r["_range"]: rows[i - 1]["_range"] for i, r in enumerate(rows)}
    if not rows:
        return tagged.withColumn("_next", F.struct(*columns)).drop("_range")
    pairs = docs.sparkSession.createDataFrame(list(before.items()), "_range int, _before int")
    ghosts = firsts.join(F.broadcast(pairs), "_range").select(
        F.col("_range").alias("_of"), "_before", F.col("_first")[order].alias("_id"), F.col("_first")["_hash"].alias("_key")
    )
    on = (tagged["_range"] == ghosts["_of"]) & tagged[order].eqNullSafe(ghosts["_id"]) & (tagged["_hash"] == ghosts["_key"])
    copied = tagged.join(F.broadcast(ghosts), on, "left").withColumn(
        "_at",
        F.explode(
            F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")))).otherwise(
                F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")), F.struct(F.col("_before").alias("r"), F.lit(1).alias("copy")))
            )
        ),
    )
    ahead = Window.partitionBy("_at.r").orderBy("_at.copy", *[F.col(k).asc_nulls_first() for k in keys])
    looked = copied.withColumn("_next", F.lead(F.struct(*columns)).over(ahead))
    return looked.where(F.col("_at.copy") == 0).drop("_range", "_of", "_before", "_id", "_key", "_at")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last half (rounded down) replaced by as many first code points of the
    next document by doc_id, the first document's after the last. Rows of equal doc_id follow by
    text hash, those of no doc_id come first. A null text is an empty one, whose fingerprint is
    empty and like only another empty one; texts of one or two words have one k-mer of all of
    them; repeated rows follow each other; a single row is its own next; other columns are
    ignored; no row gives no row.
    """
    text = whole_text()
    own = docs.select("doc_id", F.xxhash64(text).alias("_hash"), text.alias("text"), signature(text).alias("_sig"))
    looked = with_next(own, "doc_id", ["text", "_sig"])
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    edited = looked.select(
        "doc_id", chars.cast("long").alias("n_chars"), "_sig", F.col("_next._sig").alias("_next_sig"),
        F.concat(F.substring("text", F.lit(1), chars - half), F.substring("_next.text", F.lit(1), half)).alias("_edited"),
    ).withColumn("_edited_sig", signature(F.col("_edited")))
    return edited.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        spelled(F.col("_sig")).alias("fingerprint"), spelled(F.col("_edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("_sig"), F.col("_edited_sig")).alias("near_edited"),
        likeness(F.col("_sig"), F.col("_next_sig")).alias("near_next"),
    )
