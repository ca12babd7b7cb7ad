"""Language identification, known words first, shorter character n-grams for the rest (operator 13).

A text's words are its runs of letters (``\\p{L}+``), lower-cased. Per learned language the model
holds the count of each word in the training texts and, for n from ``NGRAM`` down to 1, the count
of each character n-gram of those words (words padded by a blank on each side for n >= 2). A
word's log-likelihood under language L is ``ln((c + 1) / (N_L + V))``: c its count there, N_L all
word occurrences of L, V the distinct words of every language. A word never seen in training is
scored by the mean log-likelihood of its n-grams at the longest n of which any is known, with the
same add-one smoothing per n; a word none of whose 1-grams is known adds nothing. A text's score
of L sums its words' scores; the prediction is the best language (ties: the least name), and
`score` its softmax probability over all learned languages.

Where it runs: one group-by counts the words of all texts, per learned language or for none; every
word's grams are cut once, as its pieces of up to ``NGRAM`` characters from each place, and the
shorter n-grams are counted as beginnings of the distinct pieces. Unseen words are scored level by
level, each word leaving at its longest known one. Frequent words and n-grams, at most
``HOT_CELLS`` cells, are broadcast, so a text's and a word's sums over them are formed without a
shuffle; all others are met by a join that splits hot keys, exactly as well. Texts are never
shuffled. The learned languages are the model's classes and are carried as literals: at most
``MAX_LANGUAGES``, more raise rather than grow the plan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import stored
from titlemill.operators.lookup import lookup

#: Longest character n-gram of the backoff; a word is scored at one level only.
NGRAM = 4
#: Classes carried in the plan as literals, one score column each; more raise rather than widen it.
MAX_LANGUAGES = 500
#: Scores (entries times classes) of one broadcast table, and entries at most.
HOT_CELLS = 2_000_000
HOT_ENTRIES = 100_000
#: Words a task looks up at once.
SLICE_WORDS = 1_000_000
UNDETERMINED = "und"
LETTERS = r"\p{L}+"


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 4 is 2; a null doc_id is not held out (and not learned)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def letter_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LETTERS), 0)


def grams(word: Column, n: int) -> Column:
    """The character n-grams of a word, in order; n >= 2 reads the word between two blanks."""
    padded = word if n == 1 else F.concat(F.lit(" "), word, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(padded) - n + 1)
    return F.when(F.length(padded) >= n, F.transform(starts, lambda i: F.substring(padded, i, n))).otherwise(
        F.array().cast("array<string>")
    )


def train(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[dict]]:
    """Words and n-grams with their log counts per language, and each language's smoothing floors.

    Learns from rows with a non-null lang whose doc_id is not null and not held out; a null text
    has no words. Returns (word, total, deltas) of every word of `docs`, (n, gram, total, deltas)
    with deltas a map from lang to ln(count + 1), empty for unseen words, and the classes in UTF-8
    order as dicts of lang and ``floor``: NGRAM + 1 values -ln(N_L + V) for words (index 0) and
    each n.
    """
    learned = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    every = stored(
        # outer, as a plain explode makes the optimizer cut the words once more to test their number
        docs.select(F.when(learned, F.col("lang")).alias("lang"), F.explode_outer(letter_words(F.col("text"))).alias("word"))
        .where(F.col("word").isNotNull()).groupBy("word", "lang").count(),
        "langid-counts",
    )
    counted = every.where(F.col("lang").isNotNull())
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    cut = F.transform(F.sequence(F.lit(1), F.length(padded)), lambda i: F.substring(padded, i, NGRAM))
    pieces = stored(
        counted.select("lang", "count", F.explode_outer(cut).alias("piece"))
        .groupBy("piece", "lang").agg(F.sum("count").alias("count")),
        "langid-pieces",
    )
    # A piece begins with one n-gram of each n up to its length; a blank is no 1-gram.
    shorter = F.filter(
        F.transform(F.sequence(F.lit(1), F.least(F.length("piece"), F.lit(NGRAM - 1))), lambda n: F.substring("piece", F.lit(1), n)),
        lambda g: g != " ",
    )
    gram_counts = (
        pieces.select("lang", "count", F.explode_outer(shorter).alias("gram")).where(F.col("gram").isNotNull()).groupBy("gram", "lang").agg(F.sum("count").alias("count"))
        .unionByName(pieces.where(F.length("piece") == NGRAM).withColumnRenamed("piece", "gram"))
        .withColumn("n", F.length("gram"))
    )
    # Distinct entries per level and totals per (class, level): at most NGRAM + 1 and
    # MAX_LANGUAGES x (NGRAM + 1) rows reach the driver; the class count is checked first.
    n_classes = counted.select("lang").distinct().count()
    if n_classes > MAX_LANGUAGES:
        raise ValueError(f"{n_classes} language values, more than MAX_LANGUAGES = {MAX_LANGUAGES}")
    seen = F.when(F.col("lang").isNotNull(), F.struct("lang", F.log(F.col("count") + F.lit(1.0)).alias("delta")))
    merged = [F.sum("count").alias("total"), F.map_from_entries(F.collect_list(seen)).alias("deltas")]
    words = stored(every.groupBy("word").agg(*merged), "langid-words")
    grams_of = stored(gram_counts.groupBy("n", "gram").agg(*merged), "langid-grams")
    distinct = {r["n"]: r["count"] for r in grams_of.groupBy("n").count().collect()}
    distinct[0] = words.where(F.size("deltas") > 0).count()
    # each word of m letters has m 1-grams and m + 3 - n longer ones, so totals need no gram counts
    length = F.length("word")
    numbers = [F.lit(1), length, *[F.greatest(length + 3 - n, F.lit(0)) for n in range(2, NGRAM + 1)]]
    totals = counted.groupBy("lang").agg(*[F.sum(F.col("count") * x).alias(f"n{n}") for n, x in enumerate(numbers)])
    floors = {
        r["lang"]: [-math.log(r[f"n{n}"] + distinct[n]) if r[f"n{n}"] else 0.0 for n in range(NGRAM + 1)] for r in totals.collect()
    }
    classes = [{"lang": lang, "floor": floors[lang]} for lang in sorted(floors, key=lambda s: s.encode("utf-8"))]
    return words, grams_of, classes


def frequent(table: DataFrame, classes: list[dict]) -> Column:
    """True for the rows of largest `total` that fit a broadcast; cut between quarters of octaves,
    so one row per quarter reaches the driver."""
    octave = F.floor(F.log2(F.col("total").cast("double")) * 4).cast("int")
    most = min(HOT_ENTRIES, HOT_CELLS // len(classes))
    least = 1 << 30
    for r in sorted(table.groupBy(octave.alias("o")).count().collect(), key=lambda r: -r["o"]):
        most -= r["count"]
        if most < 0:
            break
        least = r["o"]
    return octave >= least


def delta(lang: str) -> Column:
    return F.coalesce(F.element_at("deltas", F.lit(lang)), F.lit(0.0))


def word_scores(words: DataFrame, model_grams: DataFrame, classes: list[dict]) -> DataFrame:
    """One row per word that can be scored: word, total, its level (0 known, else n) and deltas.

    ``deltas`` maps languages to the extra log count of the word, or at level n of its n-grams
    (summed, divided by how many n-grams the word has); the rest add their floor only. A word with
    no known n-gram at any level has no row.
    """
    scored = words.where(F.size("deltas") > 0).select("word", "total", F.lit(0).alias("level"), "deltas")
    left = words.where(F.size("deltas") == 0).select("word", "total")
    for n in range(NGRAM, 0, -1):
        if left.isEmpty():
            break
        level = model_grams.where(F.col("n") == n)
        often = frequent(level, classes)
        hot, rare = F.broadcast(level.where(often).select("gram", "deltas")), level.where(~often).select(F.col("gram").alias("_gram"), "deltas")
        number = F.length("word") + (3 - n if n > 1 else 0)  # not the array's size, which would be cut anew for each gram
        exploded = left.select("word", "total", number.alias("m"), F.explode_outer(grams(F.col("word"), n)).alias("gram"))
        met = exploded.join(hot, "gram").select("word", "total", "m", "deltas")
        if not rare.isEmpty():
            others = exploded.join(hot.select("gram"), "gram", "left_anti")
            met = met.union(lookup(others, rare, [(F.col("gram"), "_gram")], "inner").select("word", "total", "m", "deltas"))
        langs = [c["lang"] for c in classes]
        sums = met.groupBy("word", "total", "m").agg(*[F.sum(delta(lang)).alias(f"_s{i}") for i, lang in enumerate(langs)])
        deltas = F.map_from_arrays(F.array(*[F.lit(lang) for lang in langs]), F.array(*[F.col(f"_s{i}") / F.col("m") for i in range(len(langs))]))
        found = stored(sums.select("word", "total", F.lit(n).alias("level"), deltas.alias("deltas")), "langid-unseen")
        scored = scored.unionByName(found)
        if n > 1:
            left = stored(left.join(found.select("word"), "word", "left_anti"), "langid-left")
    return scored


def text_sums(docs: DataFrame, hot: list[tuple[str, list[float]]], n_classes: int) -> DataFrame:
    """doc_id, letters (whether the text has words), sums over its frequent words, one per class,
    and its other words as often as they occur."""
    shared = docs.sparkSession.sparkContext.broadcast(
        ([w for w, _ in hot], np.array([s for _, s in hot], dtype=np.float64).reshape(-1, n_classes).T.copy())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, scores = pa.array(shared.value[0], pa.string()), shared.value[1]
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < batch.num_rows:  # rows of about SLICE_WORDS words, or one longer text
                before = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, before + SLICE_WORDS, side="right")))
                ids, lists = batch.column(0).slice(begin, stop - begin), batch.column(1).slice(begin, stop - begin)
                sizes, flat = np.diff(np.r_[before, ends[begin:stop]]), lists.flatten()
                begin = stop
                row = np.repeat(np.arange(len(sizes)), sizes)
                at = pc.index_in(flat, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
                known = at >= 0
                sums = np.array([np.bincount(row[known], weights=s[at[known]], minlength=len(sizes)) for s in scores])
                rest = np.bincount(row[~known], minlength=len(sizes))
                fixed = np.arange(len(sizes) + 1, dtype=np.int32) * n_classes
                yield pa.record_batch(
                    [ids, pa.array(sizes > 0),
                     pa.ListArray.from_arrays(pa.array(fixed, pa.int32()), pa.array(sums.T.ravel(), pa.float64())),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(rest)], pa.int32()), flat.filter(pa.array(~known)))],
                    names=["doc_id", "letters", "sums", "others"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    words = docs.select("doc_id", letter_words(F.col("text")).alias("words"))
    return words.mapInArrow(run, f"doc_id {id_type}, letters boolean, sums array<double>, others array<string>")


def predict(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score. Other columns are not read.

    Null or letterless texts: 'und', score 0.0; with no learned language every text is 'und'.
    Repeated rows (same doc_id and text) get one prediction each, equal; a null doc_id is
    predicted too. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text", "lang")
    words, model_grams, classes = train(docs)
    if not classes:
        return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    scored = word_scores(words, model_grams, classes)
    often = frequent(scored, classes)
    score = [
        F.element_at(F.array(*[F.lit(x) for x in c["floor"]]), F.col("level") + 1) + delta(c["lang"]) for c in classes
    ]
    hot = [(r["word"], r["scores"]) for r in scored.where(often).select("word", F.array(*score).alias("scores")).collect()]
    rows = stored(text_sums(docs, hot, len(classes)).withColumn("_rid", F.monotonically_increasing_id()), "langid-texts")
    others = rows.select("_rid", F.explode("others").alias("word"))
    rare = scored.where(~often).withColumnRenamed("word", "_word")
    joined = lookup(others, rare, [(F.col("word"), "_word")], "inner")
    added = joined.groupBy(F.col("_rid").alias("_of")).agg(*[F.sum(x).alias(f"_s{i}") for i, x in enumerate(score)])
    dense = F.array(*[
        F.struct((F.element_at("sums", i + 1) + F.coalesce(F.col(f"_s{i}"), F.lit(0.0))).alias("s"), F.lit(c["lang"]).alias("lang"))
        for i, c in enumerate(classes)
    ])
    # Highest score; classes are in name order and only a strictly higher one replaces, so ties go to the least name.
    top = F.aggregate(F.col("_dense"), F.struct(F.lit(float("-inf")).alias("s"), F.lit(UNDETERMINED).alias("lang")),
                      lambda acc, d: F.when(d["s"] > acc["s"], d).otherwise(acc))
    total = F.aggregate(F.col("_dense"), F.lit(0.0), lambda acc, d: acc + F.exp(d["s"] - F.col("_top.s")))
    narrow = rows.select("_rid", "doc_id", "letters", "sums")
    return narrow.join(added, F.col("_rid") == F.col("_of"), "left").withColumn("_dense", dense).withColumn("_top", top).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("letters"), F.col("_top.lang")).otherwise(F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.col("letters"), F.lit(1.0) / total).otherwise(F.lit(0.0)).alias("score"),
    )
