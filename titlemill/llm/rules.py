"""Quality rules with robust multivariate outliers (operator 7), in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import BLANK, stored, whole_text, words

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: Transformed statistics of a text, each with the standard deviation it is given in groups where
#: its own is near zero: measures that are zero for most texts of a source would else reject the
#: first text that is not zero.
FEATURES: tuple[tuple[str, float], ...] = (
    ("word_length", 0.10),
    ("symbol_rate", 0.04),
    ("dup_line_rate", 0.10),
    ("repeat_rate", 0.05),
    ("length", 0.80),
)
#: A standard deviation is near zero under this share of the given one.
NEAR_ZERO = 0.1
#: Chi-squared quantiles by the number of statistics that vary: of three quarters of all rows (the
#: share that the estimates rest on), and of all but one in 10^9, which is where a text is rejected.
#: At 0, those of five (52.5 is a little further out), where none varies or a group is too small for own estimates.
CORE_SHARE = 0.75
CORE_QUANTILES = (6.626, 1.323, 2.773, 4.108, 5.385, 6.626)
REJECT_QUANTILES = (52.5, 37.32, 41.45, 44.84, 47.88, 52.5)
#: Groups with fewer rows are estimated together.
LEAST_GROUP = 50
STEPS = 4


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where the body uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(found: Column) -> Column:
    """Words that lie in a 5-word window which occurs twice or more in the array `found`.

    Windows are compared by 64-bit hashes of hashes. Only texts with a repeat pay for the sort that
    finds their places; everything is linear or a sort in the length of the text.
    """

    def places(hashes: Column) -> Column:
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(order: Column) -> Column:
            same = lambda k, d: F.coalesce(F.get(order, k + d)["h"] == F.get(order, k)["h"], F.lit(False))
            twice = F.filter(order, lambda s, k: same(k, -1) | same(k, 1))
            spots = F.sort_array(F.transform(twice, lambda s: s["i"]))
            return bind(
                spots,
                lambda p: F.aggregate(
                    F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
                    F.lit(0).cast("long"),
                    lambda a, b: a + b,
                ),
            )

        return bind(tagged, covered)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(places(hashes))

    windows = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(WINDOW)])
    )
    hashed = bind(F.transform(found, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(found) < WINDOW, F.lit(0).cast("long")).otherwise(bind(hashed, count))


def statistics(text: Column) -> Column:
    """Struct of the base statistics of a text that is not null."""
    found = words(text)
    with_word = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))
    # \v and \f come last of the blanks; translate drops characters without a counterpart
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    lines = bind(
        with_word,
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("all"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("again")
        ),
    )
    return bind(
        found,
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            lines.alias("lines"),
            repeated_words(ws).alias("n_repeat_words"),
        ),
    )


def _quadratic(columns: list[str]) -> Column:
    """Squared Mahalanobis distance from `m_i` under the covariance `c_i_j`, by forward
    substitution with the Cholesky factor `l_i_j`."""
    solved: list[Column] = []
    for i in range(len(columns)):
        value = F.col(columns[i]) - F.col(f"m_{i}")
        for j in range(i):
            value = value - F.col(f"l_{i}_{j}") * solved[j]
        solved.append(value / F.col(f"l_{i}_{i}"))
    return sum((s * s for s in solved[1:]), solved[0] * solved[0])


def _estimates(rows: DataFrame, columns: list[str], floors: list[float]) -> DataFrame:
    """Mean and Cholesky factor of the covariance per group of `rows`, and how many columns vary.

    A column whose deviation is near zero has its floor instead and no covariance. In groups too
    small for own estimates the floors bound all deviations from below, and none counts as varying.
    """
    n = len(columns)
    sums = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)]
    sums += [F.covar_pop(columns[i], columns[j]).alias(f"c_{i}_{j}") for i in range(n) for j in range(i + 1)]
    made = rows.groupBy("_lang", "_source").agg((F.count("*") < CORE_SHARE * LEAST_GROUP).alias("_few"), *sums)
    made = made.withColumns({f"near_{i}": F.col(f"c_{i}_{i}") < (NEAR_ZERO * floors[i]) ** 2 for i in range(n)})
    for i in range(n):
        least = F.when(F.col("_few"), floors[i] ** 2).otherwise((NEAR_ZERO * floors[i]) ** 2)
        for j in range(i + 1):
            if i == j:
                value = F.when(F.col(f"near_{i}"), floors[i] ** 2).otherwise(F.greatest(f"c_{i}_{i}", least))
            else:
                value = F.when(F.col(f"near_{i}") | F.col(f"near_{j}"), 0.0).otherwise(F.col(f"c_{i}_{j}"))
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            made = made.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(value, least)) if i == j else value / F.col(f"l_{j}_{j}"))
    varying = sum((F.when(F.col(f"near_{i}"), 0).otherwise(1) for i in range(1, n)), F.when(F.col("near_0"), 0).otherwise(1))
    return made.withColumn("_live", F.when(F.col("_few"), 0).otherwise(varying))


def _by_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    named = groups.withColumnsRenamed({"_lang": "_glang", "_source": "_gsource"})
    on = rows["_lang"].eqNullSafe(named["_glang"]) & rows["_source"].eqNullSafe(named["_gsource"])
    return rows.join(named, on).drop("_glang", "_gsource")


def rules(docs: DataFrame, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`docs` (doc_id, text, lang, source, more) -> `carried` columns, _stats, base_failed, kept.

    _stats has n_words, word_chars, n_symbols, lines (all, again) and n_repeat_words. Rows that pass
    the base rules are judged per language and source: minimum-covariance-determinant estimates
    start at the three quarters of a group nearest its medians and repeat, STEPS times, taking mean
    and covariance of the nearest three quarters. A row is rejected if its squared distance, scaled
    so that those three quarters lie as chi-squared says for the statistics that vary in the group,
    passes the quantile for rejection.

    Texts are read once; the steps run on a stored narrow table unless `carried` asks for more.
    Groups meet in partial aggregates only and their estimates join back, so a source with a third
    of all rows is no task of its own. A null text is an empty one and fails the base rules, as
    does any text of fewer than 10 words; null languages and sources form groups of their own;
    groups under LEAST_GROUP rows are estimated together; repeated rows count each; other columns
    are ignored; no row gives no row.
    """
    text = whole_text()
    s = F.col("_stats")
    rate = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1))
    features = {
        "word_length": F.log(rate(s["word_chars"], s["n_words"]) + 1),
        "symbol_rate": F.sqrt(rate(s["n_symbols"], s["word_chars"])),
        "dup_line_rate": F.sqrt(rate(s["lines"]["again"], s["lines"]["all"])),
        "repeat_rate": rate(s["n_repeat_words"], s["n_words"]),
        "length": F.log(s["n_words"] + F.lit(1.0)),
    }
    columns = [f"_x{i}" for i in range(len(FEATURES))]
    floors = [floor for _, floor in FEATURES]
    failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED_PERCENT * s["n_words"])
    full = stored(
        docs.select(*carried, F.col("lang").alias("_lang"), F.col("source").alias("_source"), statistics(text).alias("_stats"))
        .withColumn("base_failed", failed)
        .withColumns({c: features[name] for c, (name, _) in zip(columns, FEATURES, strict=True)}),
        "statistics",
    )
    judged = full.where(~F.col("base_failed")).select("_lang", "_source", *columns)
    sizes = stored(
        judged.groupBy("_lang", "_source").agg(
            F.count("*").alias("_n"), *[F.percentile_approx(c, 0.5, 1000).alias(f"_mid{i}") for i, c in enumerate(columns)]
        ),
        "groups",
    )
    own = sizes.select("_lang", "_source", (F.col("_n") >= LEAST_GROUP).alias("_own"))

    def grouped(rows: DataFrame) -> DataFrame:
        """Rows under their group, or under no language and source if it is small."""
        return _by_group(rows, own).withColumns(
            {c: F.when(F.col("_own"), F.col(c)) for c in ("_lang", "_source")}
        ).drop("_own")

    rows = grouped(judged)
    start = rows.groupBy("_lang", "_source").agg(
        *[F.percentile_approx(c, 0.5, 1000).alias(f"m_{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, [0.25, 0.75], 1000).alias(f"_q{i}") for i, c in enumerate(columns)],
    )
    half_range = 1.349  # quartile distance of a normal variable in standard deviations
    for i in range(len(columns)):
        spread = (F.col(f"_q{i}")[1] - F.col(f"_q{i}")[0]) / half_range
        start = start.withColumns(
            {
                f"l_{i}_{i}": F.when(spread < NEAR_ZERO * floors[i], floors[i]).otherwise(spread),
                **{f"l_{i}_{j}": F.lit(0.0) for j in range(i)},
            }
        )
    start = start.withColumn("_live", F.lit(0))
    wanted = ["_lang", "_source", "_live", *[f"m_{i}" for i in range(len(columns))], *[f"l_{i}_{j}" for i in range(len(columns)) for j in range(i + 1)]]
    estimate = stored(start.select(*wanted), "estimates")
    distance = _quadratic(columns)
    for _ in range(STEPS):
        measured = _by_group(rows, estimate).select("_lang", "_source", *columns, distance.alias("_d"))
        core = stored(
            measured.groupBy("_lang", "_source").agg(F.percentile_approx("_d", CORE_SHARE, 1000).alias("_core")), "core"
        )
        nearest = _by_group(measured, core).where(F.col("_d") <= F.col("_core"))
        estimate = stored(_estimates(nearest, columns, floors).select(*wanted), "estimates")
    measured = _by_group(rows, estimate).select("_lang", "_source", distance.alias("_d"))
    scale = stored(
        measured.groupBy("_lang", "_source").agg(F.percentile_approx("_d", CORE_SHARE, 1000).alias("_core")), "core"
    )
    final = stored(_by_group(estimate, scale), "limits")
    # a language and source finds its own estimates, or those of the small groups
    key = own.withColumns(
        {"_plang": F.when(F.col("_own"), F.col("_lang")), "_psource": F.when(F.col("_own"), F.col("_source"))}
    )
    named = final.withColumnsRenamed({"_lang": "_plang2", "_source": "_psource2"})
    limits = key.join(
        named, key["_plang"].eqNullSafe(named["_plang2"]) & key["_psource"].eqNullSafe(named["_psource2"])
    ).drop("_own", "_plang", "_psource", "_plang2", "_psource2")
    limits = stored(limits, "limits").withColumnsRenamed({"_lang": "_glang", "_source": "_gsource"})
    on = full["_lang"].eqNullSafe(limits["_glang"]) & full["_source"].eqNullSafe(limits["_gsource"])
    quantile = lambda values: F.get(F.array(*map(F.lit, values)), F.col("_live"))
    scale = F.col("_core") / quantile(CORE_QUANTILES)
    scale = F.when(F.col("_live") == 0, F.greatest(scale, F.lit(1.0))).otherwise(scale)
    inside = distance <= scale * quantile(REJECT_QUANTILES)
    return full.join(limits, on, "left").select(
        *carried, "_stats", "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept")
    )


def passing(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `rules` keeps, all columns as they are.

    Decisions join back by id and text hash, narrow against wide, so equal rows share theirs.
    """
    tagged = docs.withColumn("_hash", F.xxhash64(whole_text()))
    kept = rules(tagged, ("doc_id", "_hash")).where("kept").select(
        F.col("doc_id").alias("_doc"), F.col("_hash").alias("_of")
    ).distinct()
    return tagged.join(
        kept, tagged["doc_id"].eqNullSafe(kept["_doc"]) & (tagged["_hash"] == kept["_of"]), "left_semi"
    ).select(*docs.columns)
