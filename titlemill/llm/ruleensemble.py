"""Quality classifier from a sparse rule ensemble (operator 9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlemill.llm.common import stored, whole_text, words
from titlemill.llm.rules import bind, statistics

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
#: Trees and their depth (paths give the rules), and the weight of the lasso.
TREES = 16
DEPTH = 3
LASSO = 0.001
FEATURES = (
    "words", "word_length", "symbols", "repeated_lines", "repeated_words", "upper", "marks", "digits", "distinct", "lines",
)


def features(text: Column) -> Column:
    """Struct of text statistics, all finite; none depends on ids, labels, language or source."""
    lost = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")
    distinct = bind(words(text), lambda ws: F.size(F.array_distinct(ws)).cast("double"))

    def rates(s: Column) -> Column:
        chars, count = F.greatest(s["word_chars"], F.lit(1)), F.greatest(s["n_words"], F.lit(1))
        values = (
            F.log(s["n_words"] + F.lit(1.0)), s["word_chars"] / count, s["n_symbols"] / chars,
            s["lines"]["again"] / F.greatest(s["lines"]["all"], F.lit(1)), s["n_repeat_words"] / count,
            lost(UPPER) / chars, lost("!?") / count, lost(DIGITS) / chars, distinct / count, s["lines"]["all"] / count,
        )
        return F.struct(*[v.cast("double").alias(n) for n, v in zip(FEATURES, values, strict=True)])

    return bind(statistics(text), rates)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(f"_f.{self.feature}")
        return value > self.bound if self.above else value <= self.bound


Rule = tuple[Condition, ...]


def tree_rules(node, path: Rule = ()) -> set[Rule]:
    """Each path from the root to a node below it, of bounds on one side only the tightest."""
    found: set[Rule] = set()
    if path:
        tight: dict[tuple[str, bool], float] = {}
        for c in path:
            old = tight.get((c.feature, c.above), c.bound)
            tight[c.feature, c.above] = max(old, c.bound) if c.above else min(old, c.bound)
        found.add(tuple(sorted((Condition(f, a, b) for (f, a), b in tight.items()), key=repr)))
    if node.subtreeDepth() > 0:
        split = node.split()
        feature, bound = FEATURES[split.featureIndex()], float(split.threshold())
        found |= tree_rules(node.leftChild(), (*path, Condition(feature, False, bound)))
        found |= tree_rules(node.rightChild(), (*path, Condition(feature, True, bound)))
    return found


def _holds(rule: Rule) -> Column:
    whole = rule[0].column()
    for c in rule[1:]:
        whole = whole & c.column()
    return whole.cast("double")


@dataclass(frozen=True)
class RuleModel:
    """Intercept and weighted rules over the statistics struct `_f`."""

    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + _holds(rule) * F.lit(weight)
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, seed: int = 5) -> RuleModel:
    """Rules and weights from `labelled` (_f, label 0.0 or 1.0), all of its rows.

    A forest of shallow trees gives the rules; a logistic model with an L1 penalty over their truth
    values keeps few. Both are fitted by distributed passes. Without rows of both labels the score
    is the share of label 1, one half without any.
    """
    share = labelled.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    if not share["n"] or share["share"] in (0.0, 1.0):
        sure = 0.5 if not share["n"] else share["share"]
        return RuleModel({0.0: -30.0, 1.0: 30.0}.get(sure, 0.0), ())
    vector = labelled.select("label", "_f", array_to_vector(F.array(*[F.col(f"_f.{n}") for n in FEATURES])).alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", subsamplingRate=0.5, seed=seed
    ).fit(vector.select("label", "features"))
    found = sorted({r for tree in forest.trees for r in tree_rules(tree._call_java("rootNode"))}, key=repr)
    if not found:
        return RuleModel(0.0, ())
    truth = labelled.select("label", array_to_vector(F.array(*map(_holds, found))).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(truth)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(float(lasso.intercept), tuple((r, w) for r, w in zip(found, weights, strict=True) if w))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """`docs` (doc_id, text, more), `labels` (doc_id, quality) -> doc_id, held_out, score, predicted.

    Labels of rows whose crc32(doc_id) mod 5 is 0 are not learned from. Texts are read once into a
    stored narrow table of statistics; the compiled rules score it as one column expression.

    A null or empty text has statistics of zero and a score like any other; a null doc_id is held
    out and has no label; labels other than 0 and 1 are left out; a document with several labels
    counts once for each; repeated rows are scored each; other columns are ignored; no row gives
    no row.
    """
    table = stored(docs.select("doc_id", features(whole_text()).alias("_f")), "features")
    known = labels.where(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("label")
    )
    labelled = stored(
        table.where(~held_out(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("_id")).select("_f", "label"), "labelled"
    )
    score = fit(labelled).score()
    return table.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
