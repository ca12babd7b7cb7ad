"""One query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemill.llm import alignment, divergence, fingerprints, langid, mixing, neardup, pieces, ruleensemble, rules, runindex, secrets, spans, tokens
from titlemill.llm.common import documents


def op1_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.without_repeats(documents(spark, sf_dir))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.without_repeats(documents(spark, sf_dir))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)],
        F.sha2(secrets.joined_spans(F.col("base")), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("base"), F.col("found")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rules(documents(spark, sf_dir)).select(
        "doc_id", *[f"_stats.{c}" for c in ("n_words", "word_chars", "n_symbols")],
        F.col("_stats.lines.again").alias("n_dup_lines"), "_stats.n_repeat_words", "base_failed", "kept",
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruleensemble.scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir)).drop("_hash")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_run_index, op2_order_minhash, op3_piece_encoding, op4_sentence_spans, op5_source_mixing, op6_secret_scan, op7_quality_rules, op8_token_counts,
        op9_rule_ensemble, op10_near_duplicates, op11_token_alignment, op12_source_divergence, op13_language_id,
    )
}
# DuckDB twins where SQL can say it. Every document is a row; terms are matched by the same pattern.
SOURCE_DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text, row_number() OVER () AS rid
  FROM documents
),
t AS (
  SELECT lang, source, rid, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT lang, source, rid, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gc AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (
  SELECT g.lang, g.source, coalesce(sum(gc.c), 0) AS n, coalesce(max(v.v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN gc USING (lang, source) LEFT JOIN v USING (lang) GROUP BY ALL
),
lc AS (SELECT lang, term, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM gc GROUP BY lang, term),
gp AS (
  SELECT gn.lang, gn.source, k.term, coalesce(gc.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(gc.c, 0) + 1)) // (gn.n + gn.v) AS p
  FROM gn JOIN kept k ON k.lang = gn.lang
  LEFT JOIN gc ON gc.lang = gn.lang AND gc.source = gn.source AND gc.term = k.term
),
lp AS (SELECT lc.lang, lc.term, 1 + (1000000000::HUGEINT * (lc.c + 1)) // (lc.n + v.v) AS q FROM lc JOIN v USING (lang)),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM gn a JOIN gn b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
  UNION ALL
  SELECT gp.lang, gp.source, 'term', gp.term, ((gp.p - lp.q) * (gp.p - lp.q)) // lp.q
  FROM gp JOIN lp USING (lang, term) WHERE gp.c > 0 AND gp.p > lp.q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item) ASC) AS rank FROM parts
) WHERE part = 'pair' OR rank <= 200
"""
SQL: dict[str, str] = {"op12_source_divergence": SOURCE_DIVERGENCE_SQL}
