"""A corpus pipeline: quality rules, near-dedup, secret scans, mixing, piece encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from titlemill.llm import mixing, neardup, pieces, rules, secrets
from titlemill.llm.common import documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that neither the base rules nor the robust distance reject."""
    return rules.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: five-word shingles, similarity 0.8."""
    return neardup.representatives(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; keeps every row."""
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out rows until each source is near its target."""
    return mixing.mix(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of what the mix holds, as digests."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("SentencePiece encoding and decoding", piece_encoding),
]

#: No SQL states the robust estimates, the battery's discovery level or the piece encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each writes its rows as Parquet and the next reads them."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
