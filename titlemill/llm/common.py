"""What the operators share: stored intermediate tables, word pattern, bounded blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlemill.session import scratch_folder

#: A word is a run of characters other than ASCII blanks.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"
BLOCK_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once below the shared checkpoint folder and read that copy.

    Cuts lineage, so a lost executor costs a read; the columns stay prunable.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: Column | str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def text_key(docs: DataFrame) -> Column:
    """doc_id and text hash as one key column; equal where both ids are null.

    Its fields are nullable like those of stored tables, so a join on it needs no cast and the
    shuffle for the join serves a window or an aggregate on it, too.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return F.struct("doc_id", F.xxhash64(whole_text()).alias("_hash")).cast(f"struct<doc_id:{kind},_hash:bigint>")


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{BLANK}]+"), lambda w: w != "")


def with_word_counts(df: DataFrame, words: str, out: str) -> DataFrame:
    """`df` with column `out`: the distinct strings of array column `words` and their counts
    (word, cnt), in sorted order; an empty or null array gives an empty one.

    The array is sorted once and its run starts found once, each into a column of its own, so the
    lambdas that read them see column references and a text costs n log n, not n^2. Explode the
    result with `explode_outer` and drop null rows after it: a plain `explode` makes the optimizer
    infer a filter on the array's size and push it, inlined, below these projections.
    """
    ordered, starts = F.col(f"{out}_sorted"), F.col(f"{out}_starts")
    n, m = F.size(ordered), F.size(starts)
    df = df.withColumn(f"{out}_sorted", F.array_sort(F.col(words)))
    df = df.withColumn(f"{out}_starts", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & ((i == 1) | (F.element_at(ordered, i) != F.element_at(ordered, F.greatest(i - 1, F.lit(1))))),
    ))
    counted = F.transform(
        F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
        lambda k: F.struct(
            F.element_at(ordered, F.element_at(starts, F.least(k, m))).alias("word"),
            (F.when(k < m, F.element_at(starts, F.least(k + 1, m))).otherwise(n + 1) - F.element_at(starts, F.least(k, m))).alias("cnt"),
        ),
    )
    df = df.withColumn(out, F.when(n > 0, counted).otherwise(F.array().cast("array<struct<word:string,cnt:int>>")))
    return df.drop(f"{out}_sorted", f"{out}_starts")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hashed(column: Column) -> Column:
    """128 bits of a text as two longs, for keys that must not clash at any corpus size."""
    return F.struct(F.xxhash64(column).alias("a"), F.xxhash64(column, F.lit(1)).alias("b"))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `column` holds about `limit` bytes, or one longer text."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.binary_length(batch.column(at)).fill_null(0).to_pylist()
        begin = held = 0
        for row, size in enumerate(sizes):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
