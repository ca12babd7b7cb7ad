"""Compare every query with its SQL: `python tests/check_queries.py [sf] [name ...]`."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()


def compare(spark, connection, sf_dir, name):
    """None if both sides agree, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect())
    if name not in entry.oracle_sql():
        return f"no SQL, {len(ours)} rows"
    relation = connection.execute(entry.oracle_sql()[name])
    their_columns = [d[0] for d in relation.description]
    if sorted(their_columns) != columns:
        return f"columns {columns} and {sorted(their_columns)}"
    at = [their_columns.index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in at)) for r in relation.fetchall())
    if ours == theirs:
        return None if ours else "both sides are empty"
    only_ours = sorted(set(ours) - set(theirs))[:2]
    only_theirs = sorted(set(theirs) - set(ours))[:2]
    return f"{len(ours)} and {len(theirs)} rows\n  ours   {only_ours}\n  theirs {only_theirs}"


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        started = time.monotonic()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.monotonic() - started:.1f} s)", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
