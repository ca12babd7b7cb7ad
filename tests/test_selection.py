import random

from pyspark.sql import functions as F

from titlemill.operators.selection import first_rows
from titlemill.sources.items import scan_unenriched


def test_first_rows_equal_a_full_sort(spark):
    draw = random.Random(7)
    rows = [(i, draw.choice([None, *range(30)])) for i in range(3000)]  # many ties, some nulls
    df = spark.createDataFrame(rows, "id long, age long")
    key = F.coalesce("age", F.lit((1 << 63) - 1))
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    for limit in (0, 1, 7, 100, 1499, 2999, 3000, 5000):
        got = sorted(r["id"] for r in first_rows(df, key, "id", limit).collect())
        assert got == sorted(r[0] for r in ordered[:limit]), limit


def test_scan_takes_the_oldest_without_sorting_all(spark):
    rows = [(str(i), f"t{i}", None if i % 5 else "x", f"2024-01-{1 + i % 28:02d}" if i % 11 else None) for i in range(400)]
    items = spark.createDataFrame(rows, "id string, title string, description string, created_at string").withColumn(
        "created_at", F.to_timestamp("created_at")
    )
    todo = sorted((r for r in rows if r[2] is None), key=lambda r: (r[3] is None, r[3] or "", r[0]))
    got = scan_unenriched(items, 50)
    assert sorted(r["id"] for r in got.collect()) == sorted(r[0] for r in todo[:50])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [created_at" not in plan and "Sort [id" not in plan  # the backlog itself is never ordered
