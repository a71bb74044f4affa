"""The sieve before the exact count of repeated keys."""

import random

import pytest
from pyspark.sql import functions as F

from tapeline.operators import duplicates, sieve

KEY = ["ticker", "date"]


def table(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, n int")


def plain(rows):
    counts = {}
    for t, d, _ in rows:
        counts[t, d] = counts.get((t, d), 0) + 1
    return sorted((x for x in rows if counts[x[0], x[1]] > 1), key=str)


def singles(spark, n=20_000, repeats=40):
    rows = spark.range(n).select(F.concat(F.lit("T"), F.col("id")).alias("ticker"), F.lit("2024-01-02").cast("date").alias("date"), F.col("id").cast("int").alias("n"))
    return rows.unionAll(rows.where(f"n % {n // repeats} = 0"))


@pytest.mark.parametrize("split_rows", [1_000_000, 3])
def test_equals_the_plain_count(spark, split_rows):
    from datetime import date

    draw = random.Random(2)
    rows = [(draw.choice(["a", "b", None, f"t{k}"]), draw.choice([None, date(2024, 1, 1 + k % 9)]), k) for k in range(400)]
    found = duplicates.duplicate_rows(table(spark, rows), KEY, split_rows=split_rows)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def test_nothing_repeats(spark):
    assert duplicates.duplicate_rows(singles(spark).dropDuplicates(KEY), KEY).count() == 0
    assert duplicates.duplicate_rows(table(spark, []), KEY).count() == 0


def test_single_keys_stay_where_they_are_read(spark):
    df = singles(spark)
    cells = sieve.count_sketch(df, KEY).where("n > 1")
    bits = sieve.size_of(cells.count())
    passed = sieve.passing(df, KEY, sieve.bitmap(cells, bits), bits)
    assert passed.where(f"n % {20_000 // 40} = 0").count() == 80  # none is lost
    assert passed.count() - 80 <= 20_000 / 16 * 1.3


def test_rows_pass_the_sieve_before_every_exchange(spark):
    """In the plan, the scan's rows reach an exchange or a join through the bitmap only."""
    plan = duplicates.duplicate_rows(singles(spark), KEY)._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("Range (0")
    assert scans and plan.count("(getbit(") == scans
    for part in plan.split("Exchange hashpartitioning")[1:]:
        assert "getbit" in part


def test_a_full_bitmap_loses_nothing(spark):
    df = singles(spark, 3_000, 300)
    cells = sieve.count_sketch(df, KEY).where("n > 1")
    bits = sieve.size_of(cells.count(), most_bits=64)
    assert bits == 64
    assert sieve.passing(df, KEY, sieve.bitmap(cells, bits), bits).where("n % 10 = 0").count() == 600


def test_sketches_merge(spark):
    df = singles(spark, 500, 50)
    whole = {tuple(x) for x in sieve.count_sketch(df, KEY).collect()}
    parts = [sieve.count_sketch(df.where(F.col("n") % 3 == k), KEY) for k in range(3)]
    assert {tuple(x) for x in sieve.merged(*parts).collect()} == whole
