"""Datasets stored by month, and sketches of distinct values."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapeline.operators import sketches
from tapeline.plans import recap
from tapeline.sinks import commits, tables

SHAPE = "ticker string, date date, close double"
FIRST = date(2001, 5, 1)


def days(spark, n=120, without=2):
    rows = [(f"t{k % 7}", FIRST + timedelta(days=k), float(k)) for k in range(n)]
    return spark.createDataFrame(rows + [("none", None, None)] * without, SHAPE)


def read(spark, root, as_of, schema, **options):
    return tables.reload_window(spark, str(root), "p", schema, as_of, **options)


@pytest.mark.parametrize("as_of", [datetime(2001, 8, 1, 12, tzinfo=timezone.utc), datetime(2001, 8, 1, tzinfo=timezone.utc), datetime(2001, 5, 3, tzinfo=timezone.utc), datetime(2030, 1, 1, tzinfo=timezone.utc)])
def test_window_is_that_of_the_moments(spark, tmp_path, as_of):
    rows = days(spark)
    tables.materialise(rows, str(tmp_path), "p", day="date")
    start = as_of - timedelta(days=7)
    expected = [r for r in rows.collect() if r.date and start <= datetime(r.date.year, r.date.month, r.date.day, tzinfo=timezone.utc) <= as_of]
    assert sorted(read(spark, tmp_path, as_of, rows.schema).collect()) == sorted(expected)


def test_other_months_are_not_opened(spark, tmp_path):
    rows = days(spark)
    stored = tables.materialise(rows, str(tmp_path), "p", day="date")
    assert stored.columns == rows.columns and stored.count() == 122
    window = read(spark, tmp_path, datetime(2001, 8, 1, 12, tzinfo=timezone.utc), rows.schema)
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert f"({tables.MONTH}" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date,2001-07-26)" in plan.split("PushedFilters: [")[1].split("]")[0]
    spoilt = 0
    for file in Path(commits.current(spark, str(tmp_path / "p"))).glob(f"{tables.MONTH}=*/*.parquet"):
        if file.parent.name.split("=")[1] not in ("200107", "200108"):
            file.write_bytes(b"not parquet")
            spoilt += 1
    assert spoilt >= 3 and window.count() == 7
    with pytest.raises(Exception):
        tables.reload(spark, str(tmp_path), "p", rows.schema).agg(F.sum("close")).collect()


def test_rows_without_a_day_and_no_rows(spark, tmp_path):
    rows = days(spark, 3)
    tables.materialise(rows, str(tmp_path), "p", day="date")
    back = tables.reload(spark, str(tmp_path), "p", rows.schema)
    assert back.schema.names == rows.columns and sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    tables.materialise(rows.where("false"), str(tmp_path), "p", day="date")
    assert tables.reload(spark, str(tmp_path), "p", rows.schema).collect() == []
    assert read(spark, tmp_path, datetime(2001, 5, 3), rows.schema).collect() == []


def test_union_of_sketches(spark):
    rows = spark.range(400_000).select((F.col("id") % 50_000).cast("string").alias("v"), (F.col("id") % 9).alias("batch"))
    stored = sketches.distinct_sketches(rows, "v", ["batch"])
    one = sketches.approximate_distinct(stored.unionAll(stored), "n").first().n
    assert abs(one - 50_000) <= 1_000
    assert sketches.approximate_distinct(stored.repartition(7), "n").first().n == one
    per_batch = sketches.approximate_distinct(stored, "n", ["batch"]).collect()
    exact = {r.batch: r.n for r in rows.groupBy("batch").agg(F.count_distinct("v").alias("n")).collect()}
    assert all(abs(r.n - exact[r.batch]) <= 0.02 * exact[r.batch] for r in per_batch)


def test_sketches_of_nothing(spark):
    nulls = spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "v string, batch int")
    stored = sketches.distinct_sketches(nulls, "v", ["batch"])
    assert {r.batch: r.n for r in sketches.approximate_distinct(stored, "n", ["batch"]).collect()} == {1: 0, 2: 1}
    assert sketches.approximate_distinct(stored.where("false"), "n").first().n == 0


def test_approximate_summary_has_no_shuffle_by_ticker(spark):
    returns = spark.createDataFrame([("a", FIRST, 1.0, 1.0, 0.0, 0.5, 1), ("b", FIRST, 1.0, 1.0, 0.0, -0.5, 2)], "ticker string, date date, close double, prev_close double, daily_return double, return_pct double, seq bigint")
    found = recap.market_summary(returns, approximate=True)
    assert found.collect() == recap.market_summary(returns).collect()
    assert "hashpartitioning(ticker" not in found._jdf.queryExecution().executedPlan().toString()
