"""Metrics taken by the jobs that write the datasets."""

from datetime import date

import pytest

from pyspark.sql import functions as F

from tapeline import bindings
from tapeline.plans import metrics
from tapeline.settings import universe_of
from tapeline.sinks import commits, tables

FOLDER = "/root/testdata/sf0.001"
PRICES = "ticker string, date date, close double, seq bigint"


@pytest.mark.parametrize("layout", [{}, {"compact": True}, {"day": "date"}])
def test_values_are_those_of_the_stored_rows(spark, tmp_path, layout):
    orders = bindings.table(spark, FOLDER, "orders")
    prices = bindings.prices_from_orders(orders).repartition(7)
    version = tables.prepare(prices, str(tmp_path), "prices", observe=metrics.price_observations(), **layout)
    first, last = version.df.agg(F.min("date"), F.max("date")).first()
    assert version.observed == {"num_records": orders.count(), "first_date": first, "last_date": last}


@pytest.mark.parametrize("layout", [{}, {"compact": True}, {"day": "date"}])
def test_no_rows(spark, tmp_path, layout):
    nothing = spark.createDataFrame([], PRICES).groupBy("ticker", "date").agg(F.max("close").alias("close"), F.max("seq").alias("seq"))
    version = tables.prepare(nothing, str(tmp_path), "prices", observe=metrics.price_observations(), **layout)
    assert version.observed == {"num_records": 0, "first_date": None, "last_date": None}


def test_days_stay_in_order_within_a_month(spark, tmp_path):
    rows = [("a", date(2024, 1, 1 + (i * 7) % 31), float(i), i) for i in range(500)]
    prices = spark.createDataFrame(rows, PRICES).repartition(5)
    version = tables.prepare(prices, str(tmp_path), "prices", day="date", observe=metrics.price_observations())
    commits.commit(version)
    for file in (tmp_path / "prices").rglob("*.parquet"):
        days = [r.date for r in spark.read.parquet(str(file)).select("date").collect()]
        assert days == sorted(days) and days


def test_rows_computed_twice_count_once(spark, tmp_path):
    """The rows go through an exchange whose map side is computed for the sizes of the slices and again for the write."""
    rows = spark.range(10_000).select(F.col("id").cast("string").alias("ticker"), F.current_date().alias("date"), F.lit(1.0).alias("close"), F.col("id").alias("seq"))
    version = tables.prepare(rows.repartitionByRange(9, "seq"), str(tmp_path), "prices", observe=metrics.price_observations())
    assert version.observed["num_records"] == 10_000


def test_same_metrics_with_a_reading_less(spark, tmp_path):
    universe = universe_of(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, sector string"), "id", "sector")
    rows = [("1", date(2024, 1, 2), 1.0, 0), ("1", None, 2.0, 1), ("3", date(2024, 2, 2), None, 2), (None, None, 4.0, 3)]
    version = tables.prepare(spark.createDataFrame(rows, PRICES), str(tmp_path), "prices", day="date", observe=metrics.price_observations())
    stored = commits.commit(version)
    plain = metrics.price_metrics(stored, universe)
    observed = metrics.price_metrics(stored, universe, root=str(tmp_path), observed=version.observed)
    assert observed.collect() == plain.collect() and observed.columns == plain.columns
    dated = lambda df: df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("date:date")
    assert dated(plain) == 2 and dated(observed) == 1
