"""Scalar expressions against Python's own formatting."""

import math
import random
from datetime import date, datetime, timezone

import numpy as np
from pyspark.sql import functions as F

from tapeline.functions import dates, numbers, text
from tapeline.sources.manifest import request_manifest


def values():
    generator = random.Random(11)
    fixed = [2.675, 0.125, 0.375, 1.005, 0.0, -0.0, -0.004, 1e7, 1e-3, 1e-4, 9.9e-5, 1e16, 9999999999999998.0, 1e22]
    fixed += [1e-300, 1.7976931348623157e308, 123456789.123, 1e15, 12345678901234.5, -1e7, -2.5e-7, 100.0, 1 / 3]
    drawn = [generator.uniform(-1e6, 1e6) for _ in range(3_000)]
    drawn += [round(generator.uniform(0, 1_000), 3) for _ in range(3_000)]
    drawn += [generator.uniform(-1, 1) * 10 ** generator.randint(-12, 20) for _ in range(3_000)]
    return fixed + drawn


def evaluate(spark, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x double")
    return [r[1] for r in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


def test_fixed_texts_equal_python(spark):
    items = [v for v in values() if abs(v) < 1e13] + [math.nan, math.inf, -math.inf]
    assert evaluate(spark, items, numbers.money_text) == [f"${v:.2f}" for v in items]
    assert evaluate(spark, items, numbers.percent_text) == [f"{v:.2f}%" for v in items]
    small = [v for v in items if abs(v) < 1e11 or not math.isfinite(v)]
    assert evaluate(spark, small, numbers.ratio_text) == [f"{v:.1%}" for v in small]


def test_shortest_text_equals_python(spark):
    items = [v for v in values() if abs(v) <= 1e16] + [1e22, 1e-300, math.inf, -math.inf]
    assert evaluate(spark, items, numbers.shortest_text) == [repr(v) for v in items]


def test_rounding_equals_numpy(spark):
    items = [v for v in values() if abs(v) < 1e300]
    assert evaluate(spark, items, numbers.round_half_even) == [float(np.round(np.float64(v), 2)) for v in items]


def test_missing_and_zero(spark):
    assert evaluate(spark, [None, 0.0, 3.0], numbers.or_zero) == [0.0, 0.0, 3.0]
    assert evaluate(spark, [None, math.nan, 3.0], numbers.nan_as_null) == [None, None, 3.0]
    assert evaluate(spark, [None], numbers.percent_text) == ["nan%"]


def test_search_phrase(spark):
    names = ["AAPL", "BTC-USD", "USD", "-USD-USD", "A-USDX"]
    df = spark.createDataFrame([(n,) for n in names], "ticker string")
    found = [r[0] for r in df.select(text.search_phrase(F.col("ticker"))).collect()]
    assert found == ["AAPL stock", "BTC crypto", "USD stock", " crypto crypto", "A-USDX stock"]


def test_request_manifest(spark):
    moment = datetime(2024, 3, 8, 12, 0, 0, 900_000, tzinfo=timezone.utc)
    df = spark.createDataFrame([("BTC-USD",), ("V",)], "ticker string")
    crypto, stock = request_manifest(df, moment).collect()
    end = int(moment.timestamp())
    assert (crypto.from_ts, crypto.to_ts) == (end - 7 * 86_400, end)
    assert crypto.price_url.endswith(f"/chart/BTC-USD?period1={end - 7 * 86_400}&period2={end}&interval=1d")
    assert "?q=BTC%20crypto&hl=en-US" in crypto.news_url and "?q=V%20stock&" in stock.news_url


def test_dates(spark):
    df = spark.createDataFrame([("2024-02-29", date(2024, 2, 29)), ("soon", None)], "s string, d date")
    found = df.select(
        dates.coerce_date(F.col("s"), "string").alias("a"), dates.coerce_date(F.col("d"), "date").alias("b")
    ).collect()
    assert [tuple(r) for r in found] == [(date(2024, 2, 29), date(2024, 2, 29)), (None, None)]
    moment = datetime(2024, 2, 9, 1, tzinfo=timezone.utc)
    stamps = df.select(dates.run_stamp(moment), dates.run_title(moment)).first()
    assert tuple(stamps) == ("20240209", "February 09, 2024")


def test_epoch_days_invert(spark):
    df = spark.range(-4000, 40000, 37).select(F.date_from_unix_date(F.col("id").cast("int")).alias("d"))
    again = df.where(dates.epoch_to_date(dates.date_to_epoch(F.col("d")) + 86_399) != F.col("d"))
    assert again.isEmpty()


def test_joined_texts(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>")
    assert [r[0] for r in df.select(text.joined_or_none(F.col("x"), ", ")).collect()] == ["a, b", "None"]
