"""Returns: previous rows, missing values and long series."""

import math
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeline.functions import numbers
from tapeline.operators import keys, series
from tapeline.plans import recap
from tapeline.plans.returns import build_returns, top_performers

PRICES = "ticker string, date date, close double, seq bigint"
FIRST = date(2024, 1, 1)


def prices(spark, rows):
    table = [(t, FIRST + timedelta(days=d), c, i) for i, (t, d, c) in enumerate(rows)]
    return spark.createDataFrame(table, PRICES)


def returns(spark, rows, **options):
    return [tuple(r) for r in build_returns(prices(spark, rows), **options).orderBy("seq").collect()]


EDGES = [
    ("a", 1, 10.0), ("a", 2, 11.0), ("a", 2, 12.0),
    ("g", 1, 10.0), ("g", 4, 9.9),
    ("b", 1, 5.0),
    ("c", 1, 0.0), ("c", 2, 3.0),
    ("d", 1, 0.0), ("d", 2, 0.0),
    (None, 1, 1.0), (None, 2, 2.0),
    ("e", 1, 4.0), ("e", 2, None), ("e", 3, 8.0),
    ("f", 1, 0.0), ("f", 2, -1.0),
]


def test_edge_rows(spark):
    found = {(r[0], r[1].day - 1, r[6]): r for r in returns(spark, EDGES)}
    assert set(k[0] for k in found) == {"a", "g", "c", "d", "e", "f"}
    assert [round(r[5], 4) for k, r in sorted(found.items()) if k[0] == "a"] == [10.0, 9.0909]
    gap = [r for k, r in found.items() if k[0] == "g"][0]
    assert gap[3] == 10.0
    assert [r[5] for k, r in found.items() if k[0] == "c"] == [math.inf]
    assert [r[5] for k, r in found.items() if k[0] == "d"] == [None]
    assert [r[5] for k, r in found.items() if k[0] == "f"] == [-math.inf]
    # A missing close keeps its row with missing changes; the row after it has no previous close and goes.
    assert [r[2:6] for k, r in found.items() if k[0] == "e"] == [(None, 4.0, None, None)]


def test_same_as_pandas_shift(spark):
    generator = random.Random(3)
    rows = [
        (generator.choice("abcdef"), generator.randint(1, 20), generator.choice([None, 0.0, generator.uniform(1, 9)]))
        for _ in range(400)
    ]
    frame = pd.DataFrame(
        [(t, FIRST + timedelta(days=d), c, i) for i, (t, d, c) in enumerate(rows)],
        columns=["ticker", "date", "close", "seq"],
    ).sort_values(["ticker", "date", "seq"])
    frame["prev_close"] = frame.groupby("ticker")["close"].shift(1)
    frame = frame.dropna(subset=["prev_close"])
    frame["return_pct"] = (frame["close"] - frame["prev_close"]) / frame["prev_close"] * 100
    expected = {r.seq: r.return_pct for r in frame.itertuples()}
    found = {r[6]: math.nan if r[5] is None else r[5] for r in returns(spark, rows)}
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == value or (math.isnan(found[key]) and math.isnan(value))


@pytest.mark.parametrize("split_rows", [0, 5, 40, 1_000])
def test_long_series_are_split_without_a_difference(spark, split_rows):
    generator = random.Random(split_rows)
    rows = []
    for i in range(1_500):
        ticker = generator.choice(["hot", "hot", "warm", f"t{generator.randint(0, 40)}", None])
        day = 7 if generator.random() < 0.4 else generator.randint(1, 300)
        rows.append((ticker, day, generator.choice([None, 0.0, generator.uniform(1, 9)])))
    generator.shuffle(rows)
    df = prices(spark, rows).repartition(7)

    def result(limit):
        frame = build_returns(df, split_rows=limit)
        return sorted(map(str, frame.collect()))

    assert result(split_rows) == result(None)


def test_more_hot_keys_than_are_broadcast(spark):
    rows = [(f"t{i % 5_000}", i // 5_000, float(i % 7)) for i in range(20_000)]
    df = prices(spark, rows).repartition(5)
    options = {"key": "ticker", "order": ["date", "seq"], "value": "close", "out": "before"}
    found = [
        sorted(map(str, series.previous_value(df, split_rows=limit, most_broadcast=most, **options).collect()))
        for limit, most in ((2, 100), (2, 100_000), (None, 0))
    ]
    assert found[0] == found[1] == found[2]


def test_long_series_are_found_from_a_share_of_the_rows(spark):
    rows = [("hot", i % 11, 1.0 + i % 7) for i in range(12_000)] + [(f"t{i % 50}", i, 2.0 + i % 5) for i in range(4_000)]
    df = prices(spark, rows).repartition(6)
    assert [r.ticker for r in keys.long_series(df, "ticker", ["date", "seq"], 8_000).collect()] == ["hot"]
    assert keys.long_series(df, "ticker", ["date", "seq"], 16_000).isEmpty()
    frames = [build_returns(df, split_rows=limit) for limit in (8_000, None)]
    split, plain = (sorted(map(str, frame.collect())) for frame in frames)
    assert split == plain


def test_every_slice_may_be_a_single_row(spark):
    df = prices(spark, [("h", i % 3, float(i)) for i in range(30)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        split = sorted(map(str, build_returns(df, split_rows=0).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert split == sorted(map(str, build_returns(df, split_rows=None).collect()))


def test_short_series_do_not_pay_for_the_split(spark):
    df = build_returns(prices(spark, EDGES))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in final and "BroadcastHashJoin" not in final
    assert final.count("Window [") == 1


def test_invariant_rows(spark):
    rows = [(f"t{i % 9}", i // 9, 1.0 + i) for i in range(100)]
    assert len(returns(spark, rows)) == 100 - 9


def test_top_performers_order_ties_and_colours(spark):
    rows = []
    for ticker, factor in [("z", 1.5), ("y", 1.5), ("x", 1.0), ("w", 0.9), ("v", 1.2)]:
        rows += [(ticker, 1, 100.0), (ticker, 2, 100.0 * factor)]
    rows += [("n", 1, 0.0), ("n", 2, 0.0)]
    table = build_returns(prices(spark, rows))
    top = [(r.ticker, r.direction) for r in top_performers(table).collect()]
    assert top == [("y", "green"), ("z", "green"), ("v", "green"), ("x", "red"), ("w", "red")]
    assert [r.ticker for r in top_performers(table, 10).collect()][-1] == "n"


def test_price_table_is_sorted_with_missing_last(spark):
    rows = [(f"t{i:03}", d, float((i * 37) % 101 + d * i)) for i in range(200) for d in (1, 2)]
    found = [r.return_pct for r in recap.price_table(build_returns(prices(spark, rows).repartition(6))).collect()]
    finite = [v for v in found if v is not None]
    assert finite == sorted(finite, reverse=True) and found[len(finite):] == [None] * (len(found) - len(finite))


def test_market_summary(spark):
    rows = [("a", 1, 10.0), ("a", 2, 11.0), ("b", 1, 10.0), ("b", 2, 9.0), ("c", 1, 5.0), ("c", 2, 5.0)]
    rows += [("d", 1, 0.0), ("d", 2, 0.0)]
    row = recap.market_summary(build_returns(prices(spark, rows))).first()
    assert (row.total_assets, row.distinct_tickers, row.gainers, row.losers) == (4, 4, 1, 1)
    assert row.avg_return_pct == pytest.approx(0.0)


def test_nan_input_counts_as_missing(spark):
    rows = returns(spark, [("a", 1, float("nan")), ("a", 2, 2.0), ("a", 3, float("nan"))])
    assert [(r[2], r[5]) for r in rows] == [(None, None)]


def test_first_and_last_rows_cut_before_the_shuffle(spark):
    df = prices(spark, [("h", i, float(i)) for i in range(50)] + [("k", 1, 1.0)])
    last = series.last_rows(df, "ticker", ["seq"], 2)
    assert sorted(r.close for r in last.collect()) == [1.0, 48.0, 49.0]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange hashpartitioning")[1] and "WindowGroupLimit" in plan
    assert sorted(r.close for r in series.first_rows(df, "ticker", ["seq"], 3).collect()) == [0.0, 1.0, 1.0, 2.0]


def test_percent_change_of_columns(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0)], "d double, b double")
    found = [r[0] for r in df.select(numbers.percent_change(F.col("d"), F.col("b"))).collect()]
    assert found == [25.0, math.inf, -math.inf, None, None]
