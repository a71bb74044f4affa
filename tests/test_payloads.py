"""Price payloads: decoding, whole-document rejection and the last bars."""

import json
import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tapeline import schemas
from tapeline.plans.prices import NoPriceData, build_prices, require_prices
from tapeline.plans.returns import build_returns
from tapeline.sources.documents import decode_payloads

DAY = 86_400
START = 1_700_000_000
DOCUMENTS = "ticker string, status int, body string"


def body(close, timestamp=None, **other):
    count = len(close)
    quote = {"open": [1.0] * count, "high": [2.0] * count, "low": [0.5] * count, "volume": [10] * count, **other}
    quote = {k: v for k, v in quote.items() if v is not None}
    stamps = [START + i * DAY for i in range(count)] if timestamp is None else timestamp
    result = {"timestamp": stamps, "indicators": {"quote": [{**quote, "close": close}]}}
    return json.dumps({"chart": {"result": [result]}})


def decode(spark, text, status=200, **options):
    df = spark.createDataFrame([("T", status, text)], DOCUMENTS)
    return decode_payloads(df, **options).orderBy("seq").collect()


def test_columns_and_types(spark):
    df = decode_payloads(spark.createDataFrame([("T", 200, body([1.0]))], DOCUMENTS))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.PRICES]


def test_values_of_a_bar(spark):
    text = body([10.5], open=[None], high=[0], low=[3], volume=[100.9])
    row = decode(spark, text)[0]
    expected_day = datetime.fromtimestamp(START, timezone.utc).date()
    assert row == ("T", expected_day, 0.0, 0.0, 3.0, 10.5, 100, 0)


def test_last_bars_are_taken_after_dropping_missing_closes(spark):
    rows = decode(spark, body([10, None, 12.5, 13, None]), keep_last=2)
    assert [r.close for r in rows] == [12.5, 13.0]
    assert [r.seq for r in rows] == [2, 3]
    assert [r.close for r in decode(spark, body([10]), keep_last=2)] == [10.0]


@pytest.mark.parametrize(
    "text",
    [
        '{"chart":',
        "",
        "[]",
        "null",
        "<html>too many requests</html>",
        '{"other": 1}',
        '{"chart":{"result":null}}',
        '{"chart":{"result":[]}}',
        '{"chart":{"result":[null]}}',
        '{"chart":{"result":[{"timestamp":[1]}]}}',
        '{"chart":{"result":[{"indicators":{"quote":[{"close":[1]}]}}]}}',
        body([1, 2, 3]) + " and more",
        body([1, 2, 3]) + body([4]),
        body([1, 2, 3]) + "," + body([4]),
        *[body([1, 2, 3])[:-n] for n in range(1, 7)],
        body(["x", 2, 3]),
        body([1], timestamp=[START, START + DAY, START + 2 * DAY]),
        body([1, 2], open=[1]),
        body([1, 2], open=None),
        body([1, 2], volume=[1, float("nan")]),
        body([1, 2], volume=[1, float("inf")]),
        body([1, 2], timestamp=[START, None]),
        body([1, 2], timestamp=[START, 1e12]),
        body([None, None]),
        body([]),
    ],
)
def test_undecodable_documents_give_no_rows(spark, text):
    assert decode(spark, text) == []


def test_numbers_may_be_texts(spark):
    rows = decode(spark, body(["1.5", 2.0, None], open=["7", None, "x"], volume=["12", 3, 4]))
    assert [(r.close, r.open, r.volume) for r in rows] == [(1.5, 7.0, 12), (2.0, 0.0, 3)]
    assert decode(spark, body([1.0, 2.0], open=[1, "x"])) == []


def test_volumes_up_to_the_largest_integer(spark):
    assert [r.volume for r in decode(spark, body([1], volume=[9_220_000_000_000_000_000]))] == [9_220_000_000_000_000_000]
    assert decode(spark, body([1], volume=[9.3e18])) == []


def test_other_documents_survive_a_bad_one(spark):
    rows = [("A", 200, body([1, 2])), ("B", 200, "{"), ("C", 429, body([1, 2])), ("D", 200, None), ("E", 200, body([5]))]
    df = decode_payloads(spark.createDataFrame(rows, DOCUMENTS))
    assert sorted({r.ticker for r in df.collect()}) == ["A", "E"]


def test_short_arrays_are_fine_beyond_the_last_kept_bar(spark):
    assert [r.close for r in decode(spark, body([1, 2, None], open=[1, 1], volume=[1, 1]))] == [1.0, 2.0]


def test_values_beyond_the_timestamps_are_ignored(spark):
    assert [r.close for r in decode(spark, body([1, 2, 3], timestamp=[START, START + DAY]))] == [1.0, 2.0]


def test_not_a_number_prices_are_missing_but_keep_the_row(spark):
    rows = decode(spark, body([1, float("nan")], open=[float("nan"), 1]))
    assert [(r.open, r.close) for r in rows] == [(None, 1.0), (1.0, None)]


def test_days_do_not_depend_on_the_session_time_zone(spark):
    text = body([1, 2, 3], timestamp=[0, DAY - 1, -1])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        days = [r.date for r in decode(spark, text)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert days == [date(1970, 1, 1), date(1970, 1, 1), date(1969, 12, 31)]


def test_window_bounds_are_inclusive(spark):
    end = datetime.fromtimestamp(START, timezone.utc)
    stamps = [START - 7 * DAY - 1, START - 7 * DAY, START, START + 1]
    rows = decode(spark, body([1, 2, 3, 4], timestamp=stamps), as_of=end)
    assert [r.close for r in rows] == [2.0, 3.0]


def test_parts_of_one_series_are_cut_together(spark):
    rows = [("T", 200, body([1, 2, 3]), 0), ("T", 200, body([4]), 1), ("U", 200, body([7]), 5)]
    df = spark.createDataFrame(rows, DOCUMENTS + ", part bigint")
    closes = sorted((r.ticker, r.close) for r in build_prices(df, keep_last=2).collect())
    assert closes == [("T", 3.0), ("T", 4.0), ("U", 7.0)]


def test_universe_limits_the_symbols(spark):
    rows = [("A", 200, body([1, 2])), ("B", 200, body([1]))]
    universe = spark.createDataFrame([("B",)], "ticker string")
    prices = build_prices(spark.createDataFrame(rows, DOCUMENTS), universe)
    assert [r.ticker for r in prices.collect()] == ["B"]


def test_equal_days_are_not_merged(spark):
    rows = decode(spark, body([1, 2], timestamp=[START, START + 60]))
    assert len({r.date for r in rows}) == 1 and len(rows) == 2


def test_no_price_at_all_raises(spark):
    prices = build_prices(spark.createDataFrame([("A", 500, "x")], DOCUMENTS))
    with pytest.raises(NoPriceData, match="No price data retrieved"):
        require_prices(prices)


def test_wrong_columns_are_refused(spark):
    with pytest.raises(schemas.SchemaMismatch, match="missing column body"):
        decode_payloads(spark.createDataFrame([("A", 200)], "ticker string, status int"))
    with pytest.raises(schemas.SchemaMismatch, match="status is string"):
        decode_payloads(spark.createDataFrame([("A", "200", "")], "ticker string, status string, body string"))


def test_round_trip_of_random_series(spark):
    generator = random.Random(7)
    documents, expected = [], []
    for number in range(60):
        closes = [generator.choice([None, round(generator.uniform(0, 500), 2)]) for _ in range(generator.randint(1, 9))]
        volumes = [generator.choice([None, 0, generator.randint(1, 10**12)]) for _ in closes]
        documents.append((f"T{number}", 200, body(closes, volume=volumes)))
        expected += [(f"T{number}", i, c, v or 0) for i, (c, v) in enumerate(zip(closes, volumes)) if c is not None]
    df = decode_payloads(spark.createDataFrame(documents, DOCUMENTS).repartition(5))
    found = [(r.ticker, r.seq, r.close, r.volume) for r in df.collect()]
    assert sorted(found) == sorted(expected)


def test_one_exchange_serves_last_bars_and_returns(spark):
    rows = [("T", 200, body([1, 2, 3]), 0), ("T", 200, body([4]), 1)]
    prices = build_prices(spark.createDataFrame(rows, DOCUMENTS + ", part bigint"))
    returns = build_returns(prices, split_rows=None)
    assert [(r.prev_close, r.close) for r in returns.collect()] == [(4.0, 3.0)]
    plan = returns._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([("T", 200, body([1, 2]))], DOCUMENTS).where(F.col("ticker") != "x")
    plan = build_prices(df, keep_last=2).where(F.col("close") > 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "Exchange" not in plan
