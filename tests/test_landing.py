"""Landed files, tables and batches; universes and price tables from elsewhere."""

from datetime import date, datetime

import pytest

from tapeline import schemas
from tapeline.plans import metrics
from tapeline.plans.news import build_news
from tapeline.plans.prices import build_prices, coerce_dates
from tapeline.settings import universe_of
from tapeline.sources import landing
from test_payloads import DOCUMENTS, body


def test_files_are_named_after_their_ticker(spark, tmp_path):
    (tmp_path / "AAPL.json").write_text(body([1.0, 2.0, 3.0]))
    (tmp_path / "BTC-USD.json").write_text(body([7.0]))
    (tmp_path / "BRK.B.json").write_text(body([9.0]))
    (tmp_path / "BAD.json").write_text('{"chart":')
    prices = build_prices(landing.landed_files(spark, str(tmp_path)))
    found = sorted((r.ticker, r.close) for r in prices.collect())
    assert found == [("AAPL", 2.0), ("AAPL", 3.0), ("BRK.B", 9.0), ("BTC-USD", 7.0)]


def test_feed_files(spark, tmp_path):
    text = "<rss>\n<channel>\n<item>\n<title>two\nlines</title>\n</item>\n</channel>\n</rss>\n"
    (tmp_path / "V.xml").write_text(text)
    assert [(r.ticker, r.title) for r in build_news(landing.landed_files(spark, str(tmp_path))).collect()] == [
        ("V", "two\nlines")
    ]


def test_batches_continue_each_other(spark):
    first = spark.createDataFrame([("A", 200, body([1.0, 2.0])), ("B", 200, body([5.0]))], DOCUMENTS)
    second = spark.createDataFrame([("A", 200, body([3.0]))], DOCUMENTS)
    prices = build_prices(landing.landed_batches(first, second))
    assert sorted((r.ticker, r.close) for r in prices.collect()) == [("A", 2.0), ("A", 3.0), ("B", 5.0)]


def test_stored_table(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents = spark.createDataFrame([("A", 200, body([1.0, 2.0]), 0)], DOCUMENTS + ", part bigint")
    documents.write.parquet(path)
    table = landing.landed_table(spark, path)
    assert table.columns == schemas.DOCUMENTS.names
    assert build_prices(table).count() == 2


def test_dates_of_other_tables(spark):
    texts = spark.createDataFrame([("A", "2024-02-29"), ("B", "soon")], "ticker string, date string")
    assert [r.date for r in coerce_dates(texts).orderBy("ticker").collect()] == [date(2024, 2, 29), None]
    moments = spark.createDataFrame([("A", datetime(2024, 2, 29, 23, 59))], "ticker string, date timestamp_ntz")
    assert coerce_dates(moments).first().date == date(2024, 2, 29)
    days = spark.createDataFrame([("A", date(2024, 2, 29))], "ticker string, date date")
    assert coerce_dates(days) is days


def test_universe_of_any_table(spark):
    table = spark.createDataFrame([(3, "x"), (1, "y"), (2, "z")], "id int, sector string")
    universe = universe_of(table, "id", "sector")
    assert [(f.name, f.dataType) for f in universe.schema] == [(f.name, f.dataType) for f in schemas.UNIVERSE]
    prices = spark.createDataFrame([("2",)], "ticker string")
    lines, _ = metrics.failed_lines(metrics.failed_tickers(prices, universe))
    assert lines.first().failed_tickers == "1, 3"


def test_batches_never_share_a_number(spark):
    parted = DOCUMENTS + ", part bigint"
    first = spark.createDataFrame([("A", 200, body([1.0]), 0), ("A", 200, body([2.0]), 1)], parted)
    second = spark.createDataFrame([("A", 200, body([3.0]), 0), ("A", 200, body([4.0]), 1)], parted)
    plain = spark.createDataFrame([("A", 200, body([5.0]))], DOCUMENTS)
    for batches, closes in (
        ([first, second], [1.0, 2.0, 3.0, 4.0]),
        ([first, plain, second], [1.0, 2.0, 5.0, 3.0, 4.0]),
        ([plain, first], [5.0, 1.0, 2.0]),
    ):
        rows = build_prices(landing.landed_batches(*batches), keep_last=None).orderBy("seq").collect()
        assert [r.close for r in rows] == closes and len({r.seq for r in rows}) == len(rows)


def test_part_numbers_beyond_the_room_for_them_raise(spark):
    batch = spark.createDataFrame([("A", 200, body([1.0]), 1 << 20)], DOCUMENTS + ", part bigint")
    with pytest.raises(Exception, match="part number out of range"):
        landing.landed_batches(batch).collect()
