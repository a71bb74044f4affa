"""The whole chain over landed documents, and its stored form."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tapeline.plans import metrics
from tapeline.plans.prices import NoPriceData
from tapeline.plans.quality import QualityGateFailed
from tapeline.plans.refresh import refresh
from tapeline.settings import default_universe
from tapeline.sinks import tables

MOMENT = datetime(2024, 3, 8, 12, tzinfo=timezone.utc)
DOCUMENTS = "ticker string, status int, body string"
DAY = 86_400


def payload(index):
    start = int(MOMENT.timestamp()) - 5 * DAY
    closes = [100.0 + index, 101.0 + index, None, 102.0 + index, 103.0 + 2 * index]
    quote = {k: closes for k in ("open", "high", "low")}
    quote |= {"close": closes, "volume": [1000] * 5}
    result = {"timestamp": [start + i * DAY for i in range(5)], "indicators": {"quote": [quote]}}
    return json.dumps({"chart": {"result": [result]}})


def feed(symbol):
    items = "".join(f"<item><title>{symbol} {i}</title><link>http://n/{i}</link></item>" for i in range(6))
    return f"<rss><channel>{items}</channel></rss>"


@pytest.fixture(scope="module")
def landed(spark):
    symbols = [r.ticker for r in default_universe(spark).orderBy("position").collect()]
    payloads = [(s, 200, payload(i)) for i, s in enumerate(symbols)]
    feeds = [(s, 200, feed(s)) for s in symbols]
    return spark.createDataFrame(payloads, DOCUMENTS), spark.createDataFrame(feeds, DOCUMENTS)


def test_full_refresh(spark, landed, tmp_path):
    universe = default_universe(spark)
    stored = refresh(*landed, universe, str(tmp_path), MOMENT)
    assert (stored["prices"].count(), stored["returns"].count(), stored["news"].count()) == (104, 52, 156)
    quality = stored["quality_metrics"].first()
    assert (quality.quality_score, quality.checks_passed, quality.failed_checks) == (1.0, 5, "None")

    prices = stored["price_metrics"].first()
    assert (prices.num_records, prices.num_tickers, prices.failed_tickers) == (104, 52, "None")
    assert prices.date_range == "2024-03-06 00:00:00 to 2024-03-07 00:00:00"
    assert prices.preview.splitlines()[:2] == [
        "ticker,date,open,high,low,close,volume",
        "AAPL,2024-03-06,102.0,102.0,102.0,102.0,1000",
    ]
    assert len(prices.preview.splitlines()) == 11
    news = stored["news_metrics"].first()
    assert (news.num_news, news.num_tickers_with_news) == (156, 52)
    assert news.preview.splitlines()[1] == "AAPL,AAPL 0,N/A,N/A,http://n/0"
    returns = stored["returns_metrics"].first()
    assert returns.num_records == 52 and returns.top_gainers.startswith("ticker,return_pct\nETH-USD,")

    recap = {r.section: r for r in stored["recap_metrics"].collect()}
    assert {k: r.rows for k, r in recap.items()} == {
        "summary": 1, "summary_lines": 6, "top_performers": 5, "price_table": 52, "news_digest": 52, "quality_lines": 7
    }
    assert all(r.size_kb > 0 and r.path.endswith("run_date=20240308") for r in recap.values())
    summary = spark.read.parquet(str(tmp_path / "recap" / "summary")).first()
    assert summary.title == "Daily Market Recap - March 08, 2024"
    assert (summary.total_assets, summary.gainers, summary.losers, summary.quality_score_label) == (52, 52, 0, "100.0%")
    lines = spark.read.parquet(str(tmp_path / "recap" / "summary_lines")).orderBy("line_no").collect()
    assert [r.line for r in lines][1:] == [
        "Market Overview:",
        "• Total Assets Tracked: 52",
        f"• Average Return: {summary.avg_return_pct:.2f}%",
        "• Gainers: 52 | Losers: 0",
        "• Data Quality Score: 100.0%",
    ]
    lines = spark.read.parquet(str(tmp_path / "recap" / "quality_lines")).orderBy("line_no").collect()
    assert [r.line for r in lines][:3] == [
        "Quality Score: 100.0%", "Checks Passed (5):", "✓ Data completeness: 100.0% (>= 80.0%)"
    ]


def test_refresh_replaces_a_run_of_the_same_day_only(spark, landed, tmp_path):
    universe = default_universe(spark)
    payloads, feeds = landed
    refresh(payloads, feeds, universe, str(tmp_path), datetime(2024, 3, 7, tzinfo=timezone.utc))
    refresh(payloads, feeds, universe, str(tmp_path), MOMENT)
    fewer = payloads.where(F.col("ticker") < "D")
    refresh(fewer, feeds, universe, str(tmp_path), MOMENT)

    def rows(section):
        stored = spark.read.parquet(str(tmp_path / "recap" / section)).groupBy("run_date").count().collect()
        return {str(r.run_date): r["count"] for r in stored}

    assert rows("price_table") == {"20240307": 52, "20240308": fewer.count()}
    refresh(payloads, feeds.withColumn("status", F.lit(503)), universe, str(tmp_path), MOMENT)
    assert rows("news_digest") == {"20240307": 52}


def test_no_price_aborts_and_keeps_what_is_stored(spark, landed, tmp_path):
    universe = default_universe(spark)
    payloads, feeds = landed
    stored = refresh(payloads, feeds, universe, str(tmp_path), MOMENT)
    with pytest.raises(NoPriceData):
        refresh(payloads.withColumn("status", F.lit(429)), feeds, universe, str(tmp_path), MOMENT)
    assert tables.reload(spark, str(tmp_path), "prices", stored["prices"].schema).count() == 104
    assert len([p for p in (tmp_path / "prices").iterdir() if p.name.startswith("version-")]) == 1


def test_no_news_is_allowed(spark, landed, tmp_path):
    universe = default_universe(spark)
    payloads, feeds = landed
    stored = refresh(payloads, feeds.withColumn("status", F.lit(503)), universe, str(tmp_path), MOMENT)
    assert stored["news"].count() == 0
    news = stored["news_metrics"].first()
    assert (news.num_news, news.num_tickers_with_news, news.preview) == (0, 0, "No news")
    rows = {r.section: r.rows for r in stored["recap_metrics"].collect()}
    assert rows["news_digest"] == 0 and rows["price_table"] == 52


def test_gate_and_failed_symbols(spark, landed, tmp_path):
    universe = default_universe(spark)
    payloads, feeds = landed
    few = payloads.where(F.col("ticker").isin("AAPL", "V"))
    with pytest.raises(QualityGateFailed):
        refresh(few, feeds, universe, str(tmp_path), MOMENT, min_score=1.0)
    stored = refresh(few, feeds, universe, str(tmp_path), MOMENT)
    assert stored["quality_summary"].first().quality_score == 0.8
    failed = stored["price_metrics"].first()
    assert failed.num_failed == 50 and failed.failed_tickers.startswith("MSFT, GOOGL, AMZN")


def test_window_limit(spark, landed, tmp_path):
    early = datetime(2024, 3, 5, tzinfo=timezone.utc)
    stored = refresh(*landed, default_universe(spark), str(tmp_path), early, limit_to_window=True)
    assert {str(r.date) for r in stored["prices"].collect()} == {"2024-03-03", "2024-03-04"}


def test_reload_has_the_same_rows(spark, landed, tmp_path):
    news = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    again = tables.materialise(news, str(tmp_path), "t")
    assert sorted(map(tuple, again.collect()), key=str) == [("a", 1), ("b", None)]
    assert again.schema == news.schema


def test_metrics_of_news_follow_the_symbol_order_without_a_universe(spark):
    rows = [("b", "t", "p", "d", "l", 0), ("a", "u", "p", "d", "l", 0)]
    df = spark.createDataFrame(
        rows, "ticker string, title string, publisher string, published_date string, link string, seq bigint"
    )
    assert metrics.news_metrics(df).first().preview.splitlines()[1] == "a,u,p,d,l"
