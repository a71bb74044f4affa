"""The five checks, their outcomes, the score and the warning records."""

from datetime import date, timedelta

import pytest

from tapeline.operators import duplicates
from tapeline.plans import metrics, quality
from tapeline.plans.prices import build_prices  # noqa: F401  (import order check of the package)
from tapeline.plans.returns import build_returns
from tapeline.settings import Thresholds, default_universe

PRICES = "ticker string, date date, close double, seq bigint"
DAY = date(2024, 5, 1)


def table(spark, rows):
    return spark.createDataFrame([(t, DAY + timedelta(days=d), c, i) for i, (t, d, c) in enumerate(rows)], PRICES)


def universe(spark, names="abcde"):
    return spark.createDataFrame([(n, None, i) for i, n in enumerate(names)], "ticker string, segment string, position bigint")


def run(spark, rows, thresholds=Thresholds(), names="abcde"):
    bars = table(spark, rows)
    return quality.quality_checks(bars, build_returns(bars), universe(spark, names), thresholds)


def outcome(report):
    return {r.check_id: r.status for r in report.checks.collect()}


CLEAN = [(t, d, 10.0 + d) for t in "abcde" for d in (0, 1)]


def test_clean(spark):
    report = run(spark, CLEAN)
    summary = report.summary.first()
    assert list(summary.checks_passed) == [
        "Data completeness: 100.0% (>= 80.0%)",
        "All prices within valid range",
        "No missing values detected",
        "No extreme return outliers detected",
        "No duplicate records found",
    ]
    assert list(summary.checks_failed) == [] and summary.warnings == 0
    assert (summary.quality_score, summary.data_completeness) == (1.0, 1.0)
    assert report.warnings.collect() == []


def test_one_outlier_only_warns(spark):
    report = run(spark, CLEAN + [("a", 2, 17.731)])
    summary = report.summary.first()
    assert (len(summary.checks_passed), len(summary.checks_failed), summary.quality_score) == (4, 0, 1.0)
    assert summary.warnings == 2
    rows = [(r.check_id, r.ticker, r.message) for r in report.warnings.collect()]
    assert sorted(rows, key=str) == sorted(
        [(4, None, "Found 1 extreme returns (>50.0%)"), (4, "a", "a: 61.19%")], key=str
    )


def test_low_completeness_fails(spark):
    summary = run(spark, CLEAN, names="abcdefgh").summary.first()
    assert list(summary.checks_failed) == ["Data completeness: 62.5% (< 80.0%)"]
    assert summary.quality_score == 0.8


def test_completeness_may_exceed_one(spark):
    summary = run(spark, CLEAN, names="abcd").summary.first()
    assert summary.data_completeness == 1.25
    assert summary.checks_passed[0] == "Data completeness: 125.0% (>= 80.0%)"


def test_duplicates_and_an_outlier(spark):
    summary = run(spark, CLEAN + [("a", 1, 11.0), ("b", 2, 99.0)]).summary.first()
    assert list(summary.checks_failed) == ["Found 2 duplicate records"]
    assert summary.quality_score == 0.75


def test_everything_wrong(spark):
    rows = [("a", 0, 0.0), ("a", 0, 0.0), ("a", 1, 2_000_000.0), ("a", 2, None)]
    report = run(spark, rows)
    assert outcome(report) == {1: "failed", 2: "failed", 3: "warned", 4: "warned", 5: "failed"}
    summary = report.summary.first()
    assert summary.quality_score == 0.0
    assert list(summary.checks_failed) == [
        "Data completeness: 20.0% (< 80.0%)",
        "Found 3 prices outside valid range",
        "Found 2 duplicate records",
    ]
    messages = [r.message for r in report.warnings.collect() if r.check_id == 3]
    # One missing close; its return row misses close and both changes, and 0 to 0 misses the percentage.
    assert messages == ["Missing values: 1 in prices, 4 in returns"]
    # Three prices, one missing-value message, one outlier message and one outlier (an infinite return).
    assert summary.warnings == 6 == report.warnings.count()
    assert {r.message for r in report.warnings.collect() if r.ticker and r.check_id == 4} == {"a: inf%"}


def test_limits_themselves_are_valid(spark):
    rows = [("a", 0, 0.01), ("b", 0, 1_000_000.0), ("c", 0, 100.0), ("c", 1, 150.0), ("d", 0, 100.0), ("d", 1, 50.0)]
    assert outcome(run(spark, rows)) == {1: "passed", 2: "passed", 3: "passed", 4: "passed", 5: "passed"}


def test_missing_values_are_neither_invalid_nor_outliers(spark):
    bars = table(spark, [("a", 0, float("nan")), ("b", 0, None), ("c", 0, 2e6), ("d", 0, 0.0)])
    assert sorted(r.ticker for r in quality.invalid_prices(bars).collect()) == ["c", "d"]
    changes = [("a", float("nan")), ("b", None), ("c", float("inf")), ("d", -50.1), ("e", 50.0), ("f", float("-inf"))]
    rows = [(t, DAY, 1.0, 1.0, 0.0, c, 0) for t, c in changes]
    schema = "ticker string, date date, close double, prev_close double, daily_return double, return_pct double, seq bigint"
    found = quality.outliers(spark.createDataFrame(rows, schema))
    assert sorted(r.ticker for r in found.collect()) == ["c", "d", "f"]


def test_limits_and_columns_reach_the_scan(spark, tmp_path):
    table(spark, CLEAN).write.parquet(str(tmp_path / "prices"))
    stored = spark.read.parquet(str(tmp_path / "prices"))
    plan = quality.invalid_prices(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Or(LessThan(close,0.01),And(GreaterThan(close,1000000.0)" in plan
    plan = build_returns(stored.drop("volume"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ticker:string,date:date,close:double,seq:bigint>" in plan


def test_no_prices_at_all(spark):
    report = run(spark, [])
    assert outcome(report) == {1: "failed", 2: "passed", 3: "passed", 4: "passed", 5: "passed"}


def test_thresholds_are_printed_as_given(spark):
    report = run(spark, CLEAN + [("a", 2, 40.0)], Thresholds(max_return_pct=12.5, min_data_completeness=0.95))
    messages = [r.message for r in report.checks.orderBy("check_id").collect()]
    assert messages[0] == "Data completeness: 100.0% (>= 95.0%)"
    assert messages[3] == "Found 1 extreme returns (>12.5%)"


def test_gate_is_off_by_default(spark):
    summary = run(spark, CLEAN, names="abcdefgh").summary
    quality.require_quality(summary, None)
    quality.require_quality(summary, 0.8)
    with pytest.raises(quality.QualityGateFailed):
        quality.require_quality(summary, 0.81)


@pytest.mark.parametrize("split_rows", [1, 2, 3, 1_000])
def test_duplicate_rows_match_null_keys_and_hot_keys(spark, split_rows):
    rows = [("a", DAY, 1.0, 0), ("a", DAY, 2.0, 1), (None, DAY, 3.0, 2), (None, DAY, 4.0, 3), ("b", None, 5.0, 4)]
    rows += [("b", None, 6.0, 5), ("b", DAY, 7.0, 6), (None, None, 8.0, 7)] + [("h", DAY, 1.0, 10 + i) for i in range(9)]
    df = spark.createDataFrame(rows, PRICES).repartition(3)
    found = sorted(r.seq for r in duplicates.duplicate_rows(df, ["ticker", "date"], split_rows).collect())
    assert found == [0, 1, 2, 3, 4, 5, *range(10, 19)]
    assert duplicates.duplicate_count(df, ["ticker", "date"]).first()[0] == len(found)
    salted = duplicates.duplicate_rows(df, ["ticker", "date"], split_rows, most_broadcast=0)
    assert sorted(r.seq for r in salted.collect()) == found


def test_failed_tickers_in_universe_order(spark):
    bars = table(spark, [("c", 0, 1.0), ("x", 0, 1.0)])
    symbols = universe(spark, "edcba")
    failed = metrics.failed_tickers(bars, symbols).orderBy("position").collect()
    assert [r.ticker for r in failed] == ["e", "d", "b", "a"]
    lines, count = metrics.failed_lines(metrics.failed_tickers(bars, symbols))
    assert count.first().num_failed == 4 and [tuple(r) for r in lines.collect()] == [(0, "e, d, b, a")]
    lines, _ = metrics.failed_lines(metrics.failed_tickers(bars, symbols), names=3)
    assert sorted(tuple(r) for r in lines.collect()) == [(0, "e, d, b"), (1, "a")]
    everything = table(spark, [(t, 0, 1.0) for t in "abcde"])
    lines, count = metrics.failed_lines(metrics.failed_tickers(everything, symbols))
    assert count.first().num_failed == 0 and [tuple(r) for r in lines.collect()] == [(0, "None")]


def test_every_failed_symbol_is_named(spark):
    symbols = spark.range(20_002).selectExpr("cast(id as string) as ticker", "id as position")
    bars = table(spark, [("7", 0, 1.0)])
    rows = metrics.price_metrics(bars, symbols).orderBy("line_no").collect()
    assert (rows[0].num_failed, rows[0].num_records, len(rows)) == (20_001, 1, 201)
    assert all(r.num_failed is None for r in rows[1:])
    named = [name for r in rows for name in r.failed_tickers.split(", ")]
    assert named == [str(i) for i in range(20_002) if i != 7]


def test_quality_metrics_texts(spark):
    clean = metrics.quality_metrics(run(spark, CLEAN).summary).first()
    assert clean.failed_checks == "None" and clean.passed_checks.count("✅ ") == 5
    bad = metrics.quality_metrics(run(spark, CLEAN, names="abcdefgh").summary).first()
    assert bad.failed_checks == "❌ Data completeness: 62.5% (< 80.0%)"
    assert (bad.checks_passed, bad.checks_failed, bad.warnings) == (4, 1, 0)


def test_default_universe(spark):
    rows = default_universe(spark).collect()
    assert len(rows) == 52 == len({r.ticker for r in rows})
    sizes = {}
    for r in rows:
        sizes[r.segment] = sizes.get(r.segment, 0) + 1
    assert list(sizes.values()) == [10, 10, 10, 10, 5, 5, 2]
    assert [r.ticker for r in rows if r.ticker.endswith("-USD")] == ["BTC-USD", "ETH-USD"]
