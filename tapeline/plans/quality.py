"""Data quality: five checks, a score and typed warnings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tapeline import schemas, wording
from tapeline.functions import numbers, text
from tapeline.operators import single_rows
from tapeline.settings import Thresholds

SERIES_KEY = ["ticker", "date"]


class QualityGateFailed(RuntimeError):
    """The quality score is below the required minimum."""


@dataclass(frozen=True)
class QualityReport:
    """The five checks, the warning records and a one-row summary."""

    checks: DataFrame
    warnings: DataFrame
    summary: DataFrame


def out_of_range(thresholds: Thresholds) -> Column:
    """The limits themselves are valid; a missing close is not out of range."""
    close = F.col("close")
    return (close < thresholds.min_price) | numbers.above(close, thresholds.max_price)


def is_outlier(thresholds: Thresholds) -> Column:
    """An absolute change above the limit, as two comparisons that a scan can use; a missing one is no outlier."""
    change, limit = F.col("return_pct"), thresholds.max_return_pct
    return (change < -limit) | numbers.above(change, limit)


def invalid_prices(prices: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return schemas.conform_prices(prices).where(out_of_range(thresholds)).select("ticker", "date", "seq", "close")


def outliers(returns: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return schemas.conform(returns, schemas.RETURNS).where(is_outlier(thresholds))


def missing_total(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Missing cells over the given columns, as a one-row table."""
    types = dict(df.dtypes)
    cells = numbers.missing_cells([(c, types[c]) for c in columns])
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias(out))


def price_statistics(prices: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Everything the checks need from the prices in one pass.

    Rows are combined per (ticker, date) before the first shuffle, so neither a long series nor a heavily repeated bar
    reaches a single task, and the distinct tickers are counted over what remains.
    """
    prices = schemas.conform_prices(prices)
    types = dict(prices.dtypes)
    cells = numbers.missing_cells([(c, types[c]) for c in schemas.measured_columns(prices, schemas.PRICES)])
    per_bar = prices.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(out_of_range(thresholds)).alias("invalid"),
        F.sum(cells).alias("missing"),
    )
    return per_bar.agg(
        F.count_distinct("ticker").alias("price_tickers"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_prices"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_prices"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates"),
    )


def return_statistics(returns: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Everything the checks need from the returns in one pass."""
    returns = schemas.conform(returns, schemas.RETURNS)
    types = dict(returns.dtypes)
    cells = numbers.missing_cells([(c, types[c]) for c in schemas.measured_columns(returns, schemas.RETURNS)])
    return returns.agg(
        F.coalesce(F.sum(cells), F.lit(0)).alias("missing_returns"),
        F.count_if(is_outlier(thresholds)).alias("outliers"),
    )


def completeness(prices: DataFrame, universe: DataFrame) -> DataFrame:
    """Distinct price tickers over the size of the universe, as a one-row table; may exceed 1."""
    counts = single_rows.combine(
        prices.agg(F.count_distinct("ticker").alias("price_tickers")),
        universe.agg(F.count(F.lit(1)).alias("universe_size")),
    )
    return counts.withColumn("data_completeness", _ratio("price_tickers", "universe_size"))


def _ratio(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


def evaluate(statistics: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The five checks as rows from one record of statistics.

    Checks 3 and 4 never fail: they pass or warn, and a warned check does not count in the score.
    """
    ratio = F.col("data_completeness")
    missing = F.col("missing_prices") + F.col("missing_returns")
    required = F.lit(f"{thresholds.min_data_completeness:.1%}")
    # Name, condition to pass, status otherwise, observed value, its limit, values of the message.
    rules = [
        (
            "completeness",
            ratio >= thresholds.min_data_completeness,
            "failed",
            ratio,
            thresholds.min_data_completeness,
            [numbers.ratio_text(ratio), required],
        ),
        _none_allowed("price_range", "failed", F.col("invalid_prices")),
        _none_allowed("missing_values", "warned", missing, F.col("missing_prices"), F.col("missing_returns")),
        _none_allowed("outliers", "warned", F.col("outliers"), F.col("outliers"), F.lit(str(thresholds.max_return_pct))),
        _none_allowed("duplicates", "failed", F.col("duplicates")),
    ]
    checks = []
    for number, (name, good, otherwise, observed, limit, values) in enumerate(rules, 1):
        passed_text, other_text = wording.CHECK_MESSAGES[name]
        checks.append(
            F.struct(
                F.lit(number).alias("check_id"),
                F.lit(name).alias("name"),
                F.when(good, F.lit("passed")).otherwise(F.lit(otherwise)).alias("status"),
                observed.cast("double").alias("observed"),
                F.lit(float(limit)).alias("threshold"),
                F.when(good, F.format_string(passed_text, *values))
                .otherwise(F.format_string(other_text, *values))
                .alias("message"),
            )
        )
    return statistics.select(F.inline(F.array(*checks)))


def _none_allowed(name: str, otherwise: str, observed: Column, *values: Column) -> tuple:
    return name, observed == 0, otherwise, observed, 0, list(values) or [observed]


def collect_checks(
    prices: DataFrame, returns: DataFrame, universe: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Two aggregate passes, one over the prices and one over the returns, to five check rows."""
    statistics = single_rows.combine(
        price_statistics(prices, thresholds),
        return_statistics(returns, thresholds),
        universe.agg(F.count(F.lit(1)).alias("universe_size")),
    ).withColumn("data_completeness", _ratio("price_tickers", "universe_size"))
    return evaluate(statistics, thresholds)


def _messages(status: str) -> Column:
    """Messages of one outcome in check order (five checks at most)."""
    entry = F.when(F.col("status") == status, F.struct("check_id", "message"))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["message"])


def summarise(checks: DataFrame) -> DataFrame:
    """One row: messages by outcome, number of warning entries, completeness and score."""
    passed = F.count_if(F.col("status") == "passed")
    failed = F.count_if(F.col("status") == "failed")
    # A failed price check adds one entry per price, a warned outlier check its message and one entry per return.
    entries = (
        F.when((F.col("check_id") == 2) & (F.col("status") == "failed"), F.col("observed"))
        .when((F.col("check_id") == 4) & (F.col("status") == "warned"), F.col("observed") + 1)
        .when(F.col("status") == "warned", F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return checks.agg(
        _messages("passed").alias("checks_passed"),
        _messages("failed").alias("checks_failed"),
        F.sum(entries).cast("bigint").alias("warnings"),
        F.max(F.when(F.col("check_id") == 1, F.col("observed"))).alias("data_completeness"),
        F.coalesce(F.try_divide(passed.cast("double"), (passed + failed).cast("double")), F.lit(0.0)).alias(
            "quality_score"
        ),
    )


def warning_records(
    prices: DataFrame, returns: DataFrame, checks: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Every warning as a typed row: check messages, out-of-range prices and outlier returns."""
    messages = checks.where(F.col("status") == "warned").select(
        "check_id",
        F.lit(None).cast("string").alias("ticker"),
        F.lit(None).cast("double").alias("value"),
        "message",
    )
    prices_found = invalid_prices(prices, thresholds).select(
        F.lit(2).alias("check_id"), "ticker", F.col("close").alias("value")
    )
    returns_found = outliers(returns, thresholds).select(
        F.lit(4).alias("check_id"),
        "ticker",
        F.col("return_pct").alias("value"),
        F.format_string(
            wording.OUTLIER, text.printed(F.col("ticker")), numbers.percent_text(F.col("return_pct"))
        ).alias("message"),
    )
    return messages.unionByName(prices_found, allowMissingColumns=True).unionByName(returns_found)


def quality_checks(
    prices: DataFrame, returns: DataFrame, universe: DataFrame, thresholds: Thresholds = Thresholds()
) -> QualityReport:
    """Run the five checks. Nothing is collected; the report consists of lazy tables."""
    checks = collect_checks(prices, returns, universe, thresholds)
    return QualityReport(
        checks=checks,
        warnings=warning_records(prices, returns, checks, thresholds),
        summary=summarise(checks),
    )


def require_quality(summary: DataFrame, min_score: float | None) -> None:
    """Optional gate: raise when the score is below ``min_score``; off by default."""
    if min_score is None:
        return
    score = summary.first()["quality_score"]
    if score < min_score:
        raise QualityGateFailed(f"quality score {score:.1%} is below {min_score:.1%}")
