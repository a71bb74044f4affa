"""Full refresh: build every dataset in dependency order, each from the stored form of its inputs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tapeline.plans import metrics
from tapeline.plans.news import build_news
from tapeline.plans.prices import NoPriceData, build_prices, require_prices
from tapeline.plans.quality import QualityReport, quality_checks, require_quality
from tapeline.plans.recap import recap
from tapeline.plans.returns import build_returns
from tapeline.session import discard, new_folder
from tapeline.settings import Thresholds
from tapeline.sinks import commits, tables


def refresh(
    payloads: DataFrame,
    feeds: DataFrame,
    universe: DataFrame,
    root: str,
    as_of: datetime,
    thresholds: Thresholds = Thresholds(),
    keep_last: int | None = 2,
    keep_first: int | None = 3,
    limit_to_window: bool = False,
    min_score: float | None = None,
) -> dict[str, DataFrame]:
    """Write all datasets below ``root`` and return them with their metrics.

    Storing a dataset before the next one uses it means each is computed once. No price at all aborts the refresh
    after the news is stored; no news at all does not.
    """
    spark = universe.sparkSession
    work = new_folder(spark, "_work", root)
    options = (thresholds, keep_last, keep_first, limit_to_window, min_score)
    try:
        return _refresh(payloads, feeds, universe, root, work, as_of, *options)
    finally:
        discard(spark, work)


def _refresh(
    payloads: DataFrame,
    feeds: DataFrame,
    universe: DataFrame,
    root: str,
    work: str,
    as_of: datetime,
    thresholds: Thresholds,
    keep_last: int | None,
    keep_first: int | None,
    limit_to_window: bool,
    min_score: float | None,
) -> dict[str, DataFrame]:
    """``refresh`` with ``work`` for intermediates."""
    spark = universe.sparkSession
    stored: dict[str, DataFrame] = {}
    news = tables.prepare(
        build_news(feeds, universe, keep_first), root, "news", compact=True, observe=metrics.news_observations()
    )
    stored["news"] = commits.commit(news)
    window_end = as_of if limit_to_window else None
    # Prices are written once; a refresh without any price does not commit them and leaves the stored ones in place.
    bars = build_prices(payloads, universe, window_end, keep_last)
    prices = tables.prepare(bars, root, "prices", day="date", observe=metrics.price_observations())
    try:
        require_prices(prices.df)
    except NoPriceData:
        discard(spark, prices.path)
        raise
    stored["prices"] = commits.commit(prices)
    returns = tables.prepare(
        build_returns(stored["prices"], root=work), root, "returns", observe=metrics.returns_observations()
    )
    stored["returns"] = commits.commit(returns)

    report = quality_checks(stored["prices"], stored["returns"], universe, thresholds)
    stored["quality_checks"] = tables.materialise(report.checks, root, "quality_checks")
    stored["quality_warnings"] = tables.materialise(report.warnings, root, "quality_warnings")
    stored["quality_summary"] = tables.materialise(report.summary, root, "quality_summary")
    report = QualityReport(
        stored["quality_checks"], stored["quality_warnings"], stored["quality_summary"]
    )
    require_quality(report.summary, min_score)

    folder = tables.dataset_path(root, "recap")
    run_date = tables.run_date_of(spark, as_of)
    sections = recap(stored["returns"], stored["news"], report, as_of, work).sections()
    tables.write_recap(sections, folder, run_date)
    stored["recap_metrics"] = tables.recap_metrics(spark, folder, run_date, list(sections))
    lines = metrics.price_metrics(stored["prices"], universe, root=work, observed=prices.observed)
    stored["price_metrics"] = tables.materialise(lines, root, "price_metrics")
    stored["news_metrics"] = metrics.news_metrics(stored["news"], universe, news.observed)
    stored["returns_metrics"] = metrics.returns_metrics(stored["returns"], returns.observed)
    stored["quality_metrics"] = metrics.quality_metrics(report.summary)
    return stored
