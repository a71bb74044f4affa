"""Market-series analytics as composable Spark DataFrame functions."""

from tapeline.plans.news import build_news, feed_items
from tapeline.plans.prices import build_prices, last_bars
from tapeline.plans.quality import QualityReport, quality_checks
from tapeline.plans.recap import Recap, recap
from tapeline.plans.refresh import refresh
from tapeline.plans.returns import build_returns, top_performers
from tapeline.settings import Thresholds, default_universe

__all__ = [
    "QualityReport",
    "Recap",
    "Thresholds",
    "build_news",
    "build_prices",
    "build_returns",
    "default_universe",
    "feed_items",
    "last_bars",
    "quality_checks",
    "recap",
    "refresh",
    "top_performers",
]
