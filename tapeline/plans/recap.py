"""The daily recap as tables: summary, top performers, full return table, news digest and quality lines."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tapeline import schemas, wording
from tapeline.functions import dates, numbers
from tapeline.operators import exact, single_rows, sketches
from tapeline.plans.news import news_digest
from tapeline.plans.quality import QualityReport
from tapeline.plans.returns import best_first, top_performers


@dataclass(frozen=True)
class Recap:
    """The sections of one recap."""

    summary: DataFrame
    summary_lines: DataFrame
    top_performers: DataFrame
    price_table: DataFrame
    news_digest: DataFrame
    quality_lines: DataFrame

    def sections(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def market_summary(returns: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count (printed as the number of tracked assets), distinct tickers, mean, gainers and losers: one row. The mean is the
    same whatever the order and partitioning of the rows. With ``approximate``, tickers are counted by a sketch: the rows are then
    combined without a shuffle by ticker."""
    change = numbers.nan_as_null(F.col("return_pct"))
    rows = schemas.conform(returns, schemas.RETURNS)
    tickers = F.hll_sketch_estimate(sketches.sketch_of("ticker")) if approximate else F.count_distinct("ticker")
    counts = rows.agg(
        F.count(F.lit(1)).alias("total_assets"),
        tickers.alias("distinct_tickers"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
    )
    combined = single_rows.combine(counts, exact.exact_mean(rows, F.col("return_pct"), "avg_return_pct"))
    return combined.select("total_assets", "distinct_tickers", "avg_return_pct", "gainers", "losers")


def recap_summary(returns: DataFrame, quality_summary: DataFrame, as_of: datetime | Column) -> DataFrame:
    """The executive summary: numbers and their printed forms in one row."""
    combined = single_rows.combine(market_summary(returns), quality_summary.select("quality_score"))
    return combined.select(
        F.format_string(wording.RECAP_TITLE, dates.run_title(as_of)).alias("title"),
        *combined.columns,
        numbers.percent_text(F.col("avg_return_pct")).alias("avg_return_label"),
        numbers.ratio_text(F.col("quality_score")).alias("quality_score_label"),
    )


def summary_lines(summary: DataFrame) -> DataFrame:
    """The printed executive summary: title, heading and four lines."""
    assets, mean, movers, score = wording.SUMMARY_LINES
    lines = F.array(
        F.col("title"),
        F.lit(wording.SUMMARY_HEADING),
        F.format_string(assets, "total_assets"),
        F.format_string(mean, "avg_return_label"),
        F.format_string(movers, "gainers", "losers"),
        F.format_string(score, "quality_score_label"),
    )
    return summary.select(F.posexplode(lines).alias("line_no", "line"))


def with_labels(returns: DataFrame) -> DataFrame:
    """Printed prices and returns beside the numbers, in the order of the rows given."""
    return schemas.conform(returns, schemas.RETURNS).select(
        "ticker",
        "date",
        "seq",
        "close",
        "daily_return",
        "return_pct",
        numbers.money_text(F.col("close")).alias("close_label"),
        numbers.money_text(F.col("daily_return")).alias("daily_return_label"),
        numbers.percent_text(F.col("return_pct")).alias("return_pct_label"),
    )


def price_table(returns: DataFrame) -> DataFrame:
    """All returns, best first: a range-partitioned sort of the numbers, labelled afterwards."""
    return with_labels(schemas.conform(returns, schemas.RETURNS).orderBy(*best_first()))


def quality_lines(summary: DataFrame) -> DataFrame:
    """The printed quality section: score, then passed and failed checks (a dozen lines at most)."""

    def section(heading: str, column: str, mark: str) -> Column:
        heading = F.format_string(heading, F.size(column))
        return F.concat(F.array(heading), F.transform(column, lambda m: F.concat(F.lit(mark), m)))

    lines = F.concat(
        F.array(F.format_string(wording.QUALITY_SCORE, numbers.ratio_text(F.col("quality_score")))),
        section(wording.PASSED_HEADING, "checks_passed", wording.PASSED_MARK),
        F.when(
            F.size("checks_failed") > 0, section(wording.FAILED_HEADING, "checks_failed", wording.FAILED_MARK)
        ).otherwise(F.array().cast("array<string>")),
    )
    return summary.select(F.posexplode(lines).alias("line_no", "line"))


def recap(
    returns: DataFrame, news: DataFrame, quality: QualityReport, as_of: datetime | Column, root: str | None = None
) -> Recap:
    """All sections. ``root`` takes intermediates; without it the shared folder does."""
    summary = recap_summary(returns, quality.summary, as_of)
    return Recap(
        summary=summary,
        summary_lines=summary_lines(summary),
        top_performers=top_performers(returns),
        price_table=price_table(returns),
        news_digest=news_digest(news, root),
        quality_lines=quality_lines(quality.summary),
    )
