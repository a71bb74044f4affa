"""Run metrics of every dataset, as one-row tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeline import schemas, wording
from tapeline.functions import dates, numbers, text
from tapeline.operators import exact, ordering, single_rows
from tapeline.plans.returns import best_first
from tapeline.session import hold

# Names on one line of a list of symbols.
NAMES_PER_LINE = 100

PRICE_PREVIEW_ROWS = 10
PREVIEW_ROWS = 5


def price_observations() -> dict[str, Column]:
    """What ``price_metrics`` needs from the job that writes the prices."""
    return {"num_records": F.count(F.lit(1)), "first_date": F.min("date"), "last_date": F.max("date")}


def news_observations() -> dict[str, Column]:
    return {"num_news": F.count(F.lit(1))}


def returns_observations() -> dict[str, Column]:
    return {"num_records": F.count(F.lit(1))}


def _observed_row(spark: SparkSession, observed: dict, types: str) -> DataFrame:
    """Observed values as the one row that an aggregate over the stored table would give."""
    names = [column.split()[0] for column in types.split(", ")]
    return spark.createDataFrame([tuple(observed[name] for name in names)], types)


def failed_tickers(prices: DataFrame, universe: DataFrame) -> DataFrame:
    """Universe members without a price row, with their position. Prices are reduced to distinct keys first."""
    return universe.join(prices.select("ticker").distinct(), "ticker", "left_anti").select("position", "ticker")


def failed_lines(
    failed: DataFrame, names: int = NAMES_PER_LINE, root: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The failed symbols in universe order, ``names`` to a line: rows (line_no, failed_tickers); and their number.

    Every symbol is on some line. Without any there is one line, ``None``. The numbered symbols are stored below ``root``
    or the shared folder.
    """
    numbered = ordering.running_number(failed, ordering.in_order("position", "ticker"), "_number", root)
    line = F.floor((F.col("_number") - 1) / names).alias("line_no")
    members = F.array_sort(F.collect_list(F.struct("_number", "ticker")))
    spelled = text.joined_or_none(F.transform(members, lambda e: e["ticker"]), ", ").alias("failed_tickers")
    lines = numbered.groupBy(line).agg(spelled)
    count = numbered.agg(F.count(F.lit(1)).alias("num_failed"))
    nothing = count.where("num_failed = 0").select(
        F.lit(0).cast("bigint").alias("line_no"), F.lit(wording.NOTHING).alias("failed_tickers")
    )
    return lines.unionByName(nothing), count


def date_range(prices: DataFrame) -> DataFrame:
    return _with_range(prices.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date")))


def _with_range(span: DataFrame) -> DataFrame:
    first, last = dates.midnight_text(F.col("first_date")), dates.midnight_text(F.col("last_date"))
    return span.withColumn("date_range", F.format_string(wording.DATE_RANGE, first, last))


def price_metrics(
    prices: DataFrame,
    universe: DataFrame,
    names: int = NAMES_PER_LINE,
    root: str | None = None,
    observed: dict | None = None,
) -> DataFrame:
    """One row per line of failed symbols; the first, line 0, also has all other metrics, which are NULL further on.

    With ``observed``, the ``price_observations`` of the job that wrote the prices, the prices are read once less: rows and
    dates are known, and the distinct symbols, stored once, give both their number and the failed ones.
    """
    prices = schemas.conform_prices(prices)
    shown = schemas.measured_columns(prices, schemas.PRICES)
    preview = ordering.csv_preview(
        prices, ordering.in_order("ticker", "date", "seq"), PRICE_PREVIEW_ROWS, shown
    )
    if observed is None:
        seen = prices
        measured = [
            prices.agg(
                F.count(F.lit(1)).alias("num_records"),
                F.count_distinct("ticker").alias("num_tickers"),
                F.min("date").alias("first_date"),
                F.max("date").alias("last_date"),
            )
        ]
    else:
        seen = hold(prices.select("ticker").distinct(), root)
        span = _observed_row(prices.sparkSession, observed, "num_records bigint, first_date date, last_date date")
        measured = [span, seen.agg(F.count("ticker").alias("num_tickers"))]
    lines, failed = failed_lines(failed_tickers(seen, universe), names, root)
    measured = _with_range(single_rows.combine(*measured)).select("num_records", "num_tickers", "first_date", "last_date", "date_range")
    facts = single_rows.combine(measured, failed, preview.select(F.col("csv").alias("preview")))
    stacked = facts.withColumn("line_no", F.lit(0).cast("bigint")).unionByName(lines, allowMissingColumns=True)
    columns = [*facts.columns, "failed_tickers"]
    return stacked.groupBy("line_no").agg(*[F.max(c).alias(c) for c in columns])


def news_metrics(news: DataFrame, universe: DataFrame | None = None, observed: dict | None = None) -> DataFrame:
    """The preview follows the universe order when a universe is given, else the symbol order. ``observed`` are the
    ``news_observations`` of the job that wrote the news; symbols are counted from their own aggregate, nothing else is read."""
    news = schemas.conform(news, schemas.NEWS)
    shown = schemas.measured_columns(news, schemas.NEWS)
    if universe is None:
        listed, order = news, ordering.in_order("ticker", "seq")
    else:
        listed = news.join(universe.select("ticker", "position"), "ticker", "left")
        order = ordering.in_order("position", "ticker", "seq")
    preview = ordering.csv_preview(listed, order, PREVIEW_ROWS, shown)
    tickers = F.count_distinct("ticker").alias("num_tickers_with_news")
    if observed is None:
        counted = news.agg(F.count(F.lit(1)).alias("num_news"), tickers)
    else:
        counted = single_rows.combine(_observed_row(news.sparkSession, observed, "num_news bigint"), news.agg(tickers))
    return single_rows.combine(
        counted,
        preview.select(F.when(F.col("rows") > 0, F.col("csv")).otherwise(wording.NO_NEWS).alias("preview")),
    )


def returns_metrics(returns: DataFrame, observed: dict | None = None) -> DataFrame:
    """``observed`` are the ``returns_observations`` of the job that wrote the returns, which then are read once less."""
    spark = returns.sparkSession
    returns = schemas.conform(returns, schemas.RETURNS)
    mean = exact.exact_mean(returns, F.col("return_pct"), "avg_return_pct")
    top = ordering.csv_preview(returns, best_first(), PREVIEW_ROWS, ["ticker", "return_pct"])
    preview = ordering.csv_preview(
        returns,
        ordering.in_order("ticker", "date", "seq"),
        PREVIEW_ROWS,
        schemas.measured_columns(returns, schemas.RETURNS),
    )
    return single_rows.combine(
        returns.agg(F.count(F.lit(1)).alias("num_records")) if observed is None else _observed_row(spark, observed, "num_records bigint"),
        mean.select(numbers.round_half_even(F.col("avg_return_pct")).alias("avg_return_pct")),
        top.select(F.col("csv").alias("top_gainers")),
        preview.select(F.col("csv").alias("preview")),
    )


def quality_metrics(summary: DataFrame) -> DataFrame:
    def bullets(column: str, mark: str):
        return F.transform(column, lambda m: F.concat(F.lit(mark), m))

    return summary.select(
        "quality_score",
        F.size("checks_passed").alias("checks_passed"),
        F.size("checks_failed").alias("checks_failed"),
        "warnings",
        F.array_join(bullets("checks_passed", wording.PASSED_BULLET), "\n").alias("passed_checks"),
        text.joined_or_none(bullets("checks_failed", wording.FAILED_BULLET), "\n").alias("failed_checks"),
    )
