"""The request manifest: what to fetch for each symbol. Fetching itself is left to a crawler."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tapeline.functions import dates, text

# Public endpoints and their parameters.
QUOTE_ENDPOINT = "https://query1.finance.yahoo.com/v8/finance/chart/"
NEWS_ENDPOINT = "https://news.google.com/rss/search?q="
QUOTE_FROM = "?period1="
QUOTE_TO = "&period2="
QUOTE_INTERVAL = "&interval=1d"
NEWS_PARAMETERS = "&hl=en-US&gl=US&ceid=US:en"


def request_manifest(universe: DataFrame, as_of: datetime | Column) -> DataFrame:
    """One row per symbol: search phrase, both request URLs and the time bounds."""
    start, end = dates.lookback_bounds(as_of)
    bounds = universe.select(
        "ticker",
        text.search_phrase(F.col("ticker")).alias("phrase"),
        start.alias("from_ts"),
        end.alias("to_ts"),
    )
    return bounds.select(
        "ticker",
        "phrase",
        "from_ts",
        "to_ts",
        F.concat(
            F.lit(QUOTE_ENDPOINT),
            text.url_text(F.col("ticker")),
            F.lit(QUOTE_FROM),
            F.col("from_ts").cast("string"),
            F.lit(QUOTE_TO),
            F.col("to_ts").cast("string"),
            F.lit(QUOTE_INTERVAL),
        ).alias("price_url"),
        F.concat(
            F.lit(NEWS_ENDPOINT), text.url_text(F.col("phrase")), F.lit(NEWS_PARAMETERS)
        ).alias("news_url"),
    )
