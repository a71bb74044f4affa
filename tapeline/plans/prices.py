"""Prices: landed payloads to a daily price table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tapeline import schemas, wording
from tapeline.functions import dates
from tapeline.operators import series
from tapeline.sources.documents import decode_payloads


class NoPriceData(RuntimeError):
    """No symbol delivered a price."""


def build_prices(
    payloads: DataFrame,
    universe: DataFrame | None = None,
    as_of: datetime | Column | None = None,
    keep_last: int | None = 2,
) -> DataFrame:
    """The last ``keep_last`` bars of every symbol of the universe (None keeps all).

    With one document per symbol this is a single pass without a shuffle. When symbols are delivered in parts, each
    part is cut first and the symbol's last bars are taken over its parts. Equal (ticker, date) bars are kept: the
    quality checks report them.
    """
    bars = decode_payloads(payloads, as_of=as_of, keep_last=keep_last)
    if universe is not None:
        # After decoding, so that a universe too large to broadcast moves short rows instead of documents.
        bars = bars.join(universe.select("ticker"), "ticker", "left_semi")
    if keep_last is not None and "part" in payloads.columns:
        bars = last_bars(bars, keep_last)
    return bars


def coerce_dates(prices: DataFrame) -> DataFrame:
    """A price table from elsewhere whose dates are texts or timestamps, with dates as the plans expect them."""
    dtype = dict(prices.dtypes)["date"]
    return prices if dtype == "date" else prices.withColumn("date", dates.coerce_date(F.col("date"), dtype))


def last_bars(prices: DataFrame, n: int = 2) -> DataFrame:
    """The last ``n`` bars of every symbol in arrival order."""
    return series.last_rows(schemas.conform_prices(prices), "ticker", ["seq"], n)


def require_prices(prices: DataFrame) -> DataFrame:
    """Raise when there is no price row at all."""
    if prices.isEmpty():
        raise NoPriceData(wording.NO_PRICE_DATA)
    return prices
