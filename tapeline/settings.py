"""Default universe of symbols and the quality thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeline.schemas import UNIVERSE

# The default symbols, by segment.
DEFAULT_SYMBOLS = {
    "Tech": ["AAPL", "MSFT", "GOOGL", "AMZN", "META", "NVDA", "TSLA", "NFLX", "AMD", "INTC"],
    "Finance": ["JPM", "BAC", "GS", "MS", "WFC", "C", "BLK", "V", "MA", "AXP"],
    "Healthcare": ["JNJ", "UNH", "PFE", "ABBV", "TMO", "MRK", "LLY", "ABT", "DHR", "BMY"],
    "Consumer": ["WMT", "PG", "KO", "PEP", "NKE", "COST", "HD", "MCD", "SBUX", "DIS"],
    "Energy": ["XOM", "CVX", "COP", "SLB", "EOG"],
    "Indices & ETFs": ["SPY", "QQQ", "DIA", "IWM", "VTI"],
    "Crypto": ["BTC-USD", "ETH-USD"],
}


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality checks; the defaults are fixed values."""

    min_price: float = 0.01
    max_price: float = 1_000_000.0
    max_return_pct: float = 50.0
    min_data_completeness: float = 0.8


def default_universe(spark: SparkSession) -> DataFrame:
    """The 52 default symbols with their segment and position."""
    symbols = [(s, segment) for segment, names in DEFAULT_SYMBOLS.items() for s in names]
    rows = [(symbol, segment, i) for i, (symbol, segment) in enumerate(symbols, 1)]
    return spark.createDataFrame(rows, UNIVERSE)


def universe_of(table: DataFrame, ticker: str, segment: str | None = None, position: str | None = None) -> DataFrame:
    """A universe from any table with one row per symbol; without a position the symbol order applies."""
    return table.select(
        F.col(ticker).cast("string").alias("ticker"),
        (F.col(segment) if segment else F.lit(None)).cast("string").alias("segment"),
        (F.col(position) if position else F.lit(0)).cast("bigint").alias("position"),
    )
