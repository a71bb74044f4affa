"""Returns: change of the close against the previous row of the same symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeline import schemas, wording
from tapeline.functions import numbers
from tapeline.operators import keys, ordering, series

TOP_PERFORMERS = 5


def previous_closes(
    prices: DataFrame, split_rows: int | None = keys.SPLIT_ROWS, root: str | None = None
) -> DataFrame:
    """Prices with the close of the previous row of the symbol (whatever its date)."""
    prices = schemas.conform_prices(prices).select(
        "ticker", "date", numbers.nan_as_null(F.col("close")).alias("close"), "seq"
    )
    return series.previous_value(prices, "ticker", ["date", "seq"], "close", "prev_close", split_rows, root)


def with_changes(closes: DataFrame) -> DataFrame:
    """Absolute and relative change. A missing close keeps its row, with missing changes."""
    change = F.col("close") - F.col("prev_close")
    return closes.withColumn("daily_return", numbers.nan_as_null(change)).withColumn(
        "return_pct", numbers.percent_change(F.col("daily_return"), F.col("prev_close"))
    )


def build_returns(
    prices: DataFrame, split_rows: int | None = keys.SPLIT_ROWS, root: str | None = None
) -> DataFrame:
    """One row per price that has a previous close."""
    closes = previous_closes(prices, split_rows, root).where(F.col("prev_close").isNotNull())
    return with_changes(closes).select(*schemas.RETURNS.names)


def best_first() -> list:
    return ordering.highest_first("return_pct", "ticker", "date", "seq")


def direction(change: Column) -> Column:
    """The colour of a return; zero and missing count as a loss."""
    return F.when(change > 0, F.lit(wording.GAIN_COLOUR)).otherwise(F.lit(wording.LOSS_COLOUR))


def top_performers(returns: DataFrame, n: int = TOP_PERFORMERS) -> DataFrame:
    """The ``n`` highest returns with their bar colour."""
    top = ordering.top_rows(schemas.conform(returns, schemas.RETURNS), best_first(), n)
    return top.select(
        "ticker",
        "date",
        "seq",
        "return_pct",
        direction(F.col("return_pct")).alias("direction"),
    )
