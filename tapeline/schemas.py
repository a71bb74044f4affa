"""Column contracts of every dataset, checked where a plan takes its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


STRING, INT, BIGINT, DOUBLE, DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


UNIVERSE = _table(ticker=STRING, segment=STRING, position=BIGINT)

# Landed documents. ``part`` numbers the documents of one ticker when a series or feed is delivered in pages.
DOCUMENTS = _table(ticker=STRING, status=INT, body=STRING, part=BIGINT)

PRICES = _table(ticker=STRING, date=DATE, open=DOUBLE, high=DOUBLE, low=DOUBLE, close=DOUBLE, volume=BIGINT, seq=BIGINT)
NEWS = _table(ticker=STRING, title=STRING, publisher=STRING, published_date=STRING, link=STRING, seq=BIGINT)
RETURNS = _table(ticker=STRING, date=DATE, close=DOUBLE, prev_close=DOUBLE, daily_return=DOUBLE, return_pct=DOUBLE, seq=BIGINT)
CHECKS = _table(check_id=INT, name=STRING, status=STRING, observed=DOUBLE, threshold=DOUBLE, message=STRING)
WARNINGS = _table(check_id=INT, ticker=STRING, value=DOUBLE, message=STRING)

# Raw payloads and feed items: only the fields the plans read, so the parsers skip everything else. Numbers are read as
# text, because some feeds quote them; UNREADABLE takes an item that does not parse.
PAYLOAD_BODIES = (
    "ARRAY<STRUCT<chart: STRUCT<result: ARRAY<STRUCT<timestamp: ARRAY<STRING>, indicators: STRUCT<quote: ARRAY<STRUCT<"
    "open: ARRAY<STRING>, high: ARRAY<STRING>, low: ARRAY<STRING>, close: ARRAY<STRING>, volume: ARRAY<STRING>"
    ">>>>>>>>"
)
UNREADABLE = "unreadable"
FEED_ITEM = (
    "title STRING, link STRING, pubDate STRING, source STRUCT<_VALUE: STRING, _url: STRING>, "
    f"{UNREADABLE} STRING"
)


class SchemaMismatch(TypeError):
    """An input table lacks a column or carries it with another type."""


def conform(df: DataFrame, schema: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the contract's columns, in order; raise when one is missing or has another type."""
    present = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in schema.fields:
        if field.name not in present:
            if field.name not in optional:
                problems.append(f"missing column {field.name} {field.dataType.simpleString()}")
        elif present[field.name] != field.dataType:
            problems.append(
                f"column {field.name} is {present[field.name].simpleString()}, "
                f"expected {field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*[f.name for f in schema.fields if f.name in present])


def measured_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Contract columns of ``df`` that carry data (the ordinal ``seq`` does not count as data)."""
    return [f.name for f in schema.fields if f.name in df.columns and f.name != "seq"]


OPTIONAL_PRICE_COLUMNS = ("open", "high", "low", "volume")


def conform_prices(df: DataFrame) -> DataFrame:
    return conform(df, PRICES, optional=OPTIONAL_PRICE_COLUMNS)


def conform_documents(df: DataFrame) -> DataFrame:
    return conform(df, DOCUMENTS, optional=("part",))
