"""Decoders of landed documents: JSON price payloads and RSS news feeds.

Both work on one landed table with a row per document, ``(ticker, status, body[, part])``, and stay inside Spark's own
parsers, so they run without a shuffle and scale with the number of documents.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tapeline import schemas, wording
from tapeline.functions import dates, numbers

HTTP_OK = 200
QUOTE_FIELDS = ("open", "high", "low", "close", "volume")

# Epoch seconds and volumes outside these limits cannot be stored; they reject their document. The latter is 2 to the 63.
MAX_EPOCH = 9_223_372_036.0
MAX_VOLUME = 9_223_372_036_854_775_808.0

# An explicit option set also keeps the optimizer from cancelling a parse against a preceding to_json.
JSON_OPTIONS = {"mode": "PERMISSIVE"}
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "ignoreSurroundingSpaces": "false",
    "nullValue": "\u0001",
    "columnNameOfCorruptRecord": schemas.UNREADABLE,
}

# Complete item elements, wherever they stand in a feed.
ITEMS = r"(?s)<item(?:\s[^>]*)?/>|<item(?:\s[^>]*)?>.*?</item\s*>"
# An ampersand that begins no reference.
STRAY_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"
CDATA_START, CDATA_END = "<![CDATA[", "]]>"
# CDATA sections (kept), and tags of all elements but the item and its four fields.
OTHER_TAGS = r"(?s)(<!\[CDATA\[.*?\]\]>)|</?(?!(?:item|title|link|pubDate|source)[\s/>])[A-Za-z][^>]*>"


def answered(documents: DataFrame) -> DataFrame:
    """Documents whose request succeeded."""
    return schemas.conform_documents(documents).where(F.col("status") == HTTP_OK)


def ordinal(documents: DataFrame, position: Column) -> Column:
    """Arrival order inside one ticker: document number, then position in the document."""
    part = F.col("part") if "part" in documents.columns else F.lit(0)
    return F.shiftleft(part.cast("bigint"), 32) + position.cast("bigint")


def evaluated(df: DataFrame, keep: list[str], columns: Column) -> DataFrame:
    """Append the fields of the struct ``columns`` to the ``keep`` columns, evaluating the struct once per row.

    Spark moves filters below projections and copies the expressions they mention; a filter on a parsed document would
    parse it again. Filters do not move below a generator, so the struct passes through a one-element ``inline``.
    """
    return df.select(*keep, F.inline(F.array(columns)))


def decode_payloads(
    payloads: DataFrame,
    as_of: datetime | Column | None = None,
    days: int = dates.LOOKBACK_DAYS,
    keep_last: int | None = None,
) -> DataFrame:
    """Price payloads to one row per bar with a close.

    A document that cannot be decoded in full gives no rows at all; other documents are not affected. ``as_of`` limits
    the bars to the ``days`` before it, ``keep_last`` to the last bars of each document.
    """
    documents = parsed_payloads(payloads)
    keys = [c for c in ("ticker", "part") if c in documents.columns]
    arrays = ["timestamp", *QUOTE_FIELDS]
    documents = documents.where(F.col("reason").isNull())

    kept = F.col("kept")
    if as_of is not None:
        start, end = dates.lookback_bounds(as_of, days)
        kept = F.filter(kept, lambda i: F.get("timestamp", i).between(start, end))
    if keep_last is not None:
        kept = F.when(F.size(kept) > keep_last, F.slice(kept, -keep_last, keep_last)).otherwise(kept)

    rows = documents.select(*keys, *arrays, F.explode(kept).alias("pos"))
    bar = {name: F.get(name, F.col("pos")) for name in arrays}
    return rows.select(
        "ticker",
        dates.epoch_to_date(bar["timestamp"]).alias("date"),
        *[numbers.nan_as_null(numbers.or_zero(bar[c])).alias(c) for c in ("open", "high", "low")],
        numbers.nan_as_null(bar["close"]).alias("close"),
        numbers.or_zero(bar["volume"]).cast("bigint").alias("volume"),
        ordinal(rows, F.col("pos")).alias("seq"),
    )


def parsed_payloads(payloads: DataFrame) -> DataFrame:
    """One row per payload: its arrays as numbers, the places ``kept`` of bars with a close, and ``reason``, null for a payload whose
    bars are taken and otherwise what is wrong with it (see ``wording.REJECTIONS``). Each body is parsed once, and each value."""
    documents = schemas.conform_documents(payloads)
    keys = [c for c in ("ticker", "part") if c in documents.columns]
    is_answered = F.coalesce(F.col("status") == HTTP_OK, F.lit(False))
    # As the only element of an array, a body that is cut off or followed by anything does not parse.
    body = F.when(is_answered, F.concat(F.lit("["), F.col("body"), F.lit("]")))
    listed = F.from_json(body, schemas.PAYLOAD_BODIES, JSON_OPTIONS)
    documents = evaluated(documents, [*keys, "status"], F.struct(listed.alias("listed")))
    whole = F.coalesce(F.size("listed") == 1, F.lit(False))
    result = F.when(whole, F.get(F.get("listed", F.lit(0))["chart"]["result"], F.lit(0)))
    documents = documents.select(*keys, is_answered.alias("answered"), whole.alias("whole"), result.alias("result"))
    quote = F.get(F.col("result.indicators.quote"), F.lit(0))
    texts = {"timestamp": F.col("result.timestamp"), **{name: quote[name] for name in QUOTE_FIELDS}}
    numbers_read = [F.transform(values, _number).alias(name) for name, values in texts.items()]
    shown = [values.alias(f"text_{name}") for name, values in texts.items()]
    documents = evaluated(documents, [*keys, "answered", "whole", F.col("result").isNotNull().alias("delivered")], F.struct(*numbers_read, *shown))
    # Values that are no numbers are told from missing ones by their place.
    odd = [_odd(name).alias(f"odd_{name}") for name in texts]
    arrays = ["timestamp", *QUOTE_FIELDS]
    marks = [f"odd_{name}" for name in arrays]
    facts = ["answered", "whole", "delivered"]
    documents = evaluated(documents, [*keys, *facts, *arrays], F.struct(*odd))

    # The arrays belong together by position, up to the number of timestamps; bars without a close are not kept.
    count = F.coalesce(F.size("timestamp"), F.lit(-1))
    enough = (count > 0) & (F.coalesce(F.size("close"), F.lit(-1)) >= count)
    closes = F.slice("close", F.lit(1), count)
    kept = F.array_compact(F.transform(closes, lambda close, i: F.when(close.isNotNull() | F.get("odd_close", i), i)))
    documents = evaluated(documents, [*keys, *facts, *arrays, *marks], F.struct(F.when(enough, kept).alias("kept")))

    # Every other array must reach the last kept bar, and each kept bar must hold storable numbers.
    reach = F.least(*[F.coalesce(F.size(name), F.lit(-1)) for name in arrays])
    checks = [
        ("unanswered", F.col("answered")),
        ("unreadable", F.col("whole")),
        ("no_result", F.col("delivered")),
        ("no_bars", F.coalesce(F.size("timestamp"), F.lit(0)) > 0),
        ("short", F.col("kept").isNotNull()),
        ("no_close", F.size("kept") > 0),
        ("short", reach > F.try_element_at("kept", F.lit(-1))),
        ("no_number", _readable(marks)),
        ("not_storable", _storable()),
    ]
    reason = F.coalesce(*[F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in checks])
    return evaluated(documents, [*keys, *arrays, "kept"], F.struct(reason.alias("reason")))


def rejected_payloads(parsed: DataFrame) -> DataFrame:
    """The payloads of ``parsed_payloads`` that give no bars, with the reason and its text."""
    keys = [c for c in ("ticker", "part") if c in parsed.columns]
    reasons = F.create_map(*[F.lit(x) for pair in wording.REJECTIONS.items() for x in pair])
    rejected = parsed.where(F.col("reason").isNotNull())
    return rejected.select(*keys, "reason", F.element_at(reasons, F.col("reason")).alias("message"))


def _number(text: Column) -> Column:
    """A JSON value, read as text, as a number; NULL when it is none."""
    return F.btrim(text, F.lit('"')).try_cast("double")


def _odd(name: str) -> Column:
    """Which values of an array are there but are no numbers."""
    return F.transform(f"text_{name}", lambda x, i: x.isNotNull() & F.get(name, i).isNull())


def _readable(marks: list[str]) -> Column:
    """Whether no value of a kept bar is something else than a number."""
    none = [~F.array_contains(mark, True) for mark in marks]
    ordinary = F.coalesce(reduce(lambda a, b: a & b, none), F.lit(False))

    def read(i: Column) -> Column:
        return reduce(lambda a, b: a & b, [~F.coalesce(F.get(mark, i), F.lit(False)) for mark in marks])

    return F.when(ordinary, F.lit(True)).otherwise(F.forall("kept", read))


def _storable() -> Column:
    """Whether the time and volume of all kept bars can be stored.

    The extremes of the whole arrays settle nearly every document; only the others are checked bar by bar.
    """
    ordinary = (
        (F.array_max("timestamp") < MAX_EPOCH)
        & (F.array_min("timestamp") > -MAX_EPOCH)
        & ~F.exists("timestamp", lambda t: t.isNull())
        & F.coalesce(F.array_max("volume") < MAX_VOLUME, F.lit(True))
        & F.coalesce(F.array_min("volume") > -MAX_VOLUME, F.lit(True))
    )

    def fits(i: Column) -> Column:
        time, volume = F.get("timestamp", i), numbers.or_zero(F.get("volume", i))
        return F.coalesce(F.abs(time) < MAX_EPOCH, F.lit(False)) & (F.abs(volume) < MAX_VOLUME)

    return F.when(ordinary, F.lit(True)).otherwise(F.forall("kept", fits))


def decode_feeds(feeds: DataFrame, keep_first: int | None = None) -> DataFrame:
    """News feeds to one row per readable item, in feed order; ``keep_first`` limits the items of each document.

    Complete item elements are cut out at any depth and parsed one by one, so that what is wrong elsewhere in a feed, or
    missing at its end, does no harm. Stray ampersands are escaped and nested markup leaves its words. An absent field
    becomes ``N/A`` (the link: empty); a present but empty one stays empty.
    """
    documents = answered(feeds)
    keys = [c for c in ("ticker", "part") if c in documents.columns]
    items = F.regexp_extract_all("body", F.lit(ITEMS), F.lit(0))
    if keep_first is not None:
        items = F.slice(items, 1, keep_first)
    cut = documents.select(*keys, F.posexplode(items).alias("pos", "text"))
    return read_items(cut.select("ticker", "text", ordinal(cut, F.col("pos")).alias("seq")))


def read_items(items: DataFrame) -> DataFrame:
    """Item elements ``(ticker, text, seq)`` to articles; items that cannot be read are left out."""
    plain = F.regexp_replace(_without_stray_ampersands(F.col("text")), OTHER_TAGS, "$1")
    read = evaluated(items, ["ticker", "seq"], F.struct(F.from_xml(plain, schemas.FEED_ITEM, XML_OPTIONS).alias("item")))
    item = F.col("item")
    rows = read.where(item[schemas.UNREADABLE].isNull())
    absent = F.lit(wording.ABSENT)
    return rows.select(
        "ticker",
        F.coalesce(item["title"], absent).alias("title"),
        F.when(item["source"].isNull(), absent)
        .otherwise(F.coalesce(item["source"]["_VALUE"], F.lit("")))
        .alias("publisher"),
        F.coalesce(item["pubDate"], absent).alias("published_date"),
        F.coalesce(item["link"], F.lit("")).alias("link"),
        "seq",
    )


def _without_stray_ampersands(text: Column) -> Column:
    """Ampersands outside of CDATA sections that begin no reference, escaped. The text is cut at the starts of sections; of each
    piece only what follows the section's end is looked at, so each character is read once however many ampersands there are."""

    def escaped(part: Column) -> Column:
        return F.regexp_replace(part, STRAY_AMPERSAND, "&amp;")

    def after_start(piece: Column) -> Column:
        end = F.instr(piece, CDATA_END)
        section, rest = F.substr(piece, F.lit(1), end - 1), F.substr(piece, end)
        return F.when(end > 0, F.concat(section, escaped(rest))).otherwise(escaped(piece))

    pieces = F.split(text, r"<!\[CDATA\[")
    cut = F.transform(pieces, lambda piece, i: F.when(i == 0, escaped(piece)).otherwise(after_start(piece)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(cut, CDATA_START)).otherwise(text)
