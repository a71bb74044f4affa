"""Text expressions of the request manifest and the recap."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapeline import wording


def search_phrase(ticker: Column) -> Column:
    """``BTC-USD`` is searched as ``BTC crypto``, any other symbol as ``<symbol> stock``."""
    crypto = F.replace(ticker, F.lit(wording.CRYPTO_SUFFIX), F.lit(wording.CRYPTO_PHRASE))
    stock = F.concat(ticker, F.lit(wording.STOCK_PHRASE))
    return F.when(ticker.endswith(wording.CRYPTO_SUFFIX), crypto).otherwise(stock)


def url_text(value: Column) -> Column:
    """Percent-encoded text for a URL (a space becomes ``%20``)."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def printed(value: Column) -> Column:
    """A text inside a sentence; a missing one is spelled out."""
    return F.coalesce(value, F.lit(wording.NOTHING))


def read_more(link: Column) -> Column:
    """Link markup, or nothing when there is no link."""
    present = link.isNotNull() & (link != "")
    return F.when(present, F.format_string(wording.READ_MORE, link)).otherwise(F.lit(""))


def headline(number: Column, ticker: Column, title: Column) -> Column:
    return F.format_string(wording.HEADLINE, number, ticker, printed(title))


def byline(publisher: Column, published_date: Column) -> Column:
    return F.format_string(wording.BYLINE, printed(publisher), printed(published_date))


def joined_or_none(texts: Column, separator: str) -> Column:
    """The array's texts joined, or ``None`` for an empty array."""
    return F.when(F.size(texts) > 0, F.array_join(texts, separator)).otherwise(F.lit(wording.NOTHING))


def csv_field(text: Column) -> Column:
    """One CSV field: quoted only when it holds a comma, a quote or a line break; missing is empty."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike('[,"\r\n]'), quoted).otherwise(text), F.lit(""))
