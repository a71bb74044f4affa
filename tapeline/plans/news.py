"""News: landed feeds to a table of articles, and the digest of one article per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeline import schemas
from tapeline.functions import text
from tapeline.operators import ordering, series
from tapeline.sources.documents import decode_feeds

ARTICLE_FIELDS = ["title", "publisher", "published_date", "link"]


def build_news(
    feeds: DataFrame, universe: DataFrame | None = None, keep_first: int | None = 3
) -> DataFrame:
    """The first ``keep_first`` articles of every symbol (None keeps all). No article at all is an empty table."""
    items = decode_feeds(feeds, keep_first=keep_first)
    if universe is not None:
        items = items.join(universe.select("ticker"), "ticker", "left_semi")
    if keep_first is not None and "part" in feeds.columns:
        items = series.first_rows(items, "ticker", ["seq"], keep_first)
    return items


def feed_items(feeds: DataFrame) -> DataFrame:
    """Every article of every feed."""
    return build_news(feeds, keep_first=None)


def first_articles(news: DataFrame) -> DataFrame:
    """The first article of every symbol; rows without a symbol are dropped."""
    news = schemas.conform(news, schemas.NEWS)
    return series.first_rows(news.where(F.col("ticker").isNotNull()), "ticker", ["seq"], 1)


def first_article_fields(news: DataFrame) -> DataFrame:
    """Per symbol the first present value of each article field on its own."""
    return series.first_present(schemas.conform(news, schemas.NEWS), "ticker", "seq", ARTICLE_FIELDS)


def news_digest(news: DataFrame, root: str | None = None) -> DataFrame:
    """One numbered article per symbol in symbol order, with its printed parts. ``root`` takes the numbered rows."""
    numbered = ordering.running_number(first_article_fields(news), ordering.in_order("ticker"), "position", root)
    return numbered.select(
        "position",
        "ticker",
        *ARTICLE_FIELDS,
        text.headline(F.col("position"), F.col("ticker"), F.col("title")).alias("headline"),
        text.byline(F.col("publisher"), F.col("published_date")).alias("byline"),
        text.read_more(F.col("link")).alias("read_more"),
    )
