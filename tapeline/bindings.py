"""The provided tables seen as prices, universe, news, payloads and feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeline.functions import dates
from tapeline.settings import universe_of

# Size bounds of a rendered document. Order and document numbers are unique, so no group exceeds them.
BARS_PER_DOCUMENT = 50_000
ITEMS_PER_DOCUMENT = 100

# Of each so many customers, one each has documents that were not answered, are cut off, have no indicators or no volumes.
SPOILT_CYCLE = 50
UNANSWERED, CUT_OFF, WITHOUT_INDICATORS, WITHOUT_VOLUMES = 7, 11, 13, 17
# One of so many bars has no close; feeds of this source were not answered, those of that one are cut off at the end.
NO_CLOSE_CYCLE = 37
UNANSWERED_SOURCE, CUT_OFF_SOURCE = "src3", "src5"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts):
    """Whole epoch seconds of a zone-less timestamp, read as UTC."""
    return dates.date_to_epoch(ts.cast("date")) + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def prices_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderkey").alias("seq"),
    )


def universe_from_customers(customers: DataFrame) -> DataFrame:
    return universe_of(customers, "c_custkey", "c_mktsegment", "c_custkey")


def universe_with_parts(customers: DataFrame, parts: DataFrame) -> DataFrame:
    """Customers and parts; no order has a part's name as its ticker, so all parts lack prices."""
    named = parts.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("symbol"), "p_brand", "p_partkey")
    return universe_from_customers(customers).unionByName(universe_of(named, "symbol", "p_brand", "p_partkey"))


def news_from_documents(documents: DataFrame) -> DataFrame:
    """Articles with gaps: only English ones are dated, French ones have no link."""
    return documents.select(
        F.col("source").alias("ticker"),
        F.col("text").alias("title"),
        F.col("lang").alias("publisher"),
        F.when(F.col("lang") == "en", F.concat(F.lit("day "), F.col("n_chars").cast("string")))
        .otherwise("N/A")
        .alias("published_date"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("doc_id").cast("string")).alias("link"),
        F.col("doc_id").alias("seq"),
    )


def payloads_from_orders(orders: DataFrame) -> DataFrame:
    """Orders as JSON price payloads, one document per customer and block of order numbers.

    Opening prices are whole, highs are null for pending orders, lows are 0 and volumes are fractional, so that the
    null, zero and truncation rules are all at work. Some bars have no close, and some customers' documents are spoilt.
    """
    bar = F.struct(
        F.col("o_orderkey").alias("seq"),
        dates.date_to_epoch(F.col("o_orderdate").cast("date")).alias("timestamp"),
        F.col("o_totalprice").alias("open"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("high"),
        F.lit(0.0).alias("low"),
        F.when(F.col("o_orderkey") % NO_CLOSE_CYCLE != 0, F.col("o_totalprice")).alias("close"),
        (F.col("o_totalprice") / 7).alias("volume"),
    )
    bars = orders.select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.floor(F.col("o_orderkey") / BARS_PER_DOCUMENT).cast("bigint").alias("part"),
        bar.alias("bar"),
    )
    # Collecting before the exchange would not make anything smaller.
    documents = (
        bars.repartition("ticker", "part")
        .groupBy("ticker", "part")
        .agg(F.array_sort(F.collect_list("bar")).alias("bars"))
    )

    def series(name: str):
        return F.transform("bars", lambda b: b[name]).alias(name)

    kind = F.col("ticker").cast("bigint") % SPOILT_CYCLE
    volumes = F.transform("bars", lambda b: b["volume"])
    volumes = F.when(kind == WITHOUT_VOLUMES, F.slice(volumes, 1, 0)).otherwise(volumes).alias("volume")
    quote = F.struct(*[series(c) for c in ("open", "high", "low", "close")], volumes)
    indicators = F.when(kind != WITHOUT_INDICATORS, F.struct(F.array(quote).alias("quote"))).alias("indicators")
    result = F.struct(series("timestamp"), indicators)
    body = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"})
    body = F.when(kind == CUT_OFF, F.substring(body, F.lit(1), F.length(body) - 3)).otherwise(body)
    status = F.when(kind == UNANSWERED, 429).otherwise(200)
    return documents.select("ticker", status.alias("status"), body.alias("body"), "part")


def _escaped(text):
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _item_element():
    """A document as an RSS item, its whole text as the title."""

    def element(name: str, value, attributes: str = ""):
        return F.concat(F.lit(f"<{name}{attributes}>"), _escaped(value), F.lit(f"</{name}>"))

    nothing = F.lit("")
    return F.concat(
        F.lit("<item>"),
        element("title", F.col("text")),
        F.when(F.col("lang") == "fr", nothing).otherwise(element("link", F.col("doc_id").cast("string"))),
        F.when(
            F.col("lang") == "en",
            element("pubDate", F.concat(F.lit("day "), F.col("n_chars").cast("string"))),
        ).otherwise(nothing),
        element("source", F.col("lang"), ' url="https://example.org/"'),
        F.lit("</item>"),
    )


def feeds_from_documents(documents: DataFrame) -> DataFrame:
    """Documents as RSS feeds, one feed page per source and block of document numbers, whole texts as titles.

    Only English articles carry a date and French ones have no link element, as in ``news_from_documents``.
    """

    item = _item_element()
    pages = (
        documents.withColumn("ticker", F.col("source"))
        .withColumn("part", F.floor(F.col("doc_id") / ITEMS_PER_DOCUMENT).cast("bigint"))
        .repartition("ticker", "part")
        .groupBy("ticker", "part")
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("item")))).alias("items"))
    )
    body = F.concat(
        F.lit('<rss version="2.0"><channel><title>feed</title>'),
        F.array_join(F.transform("items", lambda i: i["item"]), ""),
        F.when(F.col("ticker") == CUT_OFF_SOURCE, F.lit("<item><title>and th")).otherwise("</channel></rss>"),
    )
    status = F.when(F.col("ticker") == UNANSWERED_SOURCE, 503).otherwise(200)
    return pages.select("ticker", status.alias("status"), body.alias("body"), "part")


def feed_files_from_documents(documents: DataFrame, folder: str) -> None:
    """Documents as feed files of any length, a folder per source: each source's items in the order of their numbers, over the
    files of as many tasks as the rows are dealt to. Rows without a source are left out."""
    items = documents.where("source is not null").select(F.col("source").alias("ticker"), "doc_id", _item_element().alias("value"))
    ordered = items.repartitionByRange("ticker", "doc_id").sortWithinPartitions("ticker", "doc_id").select("ticker", "value")
    ordered.write.partitionBy("ticker").text(folder)
