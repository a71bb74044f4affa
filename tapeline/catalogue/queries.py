"""One registered query per operator group, each over the whole provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapeline import bindings
from tapeline.functions import dates, numbers
from tapeline.operators import duplicates, ordering, single_rows, sketches
from tapeline.plans import metrics, news as news_plans, prices as price_plans, quality, recap, returns as return_plans
from tapeline.session import new_folder
from tapeline.settings import Thresholds
from tapeline.sinks import commits, tables
from tapeline.sources import documents as decoders, feed_files, landing, manifest
from tapeline.sources.documents import decode_payloads

# Thresholds under which the provided tables pass some checks and fail others.
NARROW = Thresholds(min_price=2_000.0, max_price=499_000.0)

RUN_MOMENT = "2001-08-01 12:00:00Z"
RUN_DATE = "20010801"
# A series above this many rows is split by the queries that show it.
SPLIT_ROWS = 5
EVENTS_MOMENT = "2024-01-27 00:00:00Z"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def run_moment():
    return F.lit(RUN_MOMENT).cast("timestamp")


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.prices_from_orders(bindings.table(spark, folder, "orders"))


def gappy_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices in which pending orders have no close yet."""
    orders = bindings.table(spark, folder, "orders")
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return bindings.prices_from_orders(orders.withColumn("o_totalprice", settled))


def universe(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.universe_from_customers(bindings.table(spark, folder, "customer"))


def wide_universe(spark: SparkSession, folder: str) -> DataFrame:
    customers, parts = (bindings.table(spark, folder, name) for name in ("customer", "part"))
    return bindings.universe_with_parts(customers, parts)


def returns_of(spark: SparkSession, folder: str) -> DataFrame:
    return return_plans.build_returns(prices(spark, folder))


def news(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.news_from_documents(bindings.table(spark, folder, "documents"))


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.payloads_from_orders(bindings.table(spark, folder, "orders"))


def feeds(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.feeds_from_documents(bindings.table(spark, folder, "documents"))


def report(spark: SparkSession, folder: str) -> quality.QualityReport:
    return quality.quality_checks(
        prices(spark, folder), returns_of(spark, folder), universe(spark, folder), NARROW
    )


# Returns and recap


@query
def returns(spark, folder):
    return returns_of(spark, folder)


@query
def returns_split(spark, folder):
    return return_plans.build_returns(prices(spark, folder), split_rows=SPLIT_ROWS)


@query
def returns_summary(spark, folder):
    return recap.market_summary(returns_of(spark, folder))


@query
def top_performers(spark, folder):
    return return_plans.top_performers(returns_of(spark, folder))


@query
def price_table(spark, folder):
    return recap.price_table(returns_of(spark, folder))


@query
def recap_summary(spark, folder):
    return recap.recap_summary(returns_of(spark, folder), report(spark, folder).summary, run_moment())


@query
def summary_lines(spark, folder):
    return recap.summary_lines(
        recap.recap_summary(returns_of(spark, folder), report(spark, folder).summary, run_moment())
    )


@query
def quality_lines(spark, folder):
    return recap.quality_lines(report(spark, folder).summary)


# Payloads and feeds


@query
def prices_from_json(spark, folder):
    return decode_payloads(payloads(spark, folder)).drop("seq")


@query
def rejected_payloads(spark, folder):
    """Payloads that give no bars, and why; words for prices, documents run together and empty results are added to the spoilt ones."""
    landed = payloads(spark, folder)
    kind = F.col("ticker").cast("bigint") % 50
    body = F.when(kind == 19, F.regexp_replace("body", r'"open":\[', '"open":["none",')).otherwise(F.col("body"))
    body = F.when(kind == 23, F.concat(body, body)).when(kind == 29, F.lit('{"chart": {"result": []}}')).otherwise(body)
    return decoders.rejected_payloads(decoders.parsed_payloads(landed.withColumn("body", body)))


@query
def build_prices(spark, folder):
    return price_plans.build_prices(payloads(spark, folder), universe(spark, folder)).drop("seq")


@query
def build_prices_in_window(spark, folder):
    bars = price_plans.build_prices(
        payloads(spark, folder), universe(spark, folder), as_of=run_moment(), keep_last=None
    )
    return bars.drop("seq")


@query
def landed_batches(spark, folder):
    """Two batches of parted documents; the second one's bars follow the first one's."""
    orders = bindings.table(spark, folder, "orders")
    early = F.col("o_orderkey") % 4 < 2
    batches = [bindings.payloads_from_orders(orders.where(x)) for x in (early, ~early)]
    bars = decode_payloads(landing.landed_batches(*batches))
    place = F.row_number().over(Window.partitionBy("ticker").orderBy("seq"))
    return bars.select("ticker", "date", "close", place.alias("place"))


@query
def price_gate(spark, folder):
    """What the demand for prices says to all payloads, and to payloads none of which was answered."""
    landed = payloads(spark, folder)
    cases = {"as landed": landed, "unanswered": landed.withColumn("status", F.lit(429))}
    said = []
    for name, documents in cases.items():
        try:
            price_plans.require_prices(price_plans.build_prices(documents, keep_last=None))
            said.append((name, "passed"))
        except price_plans.NoPriceData as refusal:
            said.append((name, str(refusal)))
    return spark.createDataFrame(said, "case string, outcome string")


@query
def quality_gate(spark, folder):
    """What the demand for a score says below and above the score of all prices."""
    summary = report(spark, folder).summary
    said = []
    for least in (None, 0.2, 0.9):
        try:
            quality.require_quality(summary, least)
            said.append((least, "passed"))
        except quality.QualityGateFailed:
            said.append((least, "refused"))
    return spark.createDataFrame(said, "least double, outcome string")


@query
def coerced_dates(spark, folder):
    """Dates as texts, some of which are no dates, and as timestamps, read as dates."""
    orders = bindings.table(spark, folder, "orders")
    shown = F.date_format("o_orderdate", "yyyy-MM-dd")
    texts = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, F.concat(F.lit("on "), shown)).otherwise(shown).alias("date"))
    moments = orders.select("o_orderkey", (F.col("o_orderdate").cast("timestamp_ntz") + F.expr("interval 23 hours")).alias("date"))
    read = [price_plans.coerce_dates(x).select(F.lit(kind).alias("kind"), F.col("o_orderkey").alias("seq"), "date") for kind, x in (("text", texts), ("moment", moments))]
    return read[0].unionByName(read[1])


@query
def news_of_silent_feeds(spark, folder):
    """News of feeds none of which was answered: an empty table, and its metrics."""
    silent = feeds(spark, folder).withColumn("status", F.lit(503))
    return metrics.news_metrics(news_plans.build_news(silent))


@query
def last_bars(spark, folder):
    return price_plans.last_bars(prices(spark, folder), 2)


@query
def feed_items(spark, folder):
    return news_plans.feed_items(feeds(spark, folder)).drop("seq")


@query
def feed_file_items(spark, folder):
    """Feed files read in splits, their items numbered in the order of tickers, files and places."""
    landed = new_folder(spark, "feeds")
    bindings.feed_files_from_documents(bindings.table(spark, folder, "documents"), landed)
    items = feed_files.feed_file_items(spark, landed)
    return ordering.running_number(items, ordering.in_order("ticker", "seq"), "position").drop("seq")


@query
def news_from_xml(spark, folder):
    return news_plans.build_news(feeds(spark, folder)).drop("seq")


@query
def first_articles(spark, folder):
    return news_plans.first_articles(news(spark, folder))


@query
def news_digest(spark, folder):
    return news_plans.news_digest(news(spark, folder))


@query
def news_first_nonnull(spark, folder):
    gaps = (
        news(spark, folder)
        .withColumn("title", F.when(F.col("publisher") == "en", F.col("title")))
        .withColumn("published_date", F.nullif("published_date", F.lit("N/A")))
        .withColumn("link", F.nullif("link", F.lit("")))
    )
    return news_plans.first_article_fields(gaps)


# Requests and dates


@query
def search_phrases(spark, folder):
    customers = bindings.table(spark, folder, "customer")
    symbol = F.when(
        F.col("c_mktsegment") == "MACHINERY", F.concat("c_name", F.lit("-USD"))
    ).otherwise(F.col("c_name"))
    return manifest.request_manifest(customers.select(symbol.alias("ticker")), run_moment())


@query
def epoch_to_day(spark, folder):
    seconds = bindings.epoch_seconds(F.col("ts"))
    start, end = dates.lookback_bounds(F.lit(EVENTS_MOMENT).cast("timestamp"))
    events = bindings.table(spark, folder, "events").select(
        dates.epoch_to_date(seconds).alias("day"), seconds.alias("seconds")
    )
    return events.groupBy("day").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("seconds").between(start, end)).alias("events_in_window"),
        F.min("seconds").alias("first_second"),
    )


@query
def date_range(spark, folder):
    return metrics.date_range(prices(spark, folder))


# Quality


@query
def completeness(spark, folder):
    return quality.completeness(prices(spark, folder), wide_universe(spark, folder))


@query
def failed_tickers(spark, folder):
    return metrics.failed_tickers(prices(spark, folder), wide_universe(spark, folder))


@query
def failed_lines(spark, folder):
    return metrics.failed_lines(metrics.failed_tickers(prices(spark, folder), wide_universe(spark, folder)))[0]


@query
def invalid_prices(spark, folder):
    return quality.invalid_prices(prices(spark, folder), NARROW)


@query
def missing_cells(spark, folder):
    bars = gappy_prices(spark, folder)
    returns = return_plans.build_returns(bars)
    closes = return_plans.with_changes(return_plans.previous_closes(bars))
    return quality.single_rows.combine(
        quality.missing_total(bars, ["ticker", "date", "close"], "missing_prices"),
        quality.missing_total(closes, ["prev_close", "daily_return", "return_pct"], "missing_changes"),
        quality.return_statistics(returns, NARROW).select("missing_returns"),
    )


@query
def outliers(spark, folder):
    return quality.outliers(returns_of(spark, folder))


@query
def duplicate_rows(spark, folder):
    return duplicates.duplicate_rows(prices(spark, folder), quality.SERIES_KEY)


@query
def duplicate_count(spark, folder):
    return duplicates.duplicate_count(prices(spark, folder), quality.SERIES_KEY)


@query
def quality_checks(spark, folder):
    return report(spark, folder).checks


@query
def quality_checks_wide(spark, folder):
    bars = prices(spark, folder)
    return quality.collect_checks(bars, return_plans.build_returns(bars), wide_universe(spark, folder))


@query
def quality_checks_gappy(spark, folder):
    bars = gappy_prices(spark, folder)
    return quality.collect_checks(bars, return_plans.build_returns(bars), universe(spark, folder))


@query
def quality_checks_clean(spark, folder):
    """One bar per customer: nothing repeats and no return exists, so all five checks pass."""
    bars = price_plans.last_bars(prices(spark, folder), 1)
    return quality.collect_checks(
        bars, return_plans.build_returns(bars, split_rows=None), universe(spark, folder)
    )


@query
def quality_score(spark, folder):
    return report(spark, folder).summary.select("data_completeness", "quality_score", "warnings")


@query
def warnings(spark, folder):
    return report(spark, folder).warnings


# Metrics, previews and labels


@query
def price_metrics(spark, folder):
    return metrics.price_metrics(prices(spark, folder), wide_universe(spark, folder))


@query
def observed_metrics(spark, folder):
    """The price metrics with rows and dates taken while the prices are written, symbols counted from the stored table."""
    root = new_folder(spark, "observed")
    version = tables.prepare(prices(spark, folder), root, "prices", day="date", observe=metrics.price_observations())
    written = commits.commit(version)
    return metrics.price_metrics(written, wide_universe(spark, folder), root=root, observed=version.observed)


@query
def observed_counts(spark, folder):
    """The counts of the news and returns metrics from the jobs that write them."""
    root = new_folder(spark, "observed")
    told = tables.prepare(news_plans.build_news(feeds(spark, folder)), root, "news", compact=True, observe=metrics.news_observations())
    made = tables.prepare(returns_of(spark, folder), root, "returns", observe=metrics.returns_observations())
    return single_rows.combine(
        metrics.news_metrics(commits.commit(told), observed=told.observed).withColumnRenamed("preview", "news_preview"),
        metrics.returns_metrics(commits.commit(made), made.observed),
    )


@query
def news_metrics(spark, folder):
    return metrics.news_metrics(news_plans.build_news(feeds(spark, folder)))


@query
def returns_metrics(spark, folder):
    return metrics.returns_metrics(returns_of(spark, folder))


@query
def quality_metrics(spark, folder):
    return metrics.quality_metrics(report(spark, folder).summary)


@query
def csv_preview(spark, folder):
    columns = ["ticker", "date", "close", "prev_close", "daily_return", "return_pct"]
    return ordering.csv_preview(
        returns_of(spark, folder), ordering.in_order("ticker", "date", "seq"), 5, columns
    )


@query
def price_labels(spark, folder):
    labelled = recap.with_labels(returns_of(spark, folder))
    return labelled.select(
        "ticker",
        "seq",
        "close_label",
        "daily_return_label",
        "return_pct_label",
        numbers.shortest_text(F.col("return_pct")).alias("return_pct_text"),
        numbers.round_half_even(F.col("return_pct")).alias("return_pct_rounded"),
        return_plans.direction(F.col("return_pct")).alias("direction"),
        dates.run_stamp(run_moment()).alias("run_date"),
        dates.run_title(run_moment()).alias("run_title"),
    )


# Storage


@query
def materialise_roundtrip(spark, folder):
    return tables.materialise(returns_of(spark, folder), new_folder(spark, "roundtrip"), "returns")


@query
def stored_window(spark, folder):
    """Prices stored by month, of which the week before the run moment is read."""
    root = new_folder(spark, "by_month")
    rows = prices(spark, folder)
    tables.materialise(rows, root, "prices", day="date")
    return tables.reload_window(spark, root, "prices", rows.schema, run_moment())


@query
def distinct_sketches(spark, folder):
    """Tickers counted from stored sketches of yearly batches, and in the summary's approximate form, against the exact count."""
    rows = prices(spark, folder)
    batches = sketches.distinct_sketches(rows.withColumn("batch", F.year("date")), "ticker", ["batch"])
    stored = tables.materialise(batches, new_folder(spark, "sketches"), "tickers")
    found = single_rows.combine(
        stored.agg(F.count(F.lit(1)).alias("batches")),
        sketches.approximate_distinct(stored, "merged"),
        recap.market_summary(returns_of(spark, folder), approximate=True).select(F.col("distinct_tickers").alias("summarised"), "total_assets"),
        returns_of(spark, folder).agg(F.count_distinct("ticker").alias("tickers_with_returns")),
        rows.agg(F.count_distinct("ticker").alias("distinct_tickers")),
    )
    near = lambda estimate, exact: F.abs(F.col(estimate) - F.col(exact)) <= 0.02 * F.col(exact)
    return found.select(
        "batches",
        "total_assets",
        "distinct_tickers",
        "tickers_with_returns",
        near("merged", "distinct_tickers").alias("merged_is_near"),
        near("summarised", "tickers_with_returns").alias("summarised_is_near"),
    )


@query
def replaced_dataset(spark, folder):
    """A dataset committed twice, with a write that stays uncommitted and one that fails midway after it; as readers see it."""
    root = new_folder(spark, "replaced")
    rows = returns_of(spark, folder)
    tables.materialise(rows.where("close < 100000"), root, "returns")
    tables.materialise(rows, root, "returns")
    tables.prepare(rows.where("close < 50000"), root, "returns")
    broken = F.when(F.col("seq") % 2 == 0, F.raise_error(F.lit("no such price"))).otherwise(F.col("close"))
    try:
        tables.materialise(rows.withColumn("close", broken.cast("double")), root, "returns")
    except Exception as failure:  # the kind depends on where the task failed
        if "no such price" not in str(failure):
            raise
    return tables.reload(spark, root, "returns", rows.schema)


@query
def recap_roundtrip(spark, folder):
    root = new_folder(spark, "recap")
    section = recap.price_table(returns_of(spark, folder))
    tables.write_recap({"price_table": section}, root, RUN_DATE)
    return tables.read_recap(spark, root, "price_table", RUN_DATE, section.schema)


@query
def recap_metrics(spark, folder):
    root = new_folder(spark, "recap")
    stored = tables.materialise(returns_of(spark, folder), root, "returns")
    checked = quality.quality_checks(prices(spark, folder), stored, universe(spark, folder), NARROW)
    sections = recap.recap(stored, news(spark, folder), checked, run_moment()).sections()
    tables.write_recap(sections, f"{root}/sections", RUN_DATE)
    written = tables.recap_metrics(spark, f"{root}/sections", RUN_DATE, list(sections))
    place = F.regexp_extract("path", r"/(sections/.*)$", 1).alias("place")
    return written.select("section", "rows", place, (F.col("size_kb") > 0).alias("has_size"))
