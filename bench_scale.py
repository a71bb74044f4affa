"""Times the row-heavy plans on growing copies of the orders, evenly spread and with one ticker holding a third.

Usage: python bench_scale.py [copies ...]   (default 10 and 100; prints one JSON line per table)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeline import bindings
from tapeline.operators import duplicates
from tapeline.plans import quality
from tapeline.plans.prices import last_bars
from tapeline.plans.returns import build_returns, top_performers
from tapeline.session import discard, local_session, new_folder
from tapeline.settings import Thresholds

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def copies_of(spark: SparkSession, copies: int, skewed: bool) -> DataFrame:
    """Every order ``copies`` times under new tickers; skewed: every third copy belongs to one ticker, half of it on
    one day."""
    prices = bindings.prices_from_orders(bindings.table(spark, FOLDER, "orders"))
    copy = F.col("copy")
    table = prices.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn(
        "seq", copy.cast("bigint") * 100_000_000 + F.col("seq")
    )
    own = F.concat_ws("_", "ticker", copy.cast("string"))
    if not skewed:
        return table.withColumn("ticker", own).drop("copy")
    return (
        table.withColumn("ticker", F.when(copy % 3 == 0, "HOT").otherwise(own))
        .withColumn("date", F.when(copy % 6 == 0, F.lit("2000-01-01").cast("date")).otherwise(F.col("date")))
        .drop("copy")
    )


def plans(prices: DataFrame) -> dict[str, DataFrame]:
    return {
        "returns": build_returns(prices),
        "returns_one_window": build_returns(prices, split_rows=None),
        "top_performers": top_performers(build_returns(prices)),
        "last_bars": last_bars(prices),
        "price_statistics": quality.price_statistics(prices, Thresholds()),
        "duplicate_rows": duplicates.duplicate_rows(prices, quality.SERIES_KEY),
    }


def main() -> None:
    spark = local_session(app="bench_scale", shuffle_partitions=64)
    for copies in [int(a) for a in sys.argv[1:]] or [10, 100]:
        for skewed in (False, True):
            path = new_folder(spark, "prices")
            copies_of(spark, copies, skewed).repartition(32).write.parquet(path)
            prices = spark.read.parquet(path)
            seconds = {}
            for name, plan in plans(prices).items():
                start = time.perf_counter()
                plan.write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - start, 2)
            print(json.dumps({"rows": prices.count(), "skewed": skewed, "seconds": seconds}), flush=True)
            discard(spark, path)
    spark.stop()


if __name__ == "__main__":
    main()
