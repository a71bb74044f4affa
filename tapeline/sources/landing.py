"""Landed documents: what a crawler left behind, as one table with a row per document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeline import schemas
from tapeline.sources.documents import HTTP_OK

# Bits of a part's number; 31 bits are left above the position in a document, the rest of them is for the batch.
PART_BITS = 20
MAX_BATCHES = 1 << 11


def landed_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table of documents."""
    return spark.read.schema(schemas.DOCUMENTS).parquet(path)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One file per document, named after its ticker (``AAPL.json``, ``BTC-USD.xml``); each was answered."""
    name = F.col("_metadata.file_name")
    return spark.read.text(path, wholetext=True).select(
        F.url_decode(F.regexp_replace(name, r"\.[^.]*$", "")).alias("ticker"),
        F.lit(HTTP_OK).alias("status"),
        F.col("value").alias("body"),
    )


def landed_batches(*batches: DataFrame) -> DataFrame:
    """Separately landed batches as one table; the n-th batch continues the series and feeds of those before it.

    Parts are numbered anew by (batch, part), so no two documents of a ticker share a number. A batch without part numbers
    counts as one part per ticker. Parts must be below 2 to the PART_BITS, which leaves room for a batch number in front and
    the positions in a document behind; a larger one raises.
    """
    return reduce(lambda a, b: a.unionByName(b), [_numbered(b, i) for i, b in enumerate(batches)])


def _numbered(batch: DataFrame, number: int) -> DataFrame:
    if number >= MAX_BATCHES:
        raise ValueError(f"more than {MAX_BATCHES} batches")
    if "part" not in batch.columns:
        batch = batch.withColumn("part", F.lit(0).cast("bigint"))
    batch = schemas.conform_documents(batch)
    part = F.coalesce("part", F.lit(0).cast("bigint"))
    fits = part.between(0, (1 << PART_BITS) - 1)
    wrong = F.raise_error(F.concat(F.lit("part number out of range: "), part.cast("string"))).cast("bigint")
    return batch.withColumn("part", F.when(fits, part + (number << PART_BITS)).otherwise(wrong))
