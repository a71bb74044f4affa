"""Reading the tables the operators run on, and stored intermediates."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.session import new_folder

_NUMBERS = itertools.count()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rest(column: str, modulus: int):
    """crc32 of a number's text, modulo ``modulus``: which fold a document is in."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written below the cluster's shared folder and read again: its lineage ends there, and a lost executor
    takes nothing with it. With ``by``, in a folder per value of that column, so that a filter on it reads only its folder."""
    spark = df.sparkSession
    folder = new_folder(spark, f"{name}-{next(_NUMBERS)}")
    (df.write.partitionBy(by) if by else df.write).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
