"""Dataset storage: versions of one Parquet table per dataset, recap sections partitioned by run date."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tapeline.functions import dates, numbers
from tapeline.sinks import commits


#: Folders of a dataset stored by month: year times 100 plus month.
MONTH = "stored_month"


def dataset_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def prepare(
    df: DataFrame, root: str, name: str, compact: bool = False, day: str | None = None, observe: dict[str, Column] | None = None
) -> commits.Version:
    """Store a dataset beside its present version, which readers keep until ``commits.commit``.

    ``compact`` is for datasets far smaller than the documents they come from: rows are rebalanced into files of the
    adaptive planner's target size instead of one small file per input split. With ``day``, a date column, rows are dealt by
    month, a month with many rows to several tasks, and stored in a folder per month in the order of their days, for
    ``reload_window``. Rows without a day have a folder of their own.

    ``observe`` names aggregates that the write job computes beside its work, found in the version's ``observed``. They are taken
    in the last stage, behind every exchange, where Spark counts each partition once however often its task is repeated.
    """
    observation = Observation() if observe else None
    watched = lambda rows: rows.observe(observation, *[c.alias(k) for k, c in observe.items()]) if observe else rows
    folder = dataset_path(root, name)
    if day is not None:
        dealt = watched(df.withColumn(MONTH, month_number(F.col(day))).hint("rebalance", MONTH))
        version = commits.write(dealt.sortWithinPartitions(MONTH, day), folder, MONTH)
    else:
        version = commits.write(watched(df.hint("rebalance") if compact else df), folder)
    return replace(version, observed=observation.get) if observe else version


def materialise(df: DataFrame, root: str, name: str, compact: bool = False, day: str | None = None) -> DataFrame:
    """Write a dataset under its name, replacing the previous version, and return it as read back. A write that fails leaves the
    previous version in place."""
    return commits.commit(prepare(df, root, name, compact, day))


def month_number(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def reload(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The present version of a dataset."""
    return commits.read(spark, dataset_path(root, name), schema)


def reload_window(
    spark: SparkSession, root: str, name: str, schema: T.StructType, as_of: datetime | Column, day: str = "date", days: int = dates.LOOKBACK_DAYS
) -> DataFrame:
    """The rows of a dataset stored by ``day`` whose days begin in the ``days`` before the run moment. Only folders of the months
    that the window meets are opened, and in their files only row groups with days of it."""
    first, last = dates.lookback_days(as_of, days)
    month = T.StructField(MONTH, T.IntegerType())
    rows = commits.read(spark, dataset_path(root, name), T.StructType([*schema.fields, month]))
    met = rows.where(F.col(MONTH).between(month_number(first), month_number(last)))
    return met.where(F.col(day).between(first, last)).select(*schema.names)


def run_date_of(spark: SparkSession, as_of: datetime | Column) -> str:
    """The run stamp as text, in the session's zone like every printed date."""
    return spark.range(1).select(dates.run_stamp(as_of)).first()[0]


def run_path(root: str, name: str, run_date: str) -> str:
    return f"{dataset_path(root, name)}/run_date={run_date}"


def write_recap(sections: dict[str, DataFrame], root: str, run_date: str) -> None:
    """Write every section into its run-date partition. A rerun on the same day replaces that partition, also by an
    empty section, and leaves other days alone."""
    for name, section in sections.items():
        section.write.mode("overwrite").parquet(run_path(root, name, run_date))


def read_recap(spark: SparkSession, root: str, name: str, run_date: str, schema: T.StructType) -> DataFrame:
    """One section of one run. The partition filter keeps the scan to that run's files."""
    stored = T.StructType([*schema.fields, T.StructField("run_date", T.StringType())])
    table = spark.read.schema(stored).parquet(dataset_path(root, name))
    return table.where(F.col("run_date") == run_date)


def recap_metrics(spark: SparkSession, root: str, run_date: str, names: list[str]) -> DataFrame:
    """Per written section: path, rows and size in kB."""

    def section(name: str) -> DataFrame:
        path = run_path(root, name, run_date)
        per_file = (
            spark.read.parquet(path)
            .groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("bytes"))
        )
        size = F.coalesce(F.sum("bytes"), F.lit(0)) / 1024.0
        return per_file.agg(
            F.lit(name).alias("section"),
            F.lit(path).alias("path"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            numbers.round_half_even(size).alias("size_kb"),
        )

    return reduce(lambda a, b: a.unionByName(b), [section(n) for n in names])
