"""Sorted outputs: top rows, full sorts, running numbers and CSV previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeline.functions import numbers, text
from tapeline.session import hold


def highest_first(value: str, *ties: str) -> list[Column]:
    """Descending, missing last, ties in the given order."""
    return [numbers.nan_as_null(F.col(value)).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]


def in_order(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def top_rows(df: DataFrame, ordering: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of an order: a top-n per partition, then one merge of the survivors."""
    return df.orderBy(*ordering).limit(n)


def running_number(df: DataFrame, ordering: list[Column], out: str, root: str | None = None) -> DataFrame:
    """Number all rows 1, 2, ... along an order, without bringing them into one task.

    Rows are range-partitioned and numbered inside their slice; the slice's offset is the row count of the slices
    before it. Offsets and numbers must refer to the same cut, so the sliced rows are stored first, below ``root`` or
    the shared folder. The offset table has one row per shuffle partition.
    """
    sliced = hold(df.repartitionByRange(*ordering).withColumn("_slice", F.spark_partition_id()), root)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_slice").orderBy(*ordering)
    return (
        sliced.withColumn("_number", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_slice")
        .select(*df.columns, (F.col("_number") + F.col("_before")).cast("bigint").alias(out))
    )


def _field_text(name: str, dtype: str) -> Column:
    value = F.col(name)
    if dtype == "string":
        return text.csv_field(value)
    if dtype in ("double", "float"):
        return F.when(numbers.is_missing(name, dtype), "").otherwise(numbers.shortest_text(value))
    return F.coalesce(value.cast("string"), F.lit(""))


def csv_preview(df: DataFrame, ordering: list[Column], n: int, columns: list[str]) -> DataFrame:
    """The first ``n`` rows of an order as one CSV text with a header: a one-row table ``(rows, csv)``."""
    types = dict(df.dtypes)
    head = top_rows(df, ordering, n).select(
        F.monotonically_increasing_id().alias("position"),
        F.concat_ws(",", *[_field_text(c, types[c]) for c in columns]).alias("line"),
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("position", "line"))), lambda r: r["line"])
    header = F.array(F.lit(",".join(columns)))
    return head.agg(
        F.count(F.lit(1)).alias("rows"),
        F.concat(F.array_join(F.concat(header, lines), "\n"), F.lit("\n")).alias("csv"),
    )
