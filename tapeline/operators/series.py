"""Operators along a series: previous value, first rows and last rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapeline.operators import keys as hot
from tapeline.session import hold


def previous_value(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    out: str,
    split_rows: int | None = hot.SPLIT_ROWS,
    root: str | None = None,
    most_broadcast: int = hot.BROADCAST_KEYS,
) -> DataFrame:
    """Add the value of the preceding row of the same key. Rows without a key are dropped.

    Ordinary keys take one window over ``key``. Keys above ``split_rows`` are split along the order instead, see
    ``_previous_in_slices``, which stores their rows below ``root`` or the shared folder. Whether there are any is looked
    up when the plan is made. With ``split_rows=None`` the caller vouches that every key is short.
    The order columns together must be unique within a key. ``df`` is read more than once: store expensive inputs.
    """
    keyed = df.where(F.col(key).isNotNull())
    if split_rows is None:
        return _previous(keyed, key, order, value, out)
    long = hot.long_series(keyed, key, order, split_rows)
    ordinary, split = hot.divided(keyed, long, [key], order, most_broadcast)
    plain = _previous(ordinary, key, order, value, out)
    return plain if split is None else plain.unionByName(_previous_in_slices(split, key, order, value, out, root))


def _ordering(order: list[str]) -> list:
    return [F.col(c).asc_nulls_last() for c in order]


def _previous(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*_ordering(order))
    return df.withColumn(out, F.lag(value).over(window))


def _previous_in_slices(
    df: DataFrame, key: str, order: list[str], value: str, out: str, root: str | None
) -> DataFrame:
    """The same result for keys of any length.

    Rows are range-partitioned on (key, order), which cuts a long key into slices of similar size. Inside a slice an
    ordinary window does the work. Only the first row of a slice lacks its neighbour, the last row of an earlier
    slice; so the edge rows of all slices of a key, two per slice, and no others meet in a second window. All readers
    must see the same slices, so the sliced rows are stored.
    """
    names = df.columns
    sliced = df.repartitionByRange(F.col(key), *_ordering(order)).withColumn("_slice", F.spark_partition_id())
    inside = Window.partitionBy("_slice", key).orderBy(*_ordering(order))
    marked = hold(
        sliced.select(
            *names,
            F.lag(value).over(inside).alias("_inside"),
            F.lag(F.lit(True), 1, False).over(inside).alias("_has_before"),
            F.lead(F.lit(True), 1, False).over(inside).alias("_has_after"),
        ),
        root,
    )
    edges = marked.where(~(F.col("_has_before") & F.col("_has_after")))
    across = Window.partitionBy(key).orderBy(*_ordering(order))
    firsts = edges.withColumn(out, F.lag(value).over(across)).where(~F.col("_has_before"))
    return marked.where("_has_before").select(*names, F.col("_inside").alias(out)).unionByName(firsts.select(*names, out))


def first_rows(df: DataFrame, key: str, order: list[str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key. Spark cuts each input partition to ``n`` rows per key before the shuffle."""
    return _leading(df, key, [F.col(c).asc_nulls_last() for c in order], n)


def last_rows(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows of every key, cut before the shuffle like ``first_rows``."""
    return _leading(df, key, [F.col(c).desc_nulls_first() for c in order], n)


def _leading(df: DataFrame, key: str, ordering: list, n: int) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def first_present(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key, the first non-missing value of each column on its own; rows without a key are dropped.

    A first pass finds the places, numbers only, combined before the shuffle; then only the rows at these places, one per
    column and key at most, are fetched. ``order`` must be unique within a key.
    """
    keyed = df.where(F.col(key).isNotNull())
    places = keyed.groupBy(key).agg(*[F.min(F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in columns])
    wanted = places.select(key, F.explode(F.array_distinct(F.array(*[f"_{c}" for c in columns]))).alias(order))
    rows = keyed.join(wanted.where(F.col(order).isNotNull()), [key, order], "left_semi")
    held = rows.groupBy(key).agg(F.collect_list(F.struct(order, *columns)).alias("_rows"))
    found = places.join(held, key, "left")

    def at(name: str):
        matching = F.filter("_rows", lambda row: row[order] == F.col(f"_{name}"))
        return F.get(matching, F.lit(0))[name].alias(name)

    return found.select(key, *[at(c) for c in columns])
