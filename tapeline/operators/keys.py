"""Hot keys: the few keys with so many rows that they must not share one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# A key above this many rows is spread over several tasks.
SPLIT_ROWS = 1_000_000

# Hot keys up to this many are broadcast; a longer list is matched by a shuffle on key and salt.
BROADCAST_KEYS = 100_000
SALTS = 32

# Large keys are recognised from one row in this many, but never from fewer than about SURE_ROWS rows of a key.
SIZING_SHARE = 64
SURE_ROWS = 1_000


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key, combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, keys: list[str], split_rows: float = SPLIT_ROWS) -> DataFrame:
    """All keys above ``split_rows``: no more than the rows divided by ``split_rows``."""
    return counts.where(F.col("n") > split_rows).select(*keys)


def long_series(df: DataFrame, key: str, order: list[str], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Keys with about ``split_rows`` rows or more, sized from a share of the rows.

    This only decides which of two exact routes a key takes, so an estimate is enough and saves shuffling a count for
    every key of the table. The share is chosen by a hash of the order columns, the same on every evaluation.
    """
    share = max(1, min(SIZING_SHARE, split_rows // SURE_ROWS))
    sized = df if share == 1 else df.where(F.pmod(F.xxhash64(*order), F.lit(share)) == 0)
    return hot_keys(key_counts(sized, [key]), [key], split_rows / share)


def divided(
    df: DataFrame, hot: DataFrame, keys: list[str], spread: list[str], most: int = BROADCAST_KEYS
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and rows of hot keys, the latter None when there is no hot key.

    The hot keys are looked up once, when the plan is made, so that both parts agree and tables without hot keys pay
    for no join. Up to ``most`` of them are broadcast. Beyond, both sides are shuffled on the key and a salt made from
    the ``spread`` columns, so that the rows of a hot key meet its copies of the list in SALTS tasks.
    """
    found = hot.limit(most + 1).collect()
    if not found:
        return df, None
    if len(found) <= most:
        listed = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema))
        return keep_matching(df, listed, keys, "left_anti"), keep_matching(df, listed, keys, "left_semi")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    listed = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = [*keys, "_salt"]
    return tuple(keep_matching(salted, listed, both, how).drop("_salt") for how in ("left_anti", "left_semi"))


def keep_matching(df: DataFrame, keys_table: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``df`` with (left_semi) or without (left_anti) the rows whose key is in ``keys_table``; missing equals missing."""
    a, b = df.alias("a"), keys_table.alias("b")
    condition = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return a.join(b, condition, how)
