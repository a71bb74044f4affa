"""Duplicate detection on a key; missing equals missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeline.operators import keys as hot, sieve
from tapeline.session import hold


def duplicate_rows(
    df: DataFrame, keys: list[str], split_rows: int = hot.SPLIT_ROWS, most_broadcast: int = hot.BROADCAST_KEYS, root: str | None = None
) -> DataFrame:
    """All rows whose key occurs more than once.

    Cells of the key's hash are counted first, in one pass, and those with several rows stored (below ``root``, or the shared
    folder). A bitmap of them drops nearly all rows of single keys in the scan; keys are counted exactly among the others only.
    Rows of a very frequent key are duplicates by definition: they are picked by a list of such keys and never meet in one task.
    """
    cells = hold(sieve.count_sketch(df, keys).where(F.col("n") > 1), root)
    found = cells.agg(F.count(F.lit(1)).alias("cells"), F.max("n").alias("most")).first()
    if not found["cells"]:
        return df.where(F.lit(False))
    bits = sieve.size_of(found["cells"])
    passed = sieve.passing(df, keys, hold(sieve.bitmap(cells, bits), root), bits)
    repeated = hot.key_counts(passed, keys).where(F.col("n") > 1)
    if found["most"] <= split_rows:  # no key is more frequent than its cell
        return hot.keep_matching(passed, repeated.select(*keys), keys, "left_semi")
    ordinary, frequent = hot.divided(passed, hot.hot_keys(repeated, keys, split_rows), keys, df.columns, most_broadcast)
    found = hot.keep_matching(ordinary, repeated.select(*keys), keys, "left_semi")
    return found if frequent is None else found.unionByName(frequent)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """The number of rows whose key occurs more than once, as a one-row table."""
    counts = hot.key_counts(df, keys)
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicates")
    )
