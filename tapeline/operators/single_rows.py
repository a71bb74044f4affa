"""Combining one-row statistics of several datasets into one record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def combine(*rows: DataFrame) -> DataFrame:
    """One row with the columns of all inputs. Each input has exactly one row and its own column names.

    A union padded with NULL, reduced by ``max``: every column has one value at most, so it comes through unchanged.
    """
    names = [c for row in rows for c in row.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names repeat: {names}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in names])
