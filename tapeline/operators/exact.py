"""Sums and means of doubles that do not depend on the order of the rows.

Every finite double is a whole number of units of a power of two. Units are taken from powers 8 apart, so that the whole number
fits in 62 bits, and are added up as integers in four pieces of 16 bits: integer addition gives the same result in whatever
order and in however many parts rows are combined. There are 264 unit sizes at most, so the table of partial sums is small, may be
stored per batch and merged by addition. In the end the pieces are carried into the one base-256 numeral of the exact sum, which
is rounded once. A mean is that sum divided by the count.

Missing values (NULL, NaN) are left out. An infinity makes the result infinite, both of them make it NaN. Up to 2 to the 46 rows of a
unit size; sums below 2 to the -1000 may be rounded twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tapeline.functions import numbers

_PIECES, _PIECE_BITS = 4, 16
_STEP = 8
_MANTISSA = 53
#: Digits of the numeral that are rounded to a double; all lower ones only count as something or nothing.
_DIGITS = 12
_LOWEST = "unit"
_SUMS = [f"piece{k}" for k in range(_PIECES)]


def _power(exponent: Column, value: Column) -> Column:
    """``value`` times 2 to the ``exponent``, in two steps so that neither factor leaves the range of doubles."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def partial_sums(df: DataFrame, value: Column) -> DataFrame:
    """One row per unit size: the pieces' sums and the number of values; infinities have no unit size."""
    rows = df.select(numbers.nan_as_null(value.cast("double")).alias("x")).where("x is not null")
    finite = F.abs("x") < float("inf")
    # the exponent may be off by one where the logarithm is rounded; the unit leaves room for that
    exponent = F.floor(F.log2(F.abs("x"))).cast("int")
    unit = F.when(finite, F.when(F.col("x") == 0, F.lit(0)).otherwise(_STEP * F.floor((exponent - _MANTISSA) / _STEP))).cast("int")
    whole = F.when(finite, _power(-F.col(_LOWEST), F.col("x")).cast("bigint"))
    rows = rows.select("x", unit.alias(_LOWEST)).select(_LOWEST, whole.alias("whole"), "x")
    last = _PIECES - 1
    pieces = [
        F.shiftright("whole", _PIECE_BITS * k) if k == last else F.shiftright("whole", _PIECE_BITS * k).bitwiseAND(F.lit(2**_PIECE_BITS - 1))
        for k in range(_PIECES)
    ]
    return rows.groupBy(_LOWEST).agg(
        *[F.coalesce(F.sum(p), F.lit(0)).alias(name) for p, name in zip(pieces, _SUMS)],
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("x") == float("inf")).alias("above"),
        F.count_if(F.col("x") == float("-inf")).alias("below"),
    )


def merged(*parts: DataFrame) -> DataFrame:
    """Partial sums of several batches as those of all their rows."""
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.groupBy(_LOWEST).agg(*[F.sum(c).alias(c) for c in [*_SUMS, "n", "above", "below"]])


def _numeral(sign: int) -> Column:
    """Base-256 digits from ``first`` on, lowest first, of the sum times ``sign``; the last entry is the carry, -1 below zero."""

    def step(made: Column, place: Column) -> Column:
        here = F.filter("entries", lambda e: e["place"] == place)
        carried = F.element_at(made, -1)
        total = F.aggregate(here, carried, lambda a, e: a + sign * e["value"])
        kept = F.slice(made, F.lit(1), F.size(made) - 1)
        return F.concat(kept, F.array(total.bitwiseAND(F.lit(255).cast("bigint")), F.shiftright(total, 8)))

    return F.aggregate(F.sequence(F.col("first"), F.col("last")), F.array(F.lit(0).cast("bigint")), step)


def total_and_count(parts: DataFrame) -> DataFrame:
    """One row from partial sums: ``total``, the exact sum rounded once (null without values), and ``n``."""
    entries = F.flatten(
        F.transform(
            F.collect_list(F.when(F.col(_LOWEST).isNotNull(), F.struct(_LOWEST, *_SUMS))),  # 263 at most
            lambda e: F.array(
                *[F.struct((F.floor(e[_LOWEST] / _STEP) + 2 * k).cast("int").alias("place"), e[name].alias("value")) for k, name in enumerate(_SUMS)]
            ),
        )
    )
    zero = F.lit(0).cast("bigint")
    row = parts.agg(
        entries.alias("entries"),
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n", "above", "below")],
    )
    places = F.transform("entries", lambda e: e["place"])
    row = row.withColumns({"first": F.coalesce(F.array_min(places), F.lit(0)), "last": F.coalesce(F.array_max(places), F.lit(0)) + 8})
    row = row.withColumn("digits", _numeral(1)).withColumn("negative", F.element_at("digits", -1) < 0)
    row = row.withColumn("digits", F.when(F.col("negative"), _numeral(-1)).otherwise(F.col("digits")))
    lowest_first = F.transform("digits", lambda d, i: F.when(d != 0, i))
    row = row.withColumn("top", F.coalesce(F.array_max(lowest_first), F.lit(0)))
    row = row.withColumn("from", F.greatest(F.col("top") - (_DIGITS - 1), F.lit(0)))
    leading = F.aggregate(
        F.reverse(F.slice("digits", F.col("from") + 1, F.col("top") - F.col("from") + 1)),
        F.lit(0).cast("decimal(38,0)"),
        lambda a, d: (a * F.lit(256).cast("decimal(3,0)") + d.cast("decimal(3,0)")).cast("decimal(38,0)"),
    )
    rest = F.when(F.exists(F.slice("digits", F.lit(1), F.col("from")), lambda d: d != 0), F.lit(1)).otherwise(F.lit(0))
    doubled = (leading * F.lit(2).cast("decimal(1,0)") + rest.cast("decimal(1,0)")).cast("decimal(38,0)").cast("double")
    size = _power(_STEP * (F.col("first") + F.col("from")) - 1, doubled)
    finite = F.when(F.col("negative"), -size).otherwise(size)
    total = (
        F.when(F.col("n") == 0, F.lit(None).cast("double"))
        .when((F.col("above") > 0) & (F.col("below") > 0), F.lit(float("nan")))
        .when(F.col("above") > 0, F.lit(float("inf")))
        .when(F.col("below") > 0, F.lit(float("-inf")))
        .otherwise(finite)
    )
    return row.select(total.alias("total"), "n")


def exact_mean(df: DataFrame, value: Column, name: str) -> DataFrame:
    """The mean of ``value`` as a one-row table with the column ``name``: the same bits for every order and partitioning."""
    return total_and_count(partial_sums(df, value)).select(F.try_divide(F.col("total"), F.col("n")).alias(name))
