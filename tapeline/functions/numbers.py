"""Numeric expressions: missing values, percentage change, rounding and number texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86_400


def nan_as_null(value: Column) -> Column:
    """Missing is NULL throughout; Spark orders NaN above every number, so it must not reach a comparison."""
    return F.when(~F.isnan(value), value)


def above(value: Column, limit: float) -> Column:
    """Greater than the limit, and a number. Both are plain comparisons, so that a scan can use them: NaN is the one
    value beyond infinity."""
    return (value > limit) & (value <= float("inf"))


def or_zero(value: Column) -> Column:
    """NULL and 0 both become 0."""
    return F.coalesce(value, F.lit(0.0))


def is_missing(name: str, dtype: str) -> Column:
    value = F.col(name)
    return value.isNull() | F.isnan(value) if dtype in ("double", "float") else value.isNull()


def missing_cells(dtypes: list[tuple[str, str]]) -> Column:
    """Number of missing cells of one row over the given ``(name, type)`` columns."""
    flags = [is_missing(name, dtype).cast("bigint") for name, dtype in dtypes]
    return reduce(lambda a, b: a + b, flags)


def percent_change(difference: Column, base: Column) -> Column:
    """``difference / base * 100`` with IEEE results for a zero base; an undefined result is NULL."""
    by_zero = F.when(difference > 0, F.lit(float("inf"))).when(difference < 0, F.lit(float("-inf")))
    return nan_as_null(F.when(base == 0, by_zero).otherwise(F.try_divide(difference, base) * 100))


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def _special(value: Column, finite: Column) -> Column:
    return (
        F.when(value.isNull() | F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .otherwise(finite)
    )


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed-point text, rounding the exact binary value half to even (``2.675`` gives ``2.67``), below 2 to the 63.

    From 1e13 on the fraction has ten binary digits at most, so that scaling it is exact and whole part and fraction can be
    printed as integers.
    """
    ordinary = F.call_function("format_number", value, F.lit("0." + "0" * digits))
    size = F.abs(value)
    whole = F.floor(size)
    parts = F.rint((size - whole) * float(10**digits)).cast("bigint")
    carried = whole.cast("bigint") + F.floor(parts / 10**digits).cast("bigint")
    fraction = F.lpad(F.pmod(parts, F.lit(10**digits)).cast("string"), digits, "0")
    large = F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), carried.cast("string"), F.lit("."), fraction)
    return _special(value, F.when((size >= 1e13) & (size < 2.0**63), large).otherwise(ordinary))


def money_text(value: Column) -> Column:
    return F.concat(F.lit("$"), fixed_text(value, 2))


def percent_text(value: Column) -> Column:
    return F.concat(fixed_text(value, 2), F.lit("%"))


def ratio_text(value: Column) -> Column:
    """A ratio as a percentage with one digit: ``0.8`` gives ``80.0%``."""
    return F.concat(fixed_text(value * 100, 1), F.lit("%"))


def shortest_text(value: Column) -> Column:
    """The shortest text that reads back as the same number, plain between 1e-4 and 1e16, else with an exponent."""
    size = F.abs(value)
    # The platform's own text sometimes has one digit more than needed, so 16 digits are tried first.
    short = F.format_string("%.15e", value)
    digits = F.when(short.try_cast("double") == value, short).otherwise(F.format_string("%.16e", value))
    plain = F.rtrim(digits.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    scientific = F.regexp_replace(digits, r"\.?0*e", "e")
    return _special(
        value,
        F.when(size == 0, value.cast("string")).when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific),
    )
