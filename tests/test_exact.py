"""Sums and means that do not depend on the order of the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tapeline.operators import exact


def mean(spark, values, parts=1, order=0):
    values = list(values)
    random.Random(order).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return exact.exact_mean(df, F.col("x"), "m").first()["m"]


def hard(seed, n):
    """Values of all sizes, most of which cancel."""
    draw = random.Random(seed)
    some = [draw.uniform(-1, 1) * 2.0 ** draw.randint(-60, 60) for _ in range(n)]
    return [*some, *(-x for x in some[: n - 3]), 1e-300, 0.1, 3e15]


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_same_bits_for_every_partitioning(spark, parts):
    values = hard(3, 300)
    right = math.fsum(values) / len(values)
    assert mean(spark, values, parts, order=parts) == right


@pytest.mark.parametrize(
    "values",
    [
        [0.0],
        [-0.0, 0.0],
        [0.1] * 10,
        [1e308, -1e308, 5e-324],
        [-1.0, -2.0**-60],
        [2.0**53, 1.0, 1.0],
        [1.0, 2.0**-53, 2.0**-200],
        [-(2.0**53), -1.0, -(2.0**-300)],
        [1e-310, 2.5e-310],
        [8.0**k for k in range(-100, 100)],
        [math.nextafter(2.0**k, 0) for k in range(-40, 40)],
        [1.7e308],
    ],
)
def test_equals_the_rounded_exact_sum(spark, values):
    assert mean(spark, values) == math.fsum(values) / len(values)


def test_missing_and_infinite_values(spark):
    nan, inf = float("nan"), float("inf")
    assert mean(spark, [None, nan]) is None
    assert mean(spark, [1.0, None, nan, 2.0]) == 1.5
    assert mean(spark, [1.0, inf]) == inf and mean(spark, [-inf, 3.0]) == -inf
    assert math.isnan(mean(spark, [inf, -inf, 1.0]))


def test_batches_merge_by_addition(spark):
    values = hard(5, 200)
    parts = [exact.partial_sums(spark.createDataFrame([(v,) for v in values[k::3]], "x double"), F.col("x")) for k in range(3)]
    row = exact.total_and_count(exact.merged(*parts)).first()
    assert (row["total"], row["n"]) == (math.fsum(values), len(values))


def test_rows_are_combined_before_they_move(spark):
    plan = exact.partial_sums(spark.range(9), F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
