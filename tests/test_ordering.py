"""Running numbers, top rows, CSV previews and single-row records."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeline.operators import ordering, single_rows


def test_running_number_equals_a_sort(spark):
    generator = random.Random(5)
    keys = generator.sample(range(100_000), 3_000)
    df = spark.createDataFrame([(f"k{k}", k) for k in keys], "name string, k int").repartition(9)
    numbered = ordering.running_number(df, ordering.in_order("name"), "position")
    found = {r.position: r.name for r in numbered.collect()}
    assert [found[i + 1] for i in range(len(keys))] == sorted(f"k{k}" for k in keys)
    assert dict(numbered.dtypes)["position"] == "bigint"


def test_running_number_of_nothing(spark):
    df = spark.createDataFrame([], "name string")
    assert ordering.running_number(df, ordering.in_order("name"), "n").collect() == []


def test_highest_first_puts_missing_last(spark):
    df = spark.createDataFrame([("a", float("nan")), ("b", None), ("c", 1.0), ("d", 2.0), ("e", 2.0)], "k string, v double")
    found = [r.k for r in ordering.top_rows(df, ordering.highest_first("v", "k"), 5).collect()]
    assert found == ["d", "e", "c", "a", "b"]


def test_csv_preview_equals_pandas(spark):
    rows = [
        ("a,b", 1.5, None, 3), ('say "x"', 1e7, 2.0, 4), ("line\nbreak", 1e-5, 1e16, 5), (None, 0.1, -3.25, 6), ("", 2.0, 1.0, 7)
    ]
    df = spark.createDataFrame(rows, "t string, x double, y double, n bigint")
    csv = ordering.csv_preview(df, [F.col("n")], 4, ["t", "x", "y", "n"]).first()
    frame = pd.DataFrame(rows, columns=["t", "x", "y", "n"])
    assert csv.rows == 4 and csv.csv == frame.head(4).to_csv(index=False)


def test_csv_preview_of_nothing_is_a_header(spark):
    df = spark.createDataFrame([], "t string, x double")
    row = ordering.csv_preview(df, [F.col("t")], 5, ["t", "x"]).first()
    assert (row.rows, row.csv) == (0, "t,x\n")


def test_single_rows(spark):
    one = spark.createDataFrame([(1, None)], "a int, b string")
    two = spark.createDataFrame([(["x"],)], "c array<string>")
    assert tuple(single_rows.combine(one, two).first()) == (1, None, ["x"])
    with pytest.raises(ValueError, match="repeat"):
        single_rows.combine(one, one)
