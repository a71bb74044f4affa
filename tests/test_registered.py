"""Every registered query: equal to its SQL on the smallest tables, and free of plans that do not scale."""

import pytest

from __spark_entry__ import entry
from oracle_check import compare, duck
from tapeline.catalogue.oracle import ORACLE
from tapeline.catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairing_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in plan


def test_texts_of_first_articles_are_not_sorted(spark):
    plan = QUERIES["news_first_nonnull"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_labels_are_made_after_sorting(spark):
    plan = QUERIES["price_table"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "format_number" in plan and "format_number" not in plan.split("Exchange rangepartitioning")[1]


def test_entry(spark):
    assert entry(spark).count() == 5
