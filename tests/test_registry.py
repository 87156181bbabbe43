import pytest

import __spark_entry__ as contract
from tests import compare
from tidewire.registry import all_entries

FOLDER = "/root/testdata/sf0.001"
# the library's own queries; those of the optional subpackage are tested beside it
NAMES = sorted(all_entries())
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in NAMES}
ROWS_ONLY = {"stamp", "model_score", "scored_stream"}


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_all_but_a_few_have_sql():
    assert set(NAMES) - set(SQL) == ROWS_ONLY


def test_entry(spark):
    assert contract.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    df = contract.queries()[name](spark, FOLDER)
    assert compare.type_differences(connection, SQL[name], df) == {}
    ours = compare.spark_rows(df)
    assert compare.difference(ours, compare.sql_rows(connection, SQL[name])) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_keeps_all_rows(spark, name):
    source = "events" if name == "stamp" else "documents"
    rows = contract.queries()[name](spark, FOLDER).count()
    assert rows == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()


@pytest.mark.parametrize("name", [n for n in NAMES
                                  if "stream" not in n and n not in (
                                      "batch_metrics", "survey_board", "social_board")])
def test_no_python_and_no_cross_join_in_the_plan(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin"):
        assert word not in plan
