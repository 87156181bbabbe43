import pytest

import __spark_entry__ as contract
from tests import compare
from tidewire.llm.queries import ENTRIES

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries().keys()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(name for name, item in ENTRIES.items() if item.sql))
def test_query_equals_sql(spark, name):
    connection = compare.connect(FOLDER)
    df = ENTRIES[name].query(spark, FOLDER)
    assert compare.type_differences(connection, ENTRIES[name].sql, df) == {}
    ours = compare.spark_rows(df)
    assert compare.difference(ours, compare.sql_rows(connection, ENTRIES[name].sql)) is None


@pytest.mark.parametrize("name", ["op3_quality", "op9_toxicity", "op7_licenses"])
def test_query_keeps_every_document(spark, name):
    rows = ENTRIES[name].query(spark, FOLDER)
    assert rows.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
