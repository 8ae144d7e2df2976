"""Queries with a DuckDB form, compared value by value."""

import pytest
from checks.compare import differences, oracle_connection
from narrata.llm.queries import CHECKS


@pytest.mark.parametrize("name", [n for n, (_, sql) in CHECKS.items() if sql])
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    run, sql = CHECKS[name]
    assert differences(run(spark, sf_dir), oracle_connection(sf_dir), sql) == []


def test_entry_registers_all():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {*CHECKS, "pipeline"} <= names
    assert {n.split("_")[0] for n in CHECKS} == {f"op{i}" for i in range(1, 14)}
