"""Every registered query against its SQL on DuckDB."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, connection, name):
    problems = compare(spark, connection, name, SF)
    # Some lists are empty at this scale; then both must be.
    assert [p for p in problems if p != "no rows"] == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "Template_name"
    assert result.count() > 0
