"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as registry
from tests.compare import spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, name):
    got = spark_rows(registry.QUERIES[name](spark, SF))
    assert got == sql_rows(registry.ORACLES[name], SF)


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["conv_id", "turn", "input", "prompt", "inference"]
    assert result.count() > 0
