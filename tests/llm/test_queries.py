"""The registered queries against their SQL, and what the registry must hold."""

import pytest

import __spark_entry__ as registry
import corpus_pipeline
from promptloom.llm import queries
from tests.compare import spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14))
    assert registry.queries()["pipeline"] is corpus_pipeline.run
    assert queries.ORACLES.keys() <= queries.QUERIES.keys()


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == sql_rows(queries.ORACLES[name], SF)
