import pytest

from llm_cases import SF001, _shipped  # noqa: F401
from sentispark.llm.queries import ORACLES, QUERIES
from sentispark.plans.compare import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got = compare(QUERIES[name](spark, SF001), duckdb_connection(SF001), ORACLES[name])
    assert got["columns_match"] and got["spark_rows"] == got["oracle_rows"] and got["values_match"], got
