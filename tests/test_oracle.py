"""Every SQL-checkable query against its DuckDB oracle (exact values, types, row count)."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, entry.queries()[key](spark, SF_SMALL), ORACLES[key])
    assert "error" not in res, res
    assert "type_mismatch" not in res, res
    assert res["spark_rows"] == res["oracle_rows"]


def test_every_query_has_oracle_or_is_model():
    missing = set(entry.queries()) - set(ORACLES)
    optional = {q for q in missing if q == "pipeline" or q.startswith("op")}  # have tests of their own
    assert missing - optional == {"forecast_gbt", "forecast_report"}
