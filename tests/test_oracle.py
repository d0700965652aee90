"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from contrail.plans.catalog import ORACLE, QUERIES  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    from check_oracle import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    from check_oracle import compare
    res = compare(spark, name, SF_SMALL, con)
    if name in ORACLE:
        assert res["status"] == "ok", res
    else:
        assert res["spark_rows"] >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["airline_icao", "name", "number_of_flights"]
    assert df.count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
