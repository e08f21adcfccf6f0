"""Every registered query of the load engine against its DuckDB oracle (small scale).

The training-data queries are compared in ``tests/llm``.
"""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from strata import workloads
from tests.oracle_harness import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(workloads.SPARK))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, con)
    assert r.get("values_match"), r


def test_every_query_has_an_oracle():
    assert set(workloads.SPARK) == set(workloads.SQL)
    assert set(E.queries()) >= set(workloads.SPARK) and set(E.oracle_sql()) >= set(workloads.SQL)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_state", "event_type", "n_events", "n_users", "total_value"]
    assert df.count() > 0
