"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from adlake.plans.oracles import ORACLES
from adlake.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracles import compare


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_entry_module_serves_every_warehouse_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    ok, ns, nd, _, msg = compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, f"{name}: spark={ns} duck={nd} {msg}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "branch_id" in df.columns
