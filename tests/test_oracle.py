"""Every deterministic query equals its DuckDB oracle (the driver's check, locally)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["churn", "count"]
    assert sorted(tuple(r) for r in df.collect()) == [(0, 742), (1, 54), (2, 19)]


def test_every_oracle_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(__import__("__spark_entry__").oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["cols"], res
    assert res["types"], res
    assert res["rows"], res
    assert res["values"], res
