"""Physical-plan properties: no Python UDFs, pruned scans, size-checked broadcast."""

import pytest

from conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
            "MapInPandas", "ExistingRDD", "PythonRDD")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


#: Their results are read back from tables that a stream or a fit has written; tests/test_oracle.py runs them.
READ_BACK = {"live_scoring", "live_users", "nested_grid", "training_facts"}


@pytest.mark.parametrize("name", sorted(set(__import__("__spark_entry__").oracle_sql()) - READ_BACK))
def test_no_python_in_plan(spark, name):
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), plan


def test_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    df = E.queries()["class_counts"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The events scan must not read the unused ``props`` column.
    assert "props" not in plan


def test_small_mean_table_is_broadcast(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["impute_length"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
