"""The paths taken at scale give the oracle's answers end to end.

Forces range-partitioned session numbering, the salted shuffle join for
imputation (no broadcast, hot keys salted) and disables Spark's own
auto-broadcast, then compares the wrangles with their DuckDB oracles.
"""

import pytest

from conftest import SF_MID
from oracle_compare import duck, normalise
from churnlens.config import Tuning
from churnlens.plans.wrangle import wrangle_explore, wrangle_train
from churnlens.sources.events import adapt_events, load_events_table

TINY = Tuning(broadcast_max_rows=0, task_rows=10)


@pytest.mark.parametrize("name", ["wrangle_train", "wrangle_explore"])
def test_scale_paths_match_oracle(spark, name):
    import __spark_entry__ as E
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cs = adapt_events(load_events_table(spark, SF_MID), numbering="range")
        df = (wrangle_train if name == "wrangle_train" else wrangle_explore)(cs, tuning=TINY)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "__salt" in plan and "SortMergeJoin" in plan
    rel = duck(SF_MID).sql(E.oracle_sql()[name])
    assert normalise(df.columns, rows) == normalise(rel.columns, rel.fetchall())
