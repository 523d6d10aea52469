"""Summarise the physical plan of every oracle-checked query.

Counts shuffle exchanges, broadcasts, join strategies and windows in the
executed (adaptive, final) plan after running the query once.

Usage: python tests/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summary(df) -> dict:
    df.collect()  # runs this plan itself (a write would run a plan of its own), at the small size
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition|Exchange RoundRobin", final)),
        "broadcasts": final.count("BroadcastExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", final)),
        "python": any(k in final for k in ("BatchEvalPython", "ArrowEvalPython")),
    }


if __name__ == "__main__":
    from churnlens import local_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    qs = E.queries()
    print("| query | shuffles | broadcasts | BHJ | SMJ | windows | python |")
    print("|---|---|---|---|---|---|---|")
    for name in E.oracle_sql():
        s = summary(qs[name](spark, sf))
        print(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | "
              f"{s['windows']} | {'yes' if s['python'] else 'no'} |", flush=True)
