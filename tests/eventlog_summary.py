"""Per-query stage time from a Spark event log (no UI needed).

Usage: python tests/eventlog_summary.py EVENT_LOG_FILE
Attributes each job to its job group (bench.py sets one per query) and sums
the wall time of the job's stages; also lists the slowest stages.
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log file or of a rolling (v2) event-log folder."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw))
        else:
            with open(f) as fh:
                yield from fh


def summarise(path: str, top: int = 5) -> None:
    job_group, stage_job, stages = {}, {}, {}
    if True:
        for line in _lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = group
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    stages[info["Stage ID"]] = (info["Stage Name"], info["Number of Tasks"],
                                                info["Completion Time"] - info["Submission Time"])
    per = defaultdict(lambda: [0, 0, 0])
    for sid, (_, _, ms) in stages.items():
        g = job_group.get(stage_job.get(sid), "-")
        per[g][0] += 1
        per[g][1] += ms
    for jid, g in job_group.items():
        per[g][2] += 1
    print("| query | jobs | stages | stage ms |")
    print("|---|---|---|---|")
    for g, (n_st, ms, n_jobs) in sorted(per.items(), key=lambda kv: -kv[1][1]):
        print(f"| {g} | {n_jobs} | {n_st} | {ms} |")
    print("\nslowest stages:")
    for sid, (name, tasks, ms) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]:
        print(f"  stage {sid} ({job_group.get(stage_job.get(sid), '-')}): {ms} ms, {tasks} tasks, {name[:80]}")


if __name__ == "__main__":
    summarise(sys.argv[1])
