"""Lineage cuts that survive executor loss.

A materialised table is written as parquet under the session's shared
``spark.checkpoint.dir`` and read back, so later stages restart from it
instead of rescanning the source. ``localCheckpoint`` (executor-local, lost
with the executor) is never used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_observed(df: DataFrame, name: str = "table", path: str | None = None,
                         **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregate ``metrics`` observed during the write.

    The metrics come from the write job itself (``Observation``), so no second
    job lists and reads the footers of every written file.
    """
    path = path or scratch_path(df.sparkSession, name)
    obs = Observation(f"metrics-{uuid.uuid4().hex}")
    exprs = [m.alias(k) for k, m in metrics.items()]
    df.observe(obs, *exprs).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), dict(obs.get)


def materialize_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``materialize`` plus the number of rows written (observed, no extra job)."""
    out, m = materialize_observed(df, name, rows=F.count(F.lit(1)))
    return out, int(m["rows"])
