"""Sinks: scored tables (S6) and fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write a result table (the reference rendered HTML on the driver)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def save_pipeline(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline, replacing any old one at ``path``."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(path)
