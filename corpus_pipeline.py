"""A corpus from raw documents: quality rules, near duplicates, decontamination, mixing, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``. Between
stages the rows are written as Parquet under the shared folder and read again.
A stage bears what its operator's docstring says of nulls, empty and long
texts, repeated rows, empty tables and further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm import decontaminate, jaccard, mixing, quality, sharding
from churnlens.operators.checkpoint import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
N_SHARDS = 24


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the distances from their language."""
    return quality.quality_rules(docs).filter("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one with the smallest id."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without (variants of) benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_leaks(docs, decontaminate.find_leaks(docs, benchmark, keyed=True))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight draws it."""
    return mixing.mix_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn documents' places in N_SHARDS shards of equal bytes."""
    return sharding.balanced_shards(docs, N_SHARDS)


STAGES = [("quality_rules", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: None: the distances' sums, the shingle links and look-behind patterns are beyond DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
