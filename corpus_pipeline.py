"""The corpus pipeline: documents through the stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.stages import STAGES
from tidelog.storage import drop, scratch, scratch_folder

__all__ = ["ORACLE_SQL", "STAGES", "run"]

# Language models, fingerprint chains and token ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``. What a stage wrote for itself goes when
    its result is written, and that when the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with scratch_folder(spark, f"stage-{name}"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            drop(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
