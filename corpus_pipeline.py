"""The corpus pipeline: quality, near copies, personal data, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilake.llm import stages

STAGES = stages.STAGES
#: Classifier fitting and similarity search have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    return stages.run(spark, sf_dir)
