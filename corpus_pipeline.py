"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glyphmill.llm.stages import STAGES
from glyphmill.sources.scratch import materialize

# The stages train models and cut by a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's result is written and read again.

    Nulls, empty and very long texts, repeated rows, empty tables and further
    columns are treated as each stage's function states.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


__all__ = ["ORACLE_SQL", "STAGES", "run"]
