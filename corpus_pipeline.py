"""Training-data pipeline over ``documents``: each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlake.llm import decontaminate, line_dedup, ngram_join, pieces, toxicity, work

STAGES = [
    ("toxicity", toxicity.stage),
    ("line_dedup", line_dedup.stage),
    ("ngram_join", ngram_join.stage),
    ("decontamination", decontaminate.stage),
    ("sentencepiece", pieces.stage),
]

#: Two stages rest on a fitted classifier and on merges over an agenda, which SQL can not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage but the last is written to the shared folder and read again."""
    docs = work.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
