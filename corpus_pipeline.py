"""Cleaning of the documents for training: every stage reads what its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from spendlens.llm import stages
from spendlens.session import fresh_path

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("tokens", stages.tokens),
]

# SQL can express neither the language model nor the fingerprints; tests/llm compares each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is stored and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
