"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token output.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``. Empty tables, null columns and repeated rows pass through
as each operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, mixing, quality, simhash, tokens
from quire.llm.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a proven cutoff rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, stored(quality.measured(docs), "quality"), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.draw(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token sequences in training order."""
    return tokens.shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("token output", token_output),
]

#: No SQL: XXH64 fingerprints, proven cutoffs and byte-pair tokens are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
