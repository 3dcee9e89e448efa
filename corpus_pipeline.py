"""From raw documents to a training mixture, one stage after the other.

Each stage takes the rows its predecessor kept and returns a table with the columns of
``documents`` (the last adds the epoch of each copy). Every stage is written and read again,
so that a lost executor costs no more than the stage it was working on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from knockwatch.llm import decontaminate, host_rules, mixing, pii, simhash
from knockwatch.llm.queries import levels, weights
from knockwatch.llm.store import cut

#: The trees that judge personal data are fitted on what the SQL check cannot follow.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their host's verdict reject go."""
    return host_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id."""
    return simhash.keep_one(docs, width=4, max_distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are taken by their weights, a document as often as its leaf needs it."""
    return mixing.take(docs, mixing.mixture(docs, levels(), weights()))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
