"""Log lines and attacker lists as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knockwatch.functions.text import drop_bad_bytes


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log files, folders or globs (also compressed) → one row ``line`` per text line."""
    return spark.read.text(paths).select(drop_bad_bytes(F.col("value")).alias("line"))


def read_attackers(table: DataFrame) -> DataFrame:
    """Known attackers from any table with an ``ip`` column, each address once."""
    return table.select("ip").filter(F.col("ip").isNotNull()).distinct()


def read_attackers_file(spark: SparkSession, path: str) -> DataFrame:
    """Known attackers from a Parquet, JSON or CSV file (with a header) by its ending, each with
    a column ``ip``; any other file has one address on each line."""
    ending = path.rstrip("/").rpartition(".")[2].lower()
    if ending == "csv":
        return read_attackers(spark.read.option("header", True).csv(path))
    if ending in ("parquet", "json"):
        return read_attackers(spark.read.format(ending).load(path))
    lines = spark.read.text(path).select(F.trim("value").alias("ip"))
    return read_attackers(lines.filter("ip <> ''"))
