"""The normal level of failures, taken from quiet traffic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.operators.failures import Failures, Source, hourly_rows
from knockwatch.settings import RuleSettings


def hourly_failures_by_ip(source: Source) -> DataFrame:
    """Failures per address and clock hour."""
    if isinstance(source, Failures):
        return source.hours.select("ip", "hour", "failures")
    return hourly_rows(source).groupBy("ip", "hour").agg(F.sum("failures").alias("failures"))


def global_baseline(source: Source, settings: RuleSettings = RuleSettings()) -> DataFrame:
    """One row: ``quiet_buckets``, their ``median`` and the ``baseline``.

    A bucket (address, hour) is quiet with at most ``quiet_limit`` failures, so the
    exact median keeps at most that many distinct values in its buffer.
    """
    quiet = hourly_failures_by_ip(source).filter(F.col("failures") <= settings.quiet_limit)
    stats = quiet.agg(F.count(F.lit(1)).alias("quiet_buckets"), F.median("failures").alias("median"))
    level = F.greatest(
        F.lit(settings.baseline_floor), F.col("median").cast("int") + settings.baseline_headroom
    )
    return stats.withColumn(
        "baseline",
        F.when(F.col("median").isNotNull(), level).otherwise(F.lit(settings.fallback_baseline)),
    )


def baseline_by_ip(source: Source, settings: RuleSettings = RuleSettings()) -> DataFrame:
    """Every address with a failure and its baseline: the same for all, because a new
    attacker has no history of its own that could be trusted."""
    level = global_baseline(source, settings).select("baseline").scalar()
    return hourly_rows(source).select("ip").distinct().withColumn("baseline", level)
