"""Small tables behind the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knockwatch.functions.addresses import has_four_parts, is_private, subnet_key
from knockwatch.operators.failures import Source, hourly_rows
from knockwatch.operators.rules import adaptive_rule, ip_profile, static_rule, with_baseline
from knockwatch.settings import RuleSettings


def rule_breakdown(alerts: DataFrame) -> DataFrame:
    """Alerts per rule."""
    return alerts.groupBy("rule").agg(F.count(F.lit(1)).alias("alerts"))


def rule_share(alerts: DataFrame) -> DataFrame:
    """Alerts per rule and their share in percent, to one decimal.

    The total runs over the breakdown, which has one row per rule.
    """
    total = F.sum("alerts").over(Window.partitionBy())
    share = F.bround(F.col("alerts") * 100.0 / total, 1)
    return rule_breakdown(alerts).withColumn("share_percent", share)


def failure_timeline(source: Source) -> DataFrame:
    """Failures per clock hour, in order; hours without failures are absent."""
    return hourly_rows(source).groupBy("hour").agg(F.sum("failures").alias("failures")).orderBy("hour")


def top_failing_ips(source: Source, limit: int = 10) -> DataFrame:
    """The addresses with most failures; ties go to the one seen first."""
    return (
        hourly_rows(source)
        .groupBy("ip")
        .agg(F.sum("failures").alias("failures"), F.min("first").alias("first_seen"))
        .orderBy(F.desc("failures"), "first_seen", "ip")
        .limit(limit)
    )


def external_subnets(source: Source, min_ips: int = 2) -> DataFrame:
    """/24 subnets outside the private ranges with at least ``min_ips`` failing addresses."""
    ip = F.col("ip")
    return (
        hourly_rows(source)
        .filter(has_four_parts(ip) & ~is_private(ip))
        .select("ip")
        .distinct()
        .groupBy(subnet_key(ip).alias("subnet"))
        .agg(F.count(F.lit(1)).alias("failing_ips"))
        .filter(F.col("failing_ips") >= min_ips)
        .orderBy(F.desc("failing_ips"), "subnet")
    )


def static_vs_adaptive(
    source: Source, baseline: DataFrame, settings: RuleSettings = RuleSettings(), profile: DataFrame | None = None
) -> DataFrame:
    """Number of alerts of the static and of the adaptive rule, from one profile (``profile``, where there is one)."""
    profile = with_baseline(ip_profile(source, settings) if profile is None else profile, baseline, settings)
    counted = profile.agg(
        F.count_if(F.expr(static_rule(settings).condition)).alias("Static"),
        F.count_if(F.expr(adaptive_rule(settings).condition)).alias("Adaptive"),
    )
    return counted.unpivot([], ["Static", "Adaptive"], "strategy", "alerts")


def report_totals(outcome_counts: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: ``attempts``, ``skipped`` and ``alerts``."""
    counted = outcome_counts.select("attempts", "skipped", F.lit(0).cast("long").alias("alerts"))
    raised = alerts.agg(F.count(F.lit(1)).alias("alerts")).select(
        F.lit(0).cast("long").alias("attempts"), F.lit(0).cast("long").alias("skipped"), "alerts"
    )
    return counted.unionByName(raised).agg(*[F.sum(c).alias(c) for c in ("attempts", "skipped", "alerts")])
