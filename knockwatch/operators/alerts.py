"""All alerts in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.operators.failures import Source
from knockwatch.operators.rules import address_alerts, distributed_attack
from knockwatch.settings import RuleSettings

# The order in which the rules report.
RULE_ORDER = ["static_threshold", "adaptive_threshold", "account_diversity", "off_hours", "distributed_attack"]


def keep_first(alerts: DataFrame) -> DataFrame:
    """One alert per (ip, rule): the earliest, then the first target username."""
    order = [c for c in ("window_start", "first_seen", "target_username") if c in alerts.columns]
    first = F.struct(*order)
    one = alerts.groupBy("rule", "ip").agg(F.min_by(F.struct(*alerts.columns), first).alias("alert"))
    return one.select("alert.*")


def all_alerts(
    source: Source,
    baseline: DataFrame | None = None,
    settings: RuleSettings = RuleSettings(),
    profile: DataFrame | None = None,
) -> DataFrame:
    """The alerts of every rule, one per (ip, rule), in the common schema.

    Give ``Failures`` that keep their tables: then each of them is computed once.

    Rules 1 to 4 give one row per address by themselves; only subnet alerts can
    repeat (one per attacked username), so only they are de-duplicated.
    """
    wide = address_alerts(source, baseline, settings, profile)
    subnets = distributed_attack(source, settings)
    return wide.unionByName(keep_first(subnets), allowMissingColumns=True)


def ordered(alerts: DataFrame) -> DataFrame:
    """For a listing: by rule, then first time, then address."""
    rank = F.array_position(F.array(*[F.lit(r) for r in RULE_ORDER]), F.col("rule"))
    return alerts.orderBy(rank, F.coalesce("window_start", "first_seen"), "ip")
