"""The five detection rules.

Rules 1 to 4 are keyed by address and read one row per address, the profile:
best bursts, off-hours totals and, for rule 3, the number of usernames tried.
A single rule uses the part of the profile it needs (the rest is pruned from the
plan); ``all_alerts`` computes the profile once for all of them.

Every rule takes attempts, or the ``Failures`` counted from them before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.functions.addresses import subnet_key
from knockwatch.operators.bursts import Burst, best, slice_micros, trailing_ranges
from knockwatch.operators.failures import Failures, Source, hourly_rows
from knockwatch.schemas import ALERTS
from knockwatch.settings import RuleSettings

DEFAULTS = RuleSettings()


# ---------------------------------------------------------------- inputs


def _off_hours_totals(settings: RuleSettings, time: str, n: str, first: str, last: str) -> list[Column]:
    """Aggregates over rows that stand for ``n`` failures from ``first`` to ``last``, all in the clock hour of ``time``."""
    off = f"hour({time}) < {settings.working_hours_start} or hour({time}) >= {settings.working_hours_end}"
    return [
        F.expr(f"sum(if({off}, {n}, 0)) as off_count"),
        F.expr(f"min(if({off}, {first}, null)) as off_first"),
        F.expr(f"max(if({off}, {last}, null)) as off_last"),
    ]


def ip_profile(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """One row per failing address: its best burst per rule and its off-hours totals."""
    bursts = [
        Burst("static", "n", settings.static_window),
        Burst("adaptive", "n", settings.adaptive_window),
        Burst("diversity", "named", settings.account_diversity_window),
    ]
    failures = Failures.of(source)
    size = slice_micros(failures.hours, max(b.width for b in bursts))
    return trailing_ranges(failures.seconds, ["ip"], bursts, size).groupBy("ip").agg(
        *[best(b.name) for b in bursts], *_off_hours_totals(settings, "timestamp", "n", "timestamp", "timestamp")
    )


def usernames_tried(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """Addresses that tried at least ``account_diversity_min`` usernames over the whole input."""
    return (
        Failures.of(source)
        .usernames.groupBy("ip")
        .agg(F.count(F.lit(1)).alias("unique_usernames"))
        .filter(F.col("unique_usernames") >= settings.account_diversity_min)
    )


def with_baseline(
    profile: DataFrame, baseline: DataFrame | None, settings: RuleSettings = DEFAULTS
) -> DataFrame:
    """Add ``baseline``: from a table (``ip``, ``baseline``), from a one-row table
    (``baseline``), or the fallback value alone.

    An address that the table names several times has the greatest of its baselines; a
    null address stands for the empty one; an address without a baseline has the fallback.
    """
    fallback = F.lit(settings.fallback_baseline)
    if baseline is None:
        return profile.withColumn("baseline", fallback)
    if "ip" not in baseline.columns:
        return profile.withColumn("baseline", baseline.select("baseline").scalar())
    table = baseline.groupBy(F.coalesce("ip", F.lit("")).alias("ip")).agg(F.max("baseline").alias("baseline"))
    return profile.join(table, "ip", "left").withColumn("baseline", F.coalesce("baseline", fallback))


# ---------------------------------------------------------------- rules


@dataclass(frozen=True)
class ProfileRule:
    """A rule over the profile: when it fires, and the fields of its alert (SQL text)."""

    name: str
    condition: str
    fields: dict[str, str]

    def alerts(self, profile: DataFrame) -> DataFrame:
        own = [f"{expression} as {field}" for field, expression in self.fields.items()]
        return profile.filter(self.condition).selectExpr(f"'{self.name}' as rule", "ip", *own)

    def wide(self) -> str:
        """The alert in the common schema, null when the rule does not fire."""
        known = {"rule": f"'{self.name}'", "ip": "ip", **self.fields}
        fields = [
            f"cast({known.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
            for f in ALERTS.fields
        ]
        return f"if({self.condition}, struct({', '.join(fields)}), null)"


def _burst_fields(name: str) -> dict[str, str]:
    return {
        "failed_count": f"-{name}.negated",
        "window_start": f"{name}.window_start",
        "window_end": f"{name}.window_end",
    }


def static_rule(s: RuleSettings) -> ProfileRule:
    return ProfileRule(
        "static_threshold", f"-static.negated >= {s.static_threshold}", _burst_fields("static")
    )


def adaptive_rule(s: RuleSettings) -> ProfileRule:
    limit = f"greatest({s.adaptive_floor}, int(baseline * double('{s.adaptive_multiplier}') / 2))"
    return ProfileRule(
        "adaptive_threshold",
        f"-adaptive.negated >= {limit}",
        {"threshold_used": limit, **_burst_fields("adaptive")},
    )


def diversity_rule(s: RuleSettings) -> ProfileRule:
    return ProfileRule(
        "account_diversity",
        f"unique_usernames >= {s.account_diversity_min}",
        {"unique_usernames": "unique_usernames", **_burst_fields("diversity")},
    )


def off_hours_rule(s: RuleSettings) -> ProfileRule:
    return ProfileRule(
        "off_hours",
        f"off_count >= {s.off_hours_min}",
        {"failed_count": "off_count", "first_seen": "off_first", "last_seen": "off_last"},
    )


def static_threshold(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """Addresses with at least ``static_threshold`` failures within ``static_window`` seconds."""
    return static_rule(settings).alerts(ip_profile(source, settings))


def adaptive_threshold(
    source: Source, baseline: DataFrame | None = None, settings: RuleSettings = DEFAULTS
) -> DataFrame:
    """Addresses whose best ``adaptive_window`` burst reaches half their baseline times the
    multiplier (and the floor)."""
    profile = with_baseline(ip_profile(source, settings), baseline, settings)
    return adaptive_rule(settings).alerts(profile)


def account_diversity(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """Addresses that try many accounts. Usernames are counted over the whole input,
    ``failed_count`` is the best burst, so it can be the smaller number."""
    profile = ip_profile(source, settings).join(usernames_tried(source, settings), "ip")
    return diversity_rule(settings).alerts(profile)


def off_hours(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """Addresses with failures outside working hours. With start > end every hour is outside."""
    totals = hourly_rows(source).groupBy("ip").agg(*_off_hours_totals(settings, "hour", "failures", "first", "last"))
    return off_hours_rule(settings).alerts(totals)


def distributed_attack(source: Source, settings: RuleSettings = DEFAULTS) -> DataFrame:
    """Several addresses of one /24 subnet failing on one username, one row per (subnet, username).

    The failures of the whole input must lie within ``distributed_window`` seconds: this
    is no sliding range, and one stray failure much later hides the attack.

    Failures shrink to one row per (address, username) before they meet on
    (subnet, username), and groups are judged by numbers alone. Only the addresses of groups
    that fire are listed; a subnet key leaves the last part of the address open, so a list
    is short however many failures it stands for.
    """
    tried = Failures.of(source).usernames.withColumn("subnet", subnet_key(F.col("ip")))
    fired = (
        tried.groupBy("subnet", "username")
        .agg(
            F.count(F.lit(1)).alias("ips"),
            F.sum("n").alias("failed_count"),
            F.min("first").alias("window_start"),
            F.max("last").alias("window_end"),
        )
        .filter(
            f"ips >= {settings.distributed_min_ips}"
            f" and window_end - window_start <= interval '{settings.distributed_window}' second"
        )
    )
    listed = tried.select("subnet", "username", "ip").join(fired, ["subnet", "username"])
    found = ["subnet", "username", "failed_count", "window_start", "window_end"]
    return listed.groupBy(*found).agg(F.array_sort(F.collect_list("ip")).alias("attacking_ips")).selectExpr(
        "'distributed_attack' as rule",
        "concat(subnet, '.0/24') as ip",
        "attacking_ips",
        "username as target_username",
        "failed_count",
        "window_start",
        "window_end",
    )


def address_alerts(
    source: Source, baseline: DataFrame | None = None, settings: RuleSettings = DEFAULTS, profile: DataFrame | None = None
) -> DataFrame:
    """The alerts of rules 1 to 4 in the common schema, from one pass over the profile (``profile``, where there is one)."""
    profile = with_baseline(ip_profile(source, settings) if profile is None else profile, baseline, settings)
    profile = profile.join(usernames_tried(source, settings), "ip", "left")
    rules = [static_rule(settings), adaptive_rule(settings), diversity_rule(settings), off_hours_rule(settings)]
    fired = f"array_compact(array({', '.join(r.wide() for r in rules)}))"
    return profile.selectExpr(f"explode({fired}) as alert").select("alert.*")
