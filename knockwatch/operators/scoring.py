"""Alerts scored against known attackers.

All comparisons are equi-joins on short keys. No side is forced to broadcast: Spark
broadcasts what it has measured to be small and shuffles the rest. Attackers are first
reduced to their distinct keys, counted on the map side, and those to the ones that were
reported; only attackers with such a key are looked at again. A first octet shared by
millions of attackers is one key, and moves none of them unless it was reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.functions.addresses import covered_prefix, dotted_prefixes, is_subnet
from knockwatch.sources.readers import read_attackers

KEY = ["kind", "value"]


def reported_keys(alerts: DataFrame) -> DataFrame:
    """What the alerts name, once each: ``kind`` (address or prefix), ``value`` and the number of ``reports``.

    All scores start from this table; store it where several are wanted.
    """
    ip = F.col("ip")
    subnet = is_subnet(ip)
    return (
        alerts.select(
            F.when(subnet, "prefix").otherwise("address").alias("kind"),
            F.when(subnet, covered_prefix(ip)).otherwise(ip).alias("value"),
        )
        .filter("value is not null")
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("reports"))
    )


def _named_by(listed: DataFrame) -> DataFrame:
    """Each attacker ``ip`` with all it can be reported by: itself and its dotted prefixes."""
    own = F.struct(F.lit("address").alias("kind"), F.col("ip").alias("value"))
    prefixes = F.transform(dotted_prefixes(F.col("ip")), lambda p: F.struct(F.lit("prefix").alias("kind"), p.alias("value")))
    return listed.select("ip", F.inline(F.concat(F.array(own), prefixes)))


def _hits(reported: DataFrame, named: DataFrame) -> DataFrame:
    """The reported keys that name an attacker, with the number of ``attackers``."""
    keys = named.groupBy(*KEY).agg(F.count(F.lit(1)).alias("attackers"))
    return reported.join(keys, KEY)


def detected_addresses(alerts: DataFrame) -> DataFrame:
    """Distinct addresses named by an alert (subnets left out)."""
    return alerts.filter(~is_subnet(F.col("ip"))).select("ip").distinct()


def subnet_coverage(alerts: DataFrame, attackers: DataFrame) -> DataFrame:
    """Every subnet alert with the number of attackers inside it.

    An attacker lies in a subnet when the address starts with the subnet's prefix and
    a dot. Attackers are counted per dotted prefix first, so the join adds one number
    to each alert and emits no pairs.
    """
    ip = F.col("ip")
    inside = (
        _named_by(read_attackers(attackers))
        .filter("kind = 'prefix'")
        .groupBy(F.col("value").alias("prefix"))
        .agg(F.count(F.lit(1)).alias("attackers"))
    )
    return (
        alerts.filter(is_subnet(ip))
        .select(ip.alias("subnet"), covered_prefix(ip).alias("prefix"))
        .join(inside, "prefix", "left")
        .selectExpr(
            "subnet", "prefix", "coalesce(attackers, 0L) as attackers", "attackers is not null as covered"
        )
    )


def _found(reported: DataFrame, listed: DataFrame) -> DataFrame:
    """The attackers that were reported, with ``direct`` and ``in_subnet``."""
    named = _named_by(listed)
    hits = _hits(reported, named).select(*KEY)
    return named.join(hits, KEY).groupBy("ip").agg(
        F.expr("count_if(kind = 'address') > 0 as direct"), F.expr("count_if(kind = 'prefix') > 0 as in_subnet")
    )


def attacker_status(alerts: DataFrame, attackers: DataFrame) -> DataFrame:
    """Each attacker with ``direct`` (its address was reported) and ``in_subnet``
    (a reported subnet contains it)."""
    return status_of(reported_keys(alerts), attackers)


def status_of(reported: DataFrame, attackers: DataFrame) -> DataFrame:
    """``attacker_status`` by the ``reported_keys`` of the alerts."""
    listed = read_attackers(attackers)
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("direct", "in_subnet")]
    return listed.join(_found(reported, listed), "ip", "left").select("ip", *flags)


def missed_attackers(alerts: DataFrame, attackers: DataFrame) -> DataFrame:
    """Attackers that no alert names and no reported subnet contains."""
    return attacker_status(alerts, attackers).filter("not direct and not in_subnet").select("ip")


def detection_metrics(alerts: DataFrame, attackers: DataFrame) -> DataFrame:
    """One row of seven numbers.

    ``true_positives`` adds attackers named by an alert and subnet alerts that contain
    any attacker, so it can exceed the number of attackers. Without a count of true
    negatives the false-positive rate is 1 as soon as there is a false positive.
    Ratios are rounded half-even to four places; an empty denominator gives 0.
    """
    return metrics_of(reported_keys(alerts), attackers)


def metrics_of(reported: DataFrame, attackers: DataFrame) -> DataFrame:
    """``detection_metrics`` by the ``reported_keys`` of the alerts, best stored: they are read three times."""
    listed = read_attackers(attackers)
    named = _named_by(listed)
    hits = _hits(reported, named)
    # an address counts once, a subnet as often as it was reported
    weight = "sum(if(kind = 'address', 1L, reports))"
    numbers = [
        hits.selectExpr(f"{weight} as tp", "0L as raised", "0L as known", "0L as found"),
        reported.selectExpr("0L as tp", f"{weight} as raised", "0L as known", "0L as found"),
        listed.selectExpr("0L as tp", "0L as raised", "count(*) as known", "0L as found"),
        named.join(hits.select(*KEY), KEY, "left_semi").select("ip").distinct()
        .selectExpr("0L as tp", "0L as raised", "0L as known", "count(*) as found"),
    ]
    every = numbers[0]
    for part in numbers[1:]:
        every = every.unionByName(part)
    counts = every.agg(*[F.expr(f"coalesce(sum({c}), 0L) as {c}") for c in ("tp", "raised", "known", "found")])
    return (
        counts.selectExpr("tp", "raised - tp as fp", "known - found as fn")
        .selectExpr("*", f"{_ratio('tp', 'tp + fp')} as p", f"{_ratio('tp', 'tp + fn')} as r")
        .selectExpr(
            "tp as true_positives",
            "fp as false_positives",
            "fn as false_negatives",
            "bround(p, 4) as precision",
            "bround(r, 4) as recall",
            f"bround({_ratio('2 * p * r', 'p + r')}, 4) as f1_score",
            f"{_ratio('fp', 'fp')} as false_positive_rate",
        )
    )


def _ratio(part: str, whole: str) -> str:
    return f"if({whole} > 0, ({part}) / ({whole}), 0D)"


def metric_percentages(metrics: DataFrame) -> DataFrame:
    """Precision, recall and F1 as percentages; a missing number counts as 0."""
    names = ["precision", "recall", "f1_score"]
    known = {n: n if n in metrics.columns else "null" for n in names}
    pairs = ", ".join(f"'{n}', coalesce({known[n]}, 0D) * 100" for n in names)
    return metrics.selectExpr(f"stack({len(names)}, {pairs}) as (metric, percentage)")
