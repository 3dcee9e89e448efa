"""The whole job: log files in, alerts, metrics and report tables out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession

from knockwatch.operators.alerts import all_alerts
from knockwatch.operators.attempts import normalize_attempts, observed_counts, parse_attempts
from knockwatch.operators.baseline import global_baseline
from knockwatch.operators.failures import Failures
from knockwatch.operators.rules import ip_profile
from knockwatch.operators.scoring import metric_percentages, metrics_of, reported_keys
from knockwatch.operators.summaries import (
    external_subnets,
    failure_timeline,
    report_totals,
    rule_breakdown,
    rule_share,
    static_vs_adaptive,
    top_failing_ips,
)
from knockwatch.plans.restart import keep_in, work_folder
from knockwatch.settings import RuleSettings
from knockwatch.sources.readers import read_lines
from knockwatch.sources.writers import iso_times, write_alerts_csv, write_alerts_json, write_metrics_json


def detect(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    attackers: DataFrame | None = None,
    year: int | None = None,
    summaries: bool = False,
    mode: str = "errorifexists",
    work: str | None = None,
    **settings,
) -> None:
    """Read the logs at ``paths`` and write folders below ``out``:

    ``alerts_json``, ``alerts_csv``, ``rule_breakdown``, ``report_totals``; with
    ``attackers`` also ``metrics``; with ``summaries`` the tables ``top_failing_ips``,
    ``failure_timeline``, ``rule_share``, ``static_vs_adaptive``, ``external_subnets``
    and (with attackers) ``metric_percentages``. ``settings`` are fields of
    ``RuleSettings``; the static/adaptive comparison always uses the defaults.

    The text is read once, and each reading task writes one file, whatever the order of
    the lines; that pass also counts accepted and rejected lines. The stored attempts are
    read twice, to count failures per second and per username (``Failures``); those counts,
    the profile of each address, the alerts and the reported keys are stored in turn, and
    all results start from them. They go to a new folder in ``work`` (default: the folder
    named by ``spark.checkpoint.dir``, or ``out`` where that is unset), which can be deleted later.
    """
    rules = replace(RuleSettings(), **settings)
    keep = keep_in(work_folder(spark, work, out))

    counts = Observation()
    attempts = keep(normalize_attempts(parse_attempts(read_lines(spark, paths), year, counts=counts)), "attempts")
    failures = Failures(attempts, keep)
    baseline = global_baseline(failures, rules)
    profile = keep(ip_profile(failures, rules), "profile")
    alerts = keep(all_alerts(failures, baseline, rules, profile), "alerts")

    def save(table: DataFrame, name: str) -> None:
        iso_times(table).write.mode(mode).json(f"{out}/{name}")

    write_alerts_json(alerts, f"{out}/alerts_json", mode)
    write_alerts_csv(alerts, f"{out}/alerts_csv", mode)
    save(rule_breakdown(alerts), "rule_breakdown")
    save(report_totals(observed_counts(spark, counts), alerts), "report_totals")
    if attackers is not None:
        metrics = keep(metrics_of(keep(reported_keys(alerts), "reported"), attackers), "metrics")
        write_metrics_json(metrics, f"{out}/metrics", mode)
    if summaries:
        save(top_failing_ips(failures), "top_failing_ips")
        save(failure_timeline(failures), "failure_timeline")
        save(rule_share(alerts), "rule_share")
        save(_default_comparison(failures, rules, baseline, profile), "static_vs_adaptive")
        save(external_subnets(failures), "external_subnets")
        if attackers is not None:
            save(metric_percentages(metrics), "metric_percentages")


def _default_comparison(failures: Failures, rules: RuleSettings, baseline: DataFrame, profile: DataFrame) -> DataFrame:
    """Static against adaptive by the defaults; the job's own profile and baseline serve where it runs by them."""
    if rules == RuleSettings():
        return static_vs_adaptive(failures, baseline, profile=profile)
    return static_vs_adaptive(failures, global_baseline(failures))
