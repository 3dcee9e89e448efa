"""One named query per operator, over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from knockwatch.operators import rules, scoring, summaries
from knockwatch.operators.alerts import all_alerts
from knockwatch.operators.attempts import (
    count_outcomes,
    normalize_attempts,
    observed_counts,
    parse_attempts,
    parse_outcomes,
    rejected_lines,
)
from knockwatch.operators.baseline import baseline_by_ip, global_baseline, hourly_failures_by_ip
from knockwatch.operators.bursts import best_burst_of
from knockwatch.operators.failures import Failures
from knockwatch.plans.detect import detect
from knockwatch.plans.event_views import (
    JOB_ATTACKERS,
    LOG_YEAR,
    attackers_view,
    attempts_view,
    lines_view,
    untidy_attempts_view,
    untidy_lines_view,
)
from knockwatch.plans.restart import keep_in, work_folder
from knockwatch.schemas import ALERTS
from knockwatch.settings import RuleSettings
from knockwatch.sources.readers import read_lines
from knockwatch.sources.writers import alert_details, alerts_json_lines, metrics_json_lines

Query = Callable[[SparkSession, str], DataFrame]

#: The untidy attempts spread over hours: their subnet attacks need a longer span.
UNTIDY_RULES = RuleSettings(distributed_window=24 * 3600)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_attempts(lines_view(spark, sf_dir), LOG_YEAR)


def _failures(attempts: DataFrame) -> Failures:
    """Counted once and stored: the queries below that use them read them several times."""
    return Failures(attempts, keep_in(work_folder(attempts.sparkSession, None)))


def _alerts_of(attempts: DataFrame) -> DataFrame:
    failures = _failures(attempts)
    return all_alerts(failures, global_baseline(failures))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts_of(attempts_view(spark, sf_dir))


def _flat(alerts: DataFrame) -> DataFrame:
    """Address lists as text, so that results compare as plain values."""
    return alerts.withColumn("attacking_ips", F.array_join("attacking_ips", ","))


def _on_attempts(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(attempts_view(spark, sf_dir))


def _on_failures(operator: Callable[[Failures], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_failures(attempts_view(spark, sf_dir)))


def _on_untidy(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(untidy_attempts_view(spark, sf_dir))


def _on_untidy_lines(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(untidy_lines_view(spark, sf_dir))


def _on_alerts(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_alerts(spark, sf_dir))


def _scored(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_alerts(spark, sf_dir), attackers_view(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reported = keep_in(work_folder(spark, None))(scoring.reported_keys(_alerts(spark, sf_dir)), "reported")
    return scoring.metrics_of(reported, attackers_view(spark, sf_dir))


def _adaptive(failures: Failures) -> DataFrame:
    return rules.adaptive_threshold(failures, global_baseline(failures))


def _partial_baseline(failures: Failures) -> DataFrame:
    """A caller's own baseline: hourly average of failures, known for public addresses only."""
    hourly = hourly_failures_by_ip(failures).filter(~F.col("ip").startswith("10."))
    return hourly.groupBy("ip").agg(
        (F.ceil(F.sum("failures") / F.count(F.lit(1)) / 4) + 3).cast("int").alias("baseline")
    )


def _adaptive_custom(failures: Failures) -> DataFrame:
    return rules.adaptive_threshold(failures, _partial_baseline(failures))


def _report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = Observation()
    attempts = normalize_attempts(parse_attempts(lines_view(spark, sf_dir), LOG_YEAR, counts=counts)).drop("event_id")
    attempts = keep_in(work_folder(spark, None))(attempts, "attempts")
    return summaries.report_totals(observed_counts(spark, counts), _alerts_of(attempts))


def _log_files(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The untidy lines as log files; some of the files are compressed."""
    lines = untidy_lines_view(spark, sf_dir)
    lines.filter("event_id % 3 > 0").select("line").repartition(3).write.text(f"{folder}/logs/plain")
    lines.filter("event_id % 3 = 0").select("line").write.option("compression", "gzip").text(f"{folder}/logs/zipped")
    return f"{folder}/logs/*"


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(spark, _log_files(spark, sf_dir, work_folder(spark, None)))


def _job(spark: SparkSession, sf_dir: str) -> str:
    """Run the whole job over log files; the folder of its results."""
    folder = work_folder(spark, None)
    attackers = spark.sql(JOB_ATTACKERS)
    detect(spark, _log_files(spark, sf_dir, folder), f"{folder}/out", attackers, LOG_YEAR, work=folder)
    return f"{folder}/out"


def _job_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark.read.schema(ALERTS).json(f"{_job(spark, sf_dir)}/alerts_json"))


def _job_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV alerts, and whether the write time lies within this query."""
    before = spark.sql("select date_trunc('second', now())").first()[0]
    rows = spark.read.option("header", True).option("escape", '"').csv(f"{_job(spark, sf_dir)}/alerts_csv")
    written = F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    return rows.select("rule", "ip", "details", written.between(F.lit(before), F.now()).alias("written_now"))


def _job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = scoring.metrics_of(scoring.reported_keys(spark.createDataFrame([], ALERTS)), spark.sql(JOB_ATTACKERS)).schema
    return spark.read.schema(schema).json(f"{_job(spark, sf_dir)}/metrics")


def _job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("attempts long, skipped long, alerts long").json(f"{_job(spark, sf_dir)}/report_totals")


QUERIES: dict[str, Query] = {
    "parse_attempts": _parsed,
    "parse_counts": lambda spark, sf_dir: count_outcomes(parse_outcomes(lines_view(spark, sf_dir), LOG_YEAR)),
    "rejected_lines": lambda spark, sf_dir: rejected_lines(lines_view(spark, sf_dir), LOG_YEAR),
    "normalize_attempts": lambda spark, sf_dir: normalize_attempts(_parsed(spark, sf_dir)),
    "hourly_failures_by_ip": _on_attempts(hourly_failures_by_ip),
    "baseline": _on_attempts(global_baseline),
    "baseline_by_ip": _on_attempts(baseline_by_ip),
    "best_burst": _on_failures(lambda failures: best_burst_of(failures.seconds, failures.hours, seconds=600)),
    "static_threshold": _on_failures(rules.static_threshold),
    "adaptive_threshold": _on_failures(_adaptive),
    "adaptive_custom_baseline": _on_failures(_adaptive_custom),
    "account_diversity": _on_failures(rules.account_diversity),
    "off_hours": _on_attempts(rules.off_hours),
    "distributed_attack": _on_failures(lambda failures: _flat(rules.distributed_attack(failures))),
    "all_alerts": _on_alerts(_flat),
    "alert_details": _on_alerts(alert_details),
    "alerts_json_lines": _on_alerts(alerts_json_lines),
    "metrics_json_lines": lambda spark, sf_dir: metrics_json_lines(_metrics(spark, sf_dir)),
    "rule_breakdown": _on_alerts(summaries.rule_breakdown),
    "rule_share": _on_alerts(summaries.rule_share),
    "detection_metrics": _metrics,
    "metric_percentages": lambda spark, sf_dir: scoring.metric_percentages(_metrics(spark, sf_dir)),
    "subnet_coverage": _scored(scoring.subnet_coverage),
    "missed_attackers": _scored(scoring.missed_attackers),
    "failure_timeline": _on_attempts(summaries.failure_timeline),
    "top_failing_ips": _on_attempts(summaries.top_failing_ips),
    "static_vs_adaptive": _on_failures(
        lambda failures: summaries.static_vs_adaptive(failures, global_baseline(failures))
    ),
    "external_subnets": _on_attempts(summaries.external_subnets),
    "report_totals": _report_totals,
    "parse_untidy_lines": _on_untidy_lines(lambda lines: parse_attempts(lines, LOG_YEAR)),
    "count_untidy_lines": _on_untidy_lines(lambda lines: count_outcomes(parse_outcomes(lines, LOG_YEAR))),
    "reject_untidy_lines": _on_untidy_lines(lambda lines: rejected_lines(lines, LOG_YEAR)),
    "normalize_untidy_attempts": _on_untidy(normalize_attempts),
    "external_subnets_untidy": _on_untidy(lambda attempts: summaries.external_subnets(normalize_attempts(attempts))),
    "distributed_attack_untidy": _on_untidy(
        lambda attempts: _flat(rules.distributed_attack(_failures(normalize_attempts(attempts)), UNTIDY_RULES))
    ),
    "scan_log_files": _scanned,
    "job_alerts_json": _job_alerts,
    "job_alerts_csv": _job_csv,
    "job_metrics_json": _job_metrics,
    "job_report_totals": _job_totals,
}
