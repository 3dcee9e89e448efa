"""Plain SQL that states each query's result, for comparison on the same tables.

The bursts are stated row by row with a moving range, the subnet test as a prefix
comparison: other forms than the Spark operators use.
"""

from __future__ import annotations

from knockwatch.plans.event_views import ATTACKERS_SQL, ATTEMPTS_SQL, JOB_ATTACKERS, LINES_SQL, LOG_YEAR, UNTIDY_LINES_SQL, UNTIDY_SQL

# The line patterns, in the dialect of this check.
HEAD = r"^(\w{3}\s+\d+\s+\d{2}:\d{2}:\d{2})\s+\S+\s+sshd\[\d+\]:\s+"
IP = r"(\d{1,3}(?:\.\d{1,3}){3})"
FAILED = HEAD + r"Failed password for(?:\s+invalid user)?\s+(\S+)\s+from\s+" + IP + r"\s+port\s+\d+"
ACCEPTED = HEAD + r"Accepted password for\s+(\S+)\s+from\s+" + IP + r"\s+port\s+\d+"
INVALID = HEAD + r"Invalid user\s+(\S+)\s+from\s+" + IP


def _extract(group: int) -> str:
    return f"""case when contains(line, 'Failed password') then regexp_extract(line, '{FAILED}', {group})
      when contains(line, 'Accepted password') then regexp_extract(line, '{ACCEPTED}', {group})
      when contains(line, 'Invalid user') then regexp_extract(line, '{INVALID}', {group}) else '' end"""


OUTCOMES = f"""
select event_id, line,
  try_strptime('{LOG_YEAR} ' || nullif({_extract(1)}, ''), '%Y %b %d %H:%M:%S') as timestamp,
  {_extract(2)} as username, {_extract(3)} as ip,
  case when contains(line, 'Failed password') or (contains(line, 'Invalid user') and not contains(line, 'Accepted password'))
    then 'failed' else 'success' end as status
from l where trim(line, E' \t') <> ''
"""
PARSED = "select event_id, timestamp, username, ip, status from outcomes where timestamp is not null"
NORMALIZED = "select event_id, timestamp, lower(trim(username)) as username, trim(ip) as ip, status from parsed"

FAILS = "select * from a where status = 'failed'"
NAMED = "select * from fails where username <> ''"
HOURLY = "select ip, date_trunc('hour', timestamp) as hour, count(*) as failures from fails group by all"
BASE = """
select count(*) as quiet_buckets, cast(median(failures) as double) as median,
  case when count(*) > 0 then greatest(3, cast(trunc(median(failures)) as integer) + 4) else 5 end as baseline
from hourly where failures <= 2
"""


def _burst(source: str, width: int) -> str:
    return f"""
select ip, failed_count, window_start, window_end from (
  select *, row_number() over (partition by ip order by failed_count desc, window_end) as place from (
    select ip, timestamp as window_end, count(*) over r as failed_count, min(timestamp) over r as window_start
    from {source}
    window r as (partition by ip order by timestamp range between interval {width} second preceding and current row)))
where place = 1
"""


STATIC = """
select 'static_threshold' as rule, ip, failed_count, window_start, window_end from burst60 where failed_count >= 5
"""
ADAPTIVE = """
select 'adaptive_threshold' as rule, ip, greatest(6, cast(trunc(baseline * 3 / 2.0) as integer)) as threshold_used,
  failed_count, window_start, window_end
from burst300, base where failed_count >= greatest(6, cast(trunc(baseline * 3 / 2.0) as integer))
"""
DIVERSITY = """
select 'account_diversity' as rule, ip, unique_usernames, failed_count, window_start, window_end
from burst600 join (select ip, count(distinct username) as unique_usernames from named group by ip) using (ip)
where unique_usernames >= 3
"""
OFF_HOURS = """
select 'off_hours' as rule, ip, count(*) as failed_count, min(timestamp) as first_seen, max(timestamp) as last_seen
from fails where hour(timestamp) < 8 or hour(timestamp) >= 20 group by ip having count(*) >= 3
"""
DISTRIBUTED = """
select 'distributed_attack' as rule, subnet || '.0/24' as ip,
  array_to_string(list_sort(list(distinct ip)), ',') as attacking_ips, username as target_username,
  count(*) as failed_count, min(timestamp) as window_start, max(timestamp) as window_end
from (select *, array_to_string(string_split(ip, '.')[1:3], '.') as subnet from named) group by subnet, username
having count(distinct ip) >= 3 and max(timestamp) - min(timestamp) <= interval 600 second
"""
ALERTS = """
select rule, ip, null::bigint as unique_usernames, null::varchar as attacking_ips, null::varchar as target_username,
  failed_count, null::integer as threshold_used, window_start, window_end,
  null::timestamp as first_seen, null::timestamp as last_seen from static
union all select rule, ip, null, null, null, failed_count, threshold_used, window_start, window_end, null, null from adaptive
union all select rule, ip, unique_usernames, null, null, failed_count, null, window_start, window_end, null, null from diversity
union all select rule, ip, null, null, null, failed_count, null, null, null, first_seen, last_seen from off_hours
union all select rule, ip, null, attacking_ips, target_username, failed_count, null, window_start, window_end, null, null
from (select *, row_number() over (partition by ip order by window_start, target_username) as place from distributed)
where place = 1
"""
DETAILS = """
select rule, ip, '{' ||
  coalesce('"unique_usernames":' || unique_usernames || ',', '') ||
  coalesce('"attacking_ips":["' || replace(attacking_ips, ',', '","') || '"],', '') ||
  coalesce('"target_username":"' || target_username || '",', '') ||
  '"failed_count":' || failed_count ||
  coalesce(',"threshold_used":' || threshold_used, '') ||
  coalesce(',"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S') || '"', '') ||
  coalesce(',"window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '"', '') ||
  coalesce(',"first_seen":"' || strftime(first_seen, '%Y-%m-%dT%H:%M:%S') || '"', '') ||
  coalesce(',"last_seen":"' || strftime(last_seen, '%Y-%m-%dT%H:%M:%S') || '"', '') || '}' as details
from alerts
"""
JSON_LINES = """
select rule, ip, '{"rule":"' || rule || '","ip":"' || ip || '",' || details[2:] as json from details
"""
METRICS_JSON = """
select '{"true_positives":' || true_positives || ',"false_positives":' || false_positives || ',"false_negatives":' || false_negatives
  || ',"precision":' || precision || ',"recall":' || recall || ',"f1_score":' || f1_score
  || ',"false_positive_rate":' || false_positive_rate || '}' as json
from metrics
"""
BREAKDOWN = "select rule, count(*) as alerts from alerts group by rule"
SHARE = "select rule, alerts, round_even(alerts * 100.0::double / sum(alerts) over (), 1) as share_percent from breakdown"

SUBNETS = r"""
select ip as subnet, regexp_replace(split_part(ip, '/', 1), '\.0$', '') as prefix from alerts where contains(ip, '/')
"""
COVERAGE = """
select subnet, prefix, count(t.ip) as attackers, count(t.ip) > 0 as covered
from subnets left join t on starts_with(t.ip, prefix || '.') group by subnet, prefix
"""
MISSED = """
select ip from t where ip not in (select ip from alerts)
  and not exists (select 1 from subnets where starts_with(t.ip, prefix || '.'))
"""
DETECTED = "select distinct ip from alerts where not contains(ip, '/')"
METRICS = """
select true_positives, false_positives, false_negatives, round_even(p, 4) as precision, round_even(r, 4) as recall,
  round_even(case when p + r > 0 then 2 * p * r / (p + r) else 0.0::double end, 4) as f1_score,
  case when false_positives > 0 then 1.0::double else 0.0::double end as false_positive_rate
from (
  select *,
    case when true_positives + false_positives > 0
      then true_positives::double / (true_positives + false_positives) else 0.0::double end as p,
    case when true_positives + false_negatives > 0
      then true_positives::double / (true_positives + false_negatives) else 0.0::double end as r
  from (
    select (select count(*) from detected where ip in (select ip from t))
        + (select count(*) from coverage where covered) as true_positives,
      (select count(*) from detected where ip not in (select ip from t))
        + (select count(*) from coverage where not covered) as false_positives,
      (select count(*) from missed) as false_negatives))
"""
PERCENTAGES = """
select 'precision' as metric, precision * 100 as percentage from metrics
union all select 'recall', recall * 100 from metrics
union all select 'f1_score', f1_score * 100 from metrics
"""
EXTERNAL = """
select subnet, count(distinct ip) as failing_ips
from (select ip, string_split(ip, '.') as parts, array_to_string(string_split(ip, '.')[1:3], '.') as subnet from fails)
where len(parts) = 4 and not (parts[1]::int = 10 or (parts[1]::int = 172 and parts[2]::int between 16 and 31)
  or (parts[1]::int = 192 and parts[2] = '168'))
group by subnet having count(distinct ip) >= 2
"""
CUSTOM_BASE = """
select ip, cast(ceil(sum(failures) / count(*)::double / 4) + 3 as integer) as baseline
from hourly where ip not like '10.%' group by ip
"""
CUSTOM_ADAPTIVE = """
select 'adaptive_threshold' as rule, ip, threshold_used, failed_count, window_start, window_end
from (select *, greatest(6, cast(trunc(coalesce(baseline, 5) * 3 / 2.0) as integer)) as threshold_used
      from burst300 left join custom using (ip))
where failed_count >= threshold_used
"""
TIDY = r"""
select event_id, timestamp, lower(trim(coalesce(username, ''), E' \t')) as username, trim(coalesce(ip, ''), E' \t') as ip, status from u
"""
UNTIDY_EXTERNAL = """
select subnet, count(distinct ip) as failing_ips
from (select ip, string_split(ip, '.') as parts, array_to_string(string_split(ip, '.')[1:3], '.') as subnet from a where status = 'failed')
where len(parts) = 4 and not (parts[1] = '10' or (parts[1] = '172' and try_cast(parts[2] as integer) between 16 and 31)
  or (parts[1] = '192' and parts[2] = '168'))
group by subnet having count(distinct ip) >= 2
"""
UNTIDY_DISTRIBUTED = """
select 'distributed_attack' as rule, subnet || '.0/24' as ip,
  array_to_string(list_sort(list(distinct ip)), ',') as attacking_ips, username as target_username,
  count(*) as failed_count, min(timestamp) as window_start, max(timestamp) as window_end
from (select *, case when len(string_split(ip, '.')) = 4 then array_to_string(string_split(ip, '.')[1:3], '.') else ip end as subnet
      from a where status = 'failed' and username <> '')
group by subnet, username having count(distinct ip) >= 3 and max(timestamp) - min(timestamp) <= interval 1 day
"""
VERSUS = """
select 'Static' as strategy, (select count(*) from static) as alerts
union all select 'Adaptive', (select count(*) from adaptive)
"""

ATTEMPTS_STEPS = [("a", ATTEMPTS_SQL)]
PARSE_STEPS = [("outcomes", OUTCOMES), ("parsed", PARSED)]
LOG_STEPS = [("l", LINES_SQL), *PARSE_STEPS]
# the patterns of this check are anchored: an untidy line is stripped first
UNTIDY_LOG_STEPS = [("untidy", UNTIDY_LINES_SQL), ("l", "select event_id, trim(line, E' \\t') as line from untidy"), *PARSE_STEPS]
UNTIDY_STEPS = [("u", UNTIDY_SQL), ("a", TIDY)]
FAIL_STEPS = [("fails", FAILS), ("named", NAMED), ("hourly", HOURLY), ("base", BASE)]
BURST_STEPS = [("burst60", _burst("fails", 60)), ("burst300", _burst("fails", 300)), ("burst600", _burst("named", 600))]
RULE_STEPS = FAIL_STEPS + BURST_STEPS + [
    ("static", STATIC),
    ("adaptive", ADAPTIVE),
    ("diversity", DIVERSITY),
    ("off_hours", OFF_HOURS),
    ("distributed", DISTRIBUTED),
    ("alerts", ALERTS),
    ("breakdown", BREAKDOWN),
]
SCORE_STEPS = [
    ("t", ATTACKERS_SQL),
    ("subnets", SUBNETS),
    ("coverage", COVERAGE),
    ("missed", MISSED),
    ("detected", DETECTED),
    ("metrics", METRICS),
]

JOB_STEPS = [*UNTIDY_LOG_STEPS, ("a", NORMALIZED), *RULE_STEPS]
JOB_SCORE_STEPS = [*JOB_STEPS, ("t", JOB_ATTACKERS), *SCORE_STEPS[1:]]


def _with(steps: list[tuple[str, str]], final: str) -> str:
    parts = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in steps)
    return f"with {parts}\n{final.strip()}"


def _attempts(final: str, steps: list[tuple[str, str]] = FAIL_STEPS) -> str:
    return _with(ATTEMPTS_STEPS + steps, final)


def _rules(final: str) -> str:
    return _attempts(final, RULE_STEPS)


def _scores(final: str) -> str:
    return _attempts(final, RULE_STEPS + SCORE_STEPS)


CHECKS: dict[str, str] = {
    "parse_attempts": _with(LOG_STEPS, "select * from parsed"),
    "parse_counts": _with(
        LOG_STEPS,
        "select count(*) as lines, count(timestamp) as attempts, count(*) - count(timestamp) as skipped from outcomes",
    ),
    "rejected_lines": _with(LOG_STEPS, "select event_id, line from outcomes where timestamp is null"),
    "normalize_attempts": _with(LOG_STEPS, NORMALIZED),
    "hourly_failures_by_ip": _attempts("select * from hourly"),
    "baseline": _attempts("select * from base"),
    "baseline_by_ip": _attempts("select distinct ip, baseline from fails, base"),
    "best_burst": _attempts(_burst("fails", 600)),
    "static_threshold": _rules("select * from static"),
    "adaptive_threshold": _rules("select * from adaptive"),
    "adaptive_custom_baseline": _attempts(CUSTOM_ADAPTIVE, RULE_STEPS + [("custom", CUSTOM_BASE)]),
    "account_diversity": _rules("select * from diversity"),
    "off_hours": _rules("select * from off_hours"),
    "distributed_attack": _rules("select * from distributed"),
    "all_alerts": _rules("select * from alerts"),
    "alert_details": _rules(DETAILS),
    "alerts_json_lines": _attempts(JSON_LINES, RULE_STEPS + [("details", DETAILS)]),
    "metrics_json_lines": _scores(METRICS_JSON),
    "rule_breakdown": _rules("select * from breakdown"),
    "rule_share": _rules(SHARE),
    "detection_metrics": _scores("select * from metrics"),
    "metric_percentages": _scores(PERCENTAGES),
    "subnet_coverage": _scores("select * from coverage"),
    "missed_attackers": _scores("select * from missed"),
    "failure_timeline": _attempts(
        "select date_trunc('hour', timestamp) as hour, count(*) as failures from fails group by all order by hour"
    ),
    "top_failing_ips": _attempts(
        """select ip, count(*) as failures, min(timestamp) as first_seen from fails group by ip
        order by failures desc, first_seen, ip limit 10"""
    ),
    "static_vs_adaptive": _rules(VERSUS),
    "external_subnets": _attempts(EXTERNAL),
    "report_totals": _with(
        LOG_STEPS + [("a", NORMALIZED)] + RULE_STEPS,
        """select (select count(*) from parsed) as attempts,
        (select count(*) from outcomes where timestamp is null) as skipped, (select count(*) from alerts) as alerts""",
    ),
    "parse_untidy_lines": _with(UNTIDY_LOG_STEPS, "select * from parsed"),
    "count_untidy_lines": _with(
        UNTIDY_LOG_STEPS,
        "select count(*) as lines, count(timestamp) as attempts, count(*) - count(timestamp) as skipped from outcomes",
    ),
    "reject_untidy_lines": _with(UNTIDY_LOG_STEPS, "select event_id, line from outcomes where timestamp is null"),
    "normalize_untidy_attempts": _with(UNTIDY_STEPS, "select * from a"),
    "external_subnets_untidy": _with(UNTIDY_STEPS, UNTIDY_EXTERNAL),
    "distributed_attack_untidy": _with(UNTIDY_STEPS, UNTIDY_DISTRIBUTED),
    "scan_log_files": _with([("u", UNTIDY_LINES_SQL)], "select line from u"),
    "job_alerts_json": _with(JOB_STEPS, "select * from alerts"),
    "job_alerts_csv": _with([*JOB_STEPS, ("details", DETAILS)], "select rule, ip, details, true as written_now from details"),
    "job_metrics_json": _with(JOB_SCORE_STEPS, "select * from metrics"),
    "job_report_totals": _with(
        JOB_STEPS,
        """select (select count(*) from parsed) as attempts,
        (select count(*) from outcomes where timestamp is null) as skipped, (select count(*) from alerts) as alerts""",
    ),
}
