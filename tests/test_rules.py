from datetime import datetime, timedelta

import pytest
from conftest import BASE

from knockwatch.operators.alerts import all_alerts, keep_first, ordered
from knockwatch.operators.baseline import baseline_by_ip, global_baseline, hourly_failures_by_ip
from knockwatch.operators.rules import (
    account_diversity,
    adaptive_threshold,
    distributed_attack,
    off_hours,
    static_threshold,
)
from knockwatch.schemas import ALERTS
from knockwatch.settings import RuleSettings


def burst(n, step=3, ip="1.1.1.1", user="root", status="failed", start=0):
    return [(start + i * step, ip, user, status) for i in range(n)]


def ips(df):
    return sorted(r.ip for r in df.collect())


def largest(times, seconds):
    """Most times within a trailing range of so many seconds."""
    return max((sum(t - seconds <= u <= t for u in times) for t in times), default=0)


@pytest.mark.parametrize("extra", [-1, 0, 1])
@pytest.mark.parametrize("late", [0, 1])
def test_burst_rules_at_their_boundaries(spark, attempts, extra, late):
    """Threshold -1, 0, +1; the last attempt at the end of the window or one second after it."""
    s = RuleSettings()
    limits = {"static": (s.static_threshold, s.static_window), "adaptive": (9, s.adaptive_window)}
    for rule, (least, window) in limits.items():
        times = [i * 2 for i in range(least + extra - 1)] + [window + late]
        df = attempts([(t, "100.64.0.1", "kim") for t in times] + [(t, "100.64.0.2", "kim", "success") for t in times])
        if rule == "static":
            found = static_threshold(df).collect()
        else:
            table = spark.createDataFrame([("100.64.0.1", 6)], "ip string, baseline int")
            found = adaptive_threshold(df, table).collect()
        best = largest(times, window)
        assert [(r.ip, r.failed_count) for r in found] == ([("100.64.0.1", best)] if best >= least else [])


def test_repeated_and_null_baselines_give_one_alert(spark, attempts):
    df = attempts(burst(9, 2, ip="100.64.0.1") + burst(9, 2, ip=None))
    rows = [("100.64.0.1", 4), ("100.64.0.1", 6), ("100.64.0.1", None), (None, 5), ("", 4), ("100.64.0.9", None)]
    table = spark.createDataFrame(rows, "ip string, baseline int")
    alerts = [(r.rule, r.ip) for r in all_alerts(df, table).collect()]
    assert len(set(alerts)) == len(alerts)
    limits = {r.ip: r.threshold_used for r in adaptive_threshold(df, table).collect()}
    assert limits == {"100.64.0.1": 9, "": 7}


def test_a_missing_address_counts_in_every_rule(attempts):
    rows = [(datetime(2026, 1, 12, 22, 0, i), None, f"name{i}") for i in range(9)]
    found = all_alerts(attempts(rows)).collect()
    assert {(r.rule, r.ip) for r in found} == {
        (rule, "") for rule in ("static_threshold", "adaptive_threshold", "account_diversity", "off_hours")
    }


def test_adaptive_baseline_kinds(spark, attempts):
    df = attempts(burst(9, ip="a") + burst(9, ip="b"))
    table = spark.createDataFrame([("a", 20)], "ip string, baseline int")
    assert ips(adaptive_threshold(df, table)) == ["b"]
    assert ips(adaptive_threshold(df)) == ["a", "b"]
    one = spark.createDataFrame([(7,)], "baseline int")
    assert ips(adaptive_threshold(df, one)) == []
    assert ips(adaptive_threshold(df, one, RuleSettings(adaptive_multiplier=2))) == ["a", "b"]
    low = spark.createDataFrame([(1,)], "baseline int")
    assert {r.threshold_used for r in adaptive_threshold(df, low).collect()} == {6}


@pytest.mark.parametrize("names", range(1, 6))
def test_diversity_needs_so_many_names(attempts, names):
    rows = [(i * 11, "100.64.0.1", f"name{i % names}") for i in range(7)]
    found = [(r.unique_usernames, r.failed_count) for r in account_diversity(attempts(rows)).collect()]
    assert found == ([(names, 7)] if names >= RuleSettings().account_diversity_min else [])


def test_diversity_counts_users_overall_but_failures_in_a_burst(attempts):
    rows = [(i * 3600, "1.1.1.1", f"user{i}") for i in range(3)] + [(1, "1.1.1.1", "")]
    row = account_diversity(attempts(rows)).first()
    assert (row.unique_usernames, row.failed_count, row.window_start, row.window_end) == (3, 1, BASE, BASE)


@pytest.mark.parametrize("start, end", [(8, 20), (0, 24), (21, 6), (7, 7)])
def test_off_hours_of_every_hour(attempts, start, end):
    settings = RuleSettings(working_hours_start=start, working_hours_end=end)
    rows = [(datetime(2026, 5, 4, h, 13 * n, n), f"h{h}", "kim") for h in range(24) for n in range(1 + h % 4)]
    outside = {f"h{h}" for h in range(24) if (h < start or h >= end) and 1 + h % 4 >= settings.off_hours_min}
    found = off_hours(attempts(rows), settings).collect()
    assert {r.ip for r in found} == outside
    for r in found:
        times = [t for t, ip, _ in rows if ip == r.ip]
        assert (r.failed_count, r.first_seen, r.last_seen) == (len(times), min(times), max(times))


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_distributed_needs_so_many_addresses(attempts, size):
    """Of subnets with one name, with a name for each address, and without names, only the first can be reported."""
    last = [(7 * i) % 200 + 20 for i in range(size)]
    rows = [(i, f"100.64.1.{n}", "kim") for i, n in enumerate(last)]
    rows += [(i, f"100.64.2.{n}", f"name{n}") for i, n in enumerate(last)]
    rows += [(i, f"100.64.3.{n}", "") for i, n in enumerate(last)]
    rows += [(i, f"100.{n}.4.1", "kim") for i, n in enumerate(last)]
    found = distributed_attack(attempts(rows + rows[:1])).collect()
    if size < RuleSettings().distributed_min_ips:
        assert found == []
    else:
        (alert,) = found
        assert (alert.ip, alert.target_username, alert.failed_count) == ("100.64.1.0/24", "kim", size + 1)
        assert alert.attacking_ips == sorted(f"100.64.1.{n}" for n in last)


def test_distributed_span_covers_the_whole_input(attempts):
    rows = [(i, f"45.32.10.{i}", "root") for i in range(3)]
    assert ips(distributed_attack(attempts(rows + [(600, "45.32.10.1", "root")]))) == ["45.32.10.0/24"]
    assert ips(distributed_attack(attempts(rows + [(601, "45.32.10.1", "root")]))) == []


def test_odd_addresses_stay_their_own_subnet(attempts):
    rows = [(i, f"fe80::{i}", "root") for i in range(3)]
    assert ips(distributed_attack(attempts(rows))) == []


def test_baseline_of_quiet_and_noisy(attempts):
    rows = [(datetime(2026, 1, 12, h), "1.1.1.1", "u") for h in range(3)]
    rows += [(datetime(2026, 1, 12, 5), "9.9.9.9", "u")] * 10
    df = attempts(rows)
    assert tuple(global_baseline(df).first()) == (3, 1.0, 5)
    assert {tuple(r) for r in baseline_by_ip(df).collect()} == {("1.1.1.1", 5), ("9.9.9.9", 5)}
    assert hourly_failures_by_ip(df).filter("failures = 10").first().hour == datetime(2026, 1, 12, 5)


def test_baseline_median_two_half_and_none(attempts):
    one = [(datetime(2026, 1, 12, 1), "a", "u")]
    two = [(datetime(2026, 1, 12, 2), "a", "u")] * 2
    assert tuple(global_baseline(attempts(two)).first()) == (1, 2.0, 6)
    assert tuple(global_baseline(attempts(one + two)).first()) == (2, 1.5, 5)
    assert tuple(global_baseline(attempts([])).first()) == (0, None, 5)
    assert baseline_by_ip(attempts([])).count() == 0


def test_hours_do_not_move_with_the_session_zone(spark, attempts):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = [datetime(2026, 3, 8, 2, m) for m in (10, 30, 50)]
        df = attempts([(t, "a", "u") for t in times])
        assert hourly_failures_by_ip(df).first().hour == datetime(2026, 3, 8, 2)
        row = off_hours(df).first()
        assert (row.first_seen, row.last_seen) == (times[0], times[2])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_all_alerts_equal_the_single_rules(attempts):
    rows = burst(12, ip="203.0.113.9") + burst(6, ip="10.0.0.9", start=5000)
    rows += [(i * 7, f"45.32.10.{i % 4}", f"u{i % 3}") for i in range(24)]
    rows += [(datetime(2026, 1, 12, 2, m), "7.7.7.7", f"n{m}") for m in range(0, 60, 15)]
    df = attempts(rows)
    base = global_baseline(df)
    alerts = all_alerts(df, base)
    assert alerts.columns == ALERTS.fieldNames()
    got = sorted((r.rule, r.ip, r.failed_count) for r in alerts.collect())
    single = [static_threshold(df), adaptive_threshold(df, base), account_diversity(df), off_hours(df)]
    single.append(keep_first(distributed_attack(df)))
    expected = sorted((r.rule, r.ip, r.failed_count) for rule in single for r in rule.collect())
    assert got == expected
    assert {r for r, _, _ in got} == {
        "static_threshold", "adaptive_threshold", "account_diversity", "off_hours", "distributed_attack",
    }
    assert len({(r, ip) for r, ip, _ in got}) == len(got)


def test_survivor_of_repeated_subnet_alerts(attempts):
    rows = [(10 + i, f"45.32.10.{i}", "zed") for i in range(3)]
    rows += [(20 + i, f"45.32.10.{i}", "bob") for i in range(3)] + [(20 + i, f"45.32.10.{i}", "amy") for i in range(3)]
    kept = all_alerts(attempts(rows)).filter("rule = 'distributed_attack'").collect()
    assert [(r.ip, r.target_username) for r in kept] == [("45.32.10.0/24", "zed")]
    tied = all_alerts(attempts(rows[3:])).filter("rule = 'distributed_attack'").collect()
    assert [r.target_username for r in tied] == ["amy"]


def test_ordered_listing(attempts):
    df = attempts(burst(6, ip="b", start=0) + burst(6, ip="a", start=100) + burst(12, ip="c", start=50))
    listing = [(r.rule, r.ip) for r in ordered(all_alerts(df)).collect()]
    assert listing == [
        ("static_threshold", "b"), ("static_threshold", "c"), ("static_threshold", "a"), ("adaptive_threshold", "c"),
    ]


def test_empty_input(attempts):
    empty = attempts([])
    alerts = all_alerts(empty, global_baseline(empty))
    assert alerts.count() == 0 and alerts.columns == ALERTS.fieldNames()
