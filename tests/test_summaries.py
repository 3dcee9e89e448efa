import random
from datetime import datetime, timedelta

from conftest import BASE

from knockwatch.operators.alerts import all_alerts
from knockwatch.operators.attempts import count_outcomes, normalize_attempts, parse_outcomes
from knockwatch.operators.baseline import baseline_by_ip, global_baseline, hourly_failures_by_ip
from knockwatch.operators.failures import Failures
from knockwatch.operators.rules import account_diversity, distributed_attack, ip_profile, off_hours, static_threshold
from knockwatch.operators.summaries import (
    external_subnets,
    failure_timeline,
    report_totals,
    static_vs_adaptive,
    top_failing_ips,
)
from knockwatch.plans.restart import keep_in


def test_timeline_has_no_gap_rows(attempts):
    rows = [(0, "a", "u"), (3599, "a", "u"), (7200, "b", "u"), (3600, "a", "u", "success")]
    got = [tuple(r) for r in failure_timeline(attempts(rows)).collect()]
    assert got == [(BASE, 2), (BASE + timedelta(hours=2), 1)]


def test_top_ten_and_ties(attempts):
    rows = [(100 - i, f"ip{i:02d}", "u") for i in range(12)] + [(200, "big", "u")] * 3
    got = [(r.ip, r.failures) for r in top_failing_ips(attempts(rows)).collect()]
    assert got == [("big", 3)] + [(f"ip{i:02d}", 1) for i in range(11, 2, -1)]
    tied = attempts([(5, "b", "u"), (5, "a", "u")])
    assert [r.ip for r in top_failing_ips(tied).collect()] == ["a", "b"]


def test_external_subnets(attempts):
    ips = ["10.0.0.1", "10.0.0.2", "172.16.0.1", "172.16.0.2", "172.31.9.1", "172.31.9.2", "192.168.1.1"]
    ips += ["192.168.1.2", "172.32.0.1", "172.32.0.2", "192.167.1.1", "192.167.1.2", "192.167.1.3", "8.8.8.8"]
    ips += ["fe80::1", "1.2.3", "8.8.8.8", "x.y.z.1", "x.y.z.2"]
    rows = [(i, ip, "u") for i, ip in enumerate(ips)] + [(1, "8.8.8.9", "u", "success")]
    got = [tuple(r) for r in external_subnets(attempts(rows)).collect()]
    assert got == [("192.167.1", 3), ("172.32.0", 2), ("x.y.z", 2)]


def test_static_vs_adaptive(attempts):
    df = attempts([(i, "a", "u") for i in range(9)] + [(i, "b", "u") for i in range(6)])
    got = {tuple(r) for r in static_vs_adaptive(df, global_baseline(df)).collect()}
    assert got == {("Static", 2), ("Adaptive", 1)}
    empty = attempts([])
    assert {tuple(r) for r in static_vs_adaptive(empty, global_baseline(empty)).collect()} == {
        ("Static", 0), ("Adaptive", 0),
    }


def test_report_totals(spark):
    line = "Jan 12 09:00:00 web1 sshd[7]: Failed password for root from 1.2.3.4 port 22 ssh2"
    lines = spark.createDataFrame([(line,), ("junk",), ("",), (line,)], "line string")
    alerts = spark.createDataFrame([("r", "x")] * 3, "rule string, ip string")
    got = report_totals(count_outcomes(parse_outcomes(lines, 2026)), alerts).first()
    assert got.asDict() == {"attempts": 2, "skipped": 1, "alerts": 3}
    none = report_totals(count_outcomes(parse_outcomes(lines.limit(0), 2026)), alerts.limit(0)).first()
    assert none.asDict() == {"attempts": 0, "skipped": 0, "alerts": 0}


def test_hours_are_zone_free_values(attempts):
    assert failure_timeline(attempts([(datetime(2026, 1, 1, 0, 30), "a", "u")])).first().hour == datetime(2026, 1, 1)


def test_counted_failures_give_the_same(attempts, tmp_path):
    """Every summary and rule from stored counts equals that from the attempts."""
    rng = random.Random(8)
    names = ["", "ann", "bob", "cy", None]
    rows = [(rng.randrange(200000), f"45.1.{rng.randrange(3)}.{rng.randrange(4)}", rng.choice(names), rng.choice(["failed", "success"])) for _ in range(900)]
    rows += [(5, None, "ann"), (6, "1.2", "ann"), (None, "45.1.1.1", "bob")]
    df = normalize_attempts(attempts(rows))
    kept = Failures(df, keep_in(str(tmp_path / "counts")))
    operators = [
        failure_timeline, top_failing_ips, external_subnets, hourly_failures_by_ip, global_baseline, baseline_by_ip,
        off_hours, static_threshold, account_diversity, distributed_attack,
        lambda source: static_vs_adaptive(source, global_baseline(source)),
        lambda source: all_alerts(source, global_baseline(source)),
    ]
    for operator in operators:
        assert sorted(map(repr, operator(df).collect())) == sorted(map(repr, operator(kept).collect()))
    profile = keep_in(str(tmp_path / "profile"))(ip_profile(kept), "profile")
    assert sorted(map(repr, all_alerts(kept, profile=profile).collect())) == sorted(map(repr, all_alerts(df).collect()))
