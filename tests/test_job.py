import csv
import glob
import json
from datetime import datetime, timedelta

import pytest

from knockwatch.operators.alerts import all_alerts
from knockwatch.plans.detect import detect
from knockwatch.plans.job import arguments, main
from knockwatch.sources import (
    alert_details,
    alerts_json_lines,
    metrics_json_lines,
    read_attackers,
    read_attackers_file,
    write_alerts_csv,
    write_alerts_json,
    write_metrics_json,
)


def objects(path):
    rows = []
    for part in glob.glob(f"{path}/part-*"):
        with open(part, encoding="utf-8") as f:
            rows += [json.loads(line) for line in f]
    return rows


def table(path):
    headers, rows = set(), []
    for part in glob.glob(f"{path}/part-*"):
        with open(part, newline="", encoding="utf-8") as f:
            header, *body = list(csv.reader(f))
            headers.add(tuple(header))
            rows += body
    return headers, rows


@pytest.fixture
def alerts(attempts):
    rows = [(i * 3, "1.1.1.1", 'o"dd,\\name') for i in range(6)]
    rows += [(i * 20, f"45.32.10.{i}", 'o"dd,\\name') for i in range(3)]
    rows += [(datetime(2026, 1, 12, 2, m), "7.7.7.7", "root") for m in (0, 20, 40)]
    return all_alerts(attempts(rows))


def test_sub_second_times_come_back(attempts, tmp_path):
    start = datetime(2026, 1, 12, 10, 0, 0, 250_000)
    times = [start + timedelta(milliseconds=10 * i) for i in range(9)]
    found = all_alerts(attempts([(t, "100.64.0.1", "kim") for t in times])).filter("rule = 'static_threshold'")
    write_alerts_json(found, str(tmp_path / "json"))
    write_alerts_csv(found, str(tmp_path / "csv"))
    (row,) = objects(tmp_path / "json")
    _, ((_, _, details, _),) = table(tmp_path / "csv")
    for written in (row, json.loads(details)):
        assert (written["window_start"], written["window_end"]) == (times[0].isoformat(), times[-1].isoformat())


def test_json_keys_per_rule(alerts, tmp_path):
    write_alerts_json(alerts, str(tmp_path / "out"))
    rows = {r["rule"]: r for r in objects(tmp_path / "out")}
    assert rows["static_threshold"] == {
        "rule": "static_threshold",
        "ip": "1.1.1.1",
        "failed_count": 6,
        "window_start": "2026-01-12T10:00:00",
        "window_end": "2026-01-12T10:00:15",
    }
    assert list(rows["off_hours"]) == ["rule", "ip", "failed_count", "first_seen", "last_seen"]
    assert list(rows["distributed_attack"]) == [
        "rule", "ip", "attacking_ips", "target_username", "failed_count", "window_start", "window_end",
    ]


def test_lines_are_what_the_writers_write(spark, alerts, tmp_path):
    write_alerts_json(alerts, str(tmp_path / "alerts"))
    shown = [json.loads(r.json) for r in alerts_json_lines(alerts).collect()]
    order = lambda rows: sorted(rows, key=lambda r: (r["rule"], r["ip"]))
    assert order(shown) == order(objects(tmp_path / "alerts"))
    again = spark.read.schema(alerts.schema).json(str(tmp_path / "alerts"))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, alerts.collect()))
    metrics = spark.sql("select 1 as true_positives, 0.5D as precision, cast(null as double) as recall")
    write_metrics_json(metrics, str(tmp_path / "metrics"))
    assert [json.loads(r.json) for r in metrics_json_lines(metrics).collect()] == objects(tmp_path / "metrics")
    write_alerts_json(alerts.limit(0), str(tmp_path / "none"))
    assert objects(tmp_path / "none") == []


def test_csv_round_trip(alerts, tmp_path):
    write_alerts_csv(alerts, str(tmp_path / "out"))
    headers, rows = table(tmp_path / "out")
    assert headers == {("rule", "ip", "details", "timestamp")}
    details = {rule: json.loads(text) for rule, _, text, _ in rows}
    assert details["distributed_attack"]["target_username"] == 'o"dd,\\name'
    assert details["distributed_attack"]["attacking_ips"] == [f"45.32.10.{i}" for i in range(3)]
    assert details["off_hours"] == {
        "failed_count": 3, "first_seen": "2026-01-12T02:00:00", "last_seen": "2026-01-12T02:40:00",
    }
    for *_, written in rows:
        assert datetime.fromisoformat(written).microsecond == 0
    assert alert_details(alerts).count() == len(rows)


def test_csv_without_alerts_has_its_header(alerts, tmp_path):
    write_alerts_csv(alerts.filter("rule = 'none'"), str(tmp_path / "out"))
    assert table(tmp_path / "out") == ({("rule", "ip", "details", "timestamp")}, [])


def test_metrics_json(spark, tmp_path):
    write_metrics_json(spark.sql("select 1 as true_positives, 0.5D as precision"), str(tmp_path / "out"))
    assert objects(tmp_path / "out") == [{"true_positives": 1, "precision": 0.5}]


def test_read_attackers(spark):
    df = spark.sql("select * from values ('1.1.1.1', 1), ('1.1.1.1', 2), (null, 3) as t(ip, n)")
    assert [r.ip for r in read_attackers(df).collect()] == ["1.1.1.1"]


def write_log(path, day):
    """Two files: a fast attack on many names by night, a subnet attack, one slip, noise."""
    path.mkdir()

    def line(ts, text):
        return f"{ts.strftime('%b %d %H:%M:%S')} web1 sshd[9]: {text}\n"

    night = datetime(2026, 1, day, 2)
    first = [
        line(night + timedelta(seconds=2 * i), f"Failed password for invalid user N{i} from 203.0.113.9 port 5 ssh2")
        for i in range(10)
    ]
    noon = datetime(2026, 1, day, 12)
    second = [
        line(noon + timedelta(seconds=i), f"Failed password for root from 45.32.10.{i} port 5 ssh2") for i in range(3)
    ]
    second += [line(noon, "Failed password for kim from 10.0.0.5 port 5 ssh2")]
    second += [line(noon, "Accepted password for kim from 10.0.0.5 port 5 ssh2")]
    second += [line(noon, "Accepted publickey for kim from 10.0.0.5 port 5 ssh2"), "\n", "junk\n"]
    (path / "a.log").write_text("".join(first))
    (path / "b.log").write_text("".join(second))


@pytest.mark.parametrize("own_folder", [True, False])
def test_detect(spark, tmp_path, shared, own_folder):
    write_log(tmp_path / "logs", 12)
    attackers = spark.createDataFrame([("203.0.113.9",), ("45.32.10.77",), ("6.6.6.6",)], "ip string")
    out = tmp_path / "out"
    work = tmp_path / "work" if own_folder else shared
    before = set(glob.glob(f"{work}/work-*/attempts/_SUCCESS"))
    detect(
        spark, str(tmp_path / "logs" / "*.log"), str(out), attackers, year=2026, summaries=True,
        work=str(work) if own_folder else None,
    )
    assert len(set(glob.glob(f"{work}/work-*/attempts/_SUCCESS")) - before) == 1

    got = sorted((r["rule"], r["ip"], r["failed_count"]) for r in objects(out / "alerts_json"))
    assert got == [
        ("account_diversity", "203.0.113.9", 10),
        ("adaptive_threshold", "203.0.113.9", 10),
        ("distributed_attack", "45.32.10.0/24", 3),
        ("off_hours", "203.0.113.9", 10),
        ("static_threshold", "203.0.113.9", 10),
    ]
    assert len(table(out / "alerts_csv")[1]) == 5
    assert objects(out / "report_totals") == [{"attempts": 15, "skipped": 2, "alerts": 5}]
    assert objects(out / "metrics") == [
        {
            "true_positives": 2, "false_positives": 0, "false_negatives": 1,
            "precision": 1.0, "recall": 0.6667, "f1_score": 0.8, "false_positive_rate": 0.0,
        }
    ]
    assert {r["rule"]: r["alerts"] for r in objects(out / "rule_breakdown")}["off_hours"] == 1
    assert objects(out / "failure_timeline") == [
        {"hour": "2026-01-12T02:00:00", "failures": 10}, {"hour": "2026-01-12T12:00:00", "failures": 4},
    ]
    assert objects(out / "top_failing_ips")[0]["ip"] == "203.0.113.9"
    assert {(r["strategy"], r["alerts"]) for r in objects(out / "static_vs_adaptive")} == {("Static", 1), ("Adaptive", 1)}
    assert objects(out / "external_subnets") == [{"subnet": "45.32.10", "failing_ips": 3}]
    assert len(objects(out / "rule_share")) == 5
    assert {r["metric"]: r["percentage"] for r in objects(out / "metric_percentages")}["f1_score"] == 80.0


def test_detect_settings_and_no_attackers(spark, tmp_path):
    write_log(tmp_path / "logs", 13)
    detect(spark, str(tmp_path / "logs"), str(tmp_path / "out"), year=2026, static_threshold=11, off_hours_min=11)
    rules = {r["rule"] for r in objects(tmp_path / "out" / "alerts_json")}
    assert rules == {"adaptive_threshold", "account_diversity", "distributed_attack"}
    assert not (tmp_path / "out" / "metrics").exists()


def test_detect_on_an_empty_log(spark, tmp_path):
    (tmp_path / "auth.log").write_text("")
    attackers = spark.createDataFrame([("1.1.1.1",)], "ip string")
    detect(spark, str(tmp_path / "auth.log"), str(tmp_path / "out"), attackers, year=2026, summaries=True)
    assert objects(tmp_path / "out" / "alerts_json") == []
    assert objects(tmp_path / "out" / "report_totals") == [{"attempts": 0, "skipped": 0, "alerts": 0}]
    assert objects(tmp_path / "out" / "metrics")[0]["false_negatives"] == 1


def test_unknown_setting_is_an_error(spark, tmp_path):
    with pytest.raises(TypeError):
        detect(spark, "x", str(tmp_path), statik_threshold=1)




def test_start_by_arguments(spark, tmp_path):
    given = arguments(["a.log", "b.log", "--out", "o", "--year", "2025", "--summaries"])
    assert (given.paths, given.out, given.year, given.summaries, given.attackers) == (["a.log", "b.log"], "o", 2025, True, None)
    with pytest.raises(SystemExit):
        arguments(["a.log"])
    text = "".join(f"Mar  3 04:00:{s:02d} gate sshd[5]: Invalid user n{s} from 100.64.0.1\n" for s in range(7))
    (tmp_path / "auth.log").write_text(text)
    (tmp_path / "known.txt").write_text(" 100.64.0.1 \n\n100.64.0.1\n")
    out = tmp_path / "out"
    main([str(tmp_path / "auth.log"), "--out", str(out), "--attackers", str(tmp_path / "known.txt"), "--year", "2026"])
    assert {r["ip"] for r in objects(out / "alerts_json")} == {"100.64.0.1"}
    assert [(m["true_positives"], m["false_negatives"]) for m in objects(out / "metrics")] == [(1, 0)]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_attackers_from_a_file(spark, tmp_path, kind):
    path = str(tmp_path / f"known.{kind}")
    rows = spark.createDataFrame([("100.64.0.1", 1), ("100.64.0.1", 2), ("100.64.0.2", 3)], "ip string, n int")
    rows.write.option("header", True).format(kind).save(path)
    assert sorted(r.ip for r in read_attackers_file(spark, path).collect()) == ["100.64.0.1", "100.64.0.2"]
