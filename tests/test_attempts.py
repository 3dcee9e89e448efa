from datetime import datetime

import pytest
from pyspark.sql import Observation

from knockwatch.operators.attempts import (
    count_outcomes,
    normalize_attempts,
    observed_counts,
    parse_attempts,
    parse_outcomes,
    rejected_lines,
)
from knockwatch.plans.restart import stored
from knockwatch.sources import read_lines


def parse(spark, *lines, year=2026):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return [tuple(r) for r in parse_attempts(df, year).collect()]


def line(ts="Jan 12 14:30:00", text="Failed password for root from 1.2.3.4 port 22 ssh2"):
    return f"{ts} web1 sshd[77]: {text}"


# Message and the attempt it gives (username, address, status); None: rejected.
MESSAGES = [
    ("Connection closed by 100.64.3.7 port 40122", None),
    ("Failed password for invalid user Deploy from 100.64.8.1 port 31007 ssh2", ("Deploy", "100.64.8.1", "failed")),
    ("Accepted password for mara from 172.20.0.3 port 50999 ssh2", ("mara", "172.20.0.3", "success")),
    ("Failed password for", None),
    ("Invalid user ghost from 100.64.8.2", ("ghost", "100.64.8.2", "failed")),
    ("Failed password for backup from 192.168.77.40 port 60001 ssh2", ("backup", "192.168.77.40", "failed")),
    ("Accepted password for", None),
]


@pytest.mark.parametrize("order", [1, 3, 5])
def test_file_of_messages(spark, tmp_path, order):
    """Every message some times over, in an order of its own, with blank lines between."""
    log, expected, rejected = tmp_path / "secure.log", [], []
    with log.open("w") as f:
        for i in range(4 * len(MESSAGES)):
            text, outcome = MESSAGES[i * order % len(MESSAGES)]
            stamp = datetime(2026, 6, 1 + i % 28, (i * 5) % 24, (i * 17) % 60, (i * 41) % 60)
            written = line(f"{stamp:%b %d %H:%M:%S}", text)
            f.write(written + "\n" + "\n \t \n"[: i % 5])
            expected += [(stamp, *outcome)] if outcome else []
            rejected += [] if outcome else [written]
    lines = read_lines(spark, str(log))
    assert sorted(tuple(r) for r in parse_attempts(lines, 2026).collect()) == sorted(expected)
    counts = count_outcomes(parse_outcomes(lines, 2026)).first()
    assert tuple(counts) == (4 * len(MESSAGES), len(expected), len(rejected))
    assert sorted(r.line for r in rejected_lines(lines, 2026).collect()) == sorted(rejected)


@pytest.mark.parametrize(
    "ts, expected",
    [
        ("Jan 12 14:30:00", datetime(2026, 1, 12, 14, 30)),
        ("Jan  5 14:30:00", datetime(2026, 1, 5, 14, 30)),
        ("feb 05 00:00:59", datetime(2026, 2, 5, 0, 0, 59)),
        ("DEC 31 23:59:59", datetime(2026, 12, 31, 23, 59, 59)),
        ("Feb 29 10:00:00", None),
        ("Jan 32 10:00:00", None),
        ("Jan 012 10:00:00", None),
        ("Jan 0 10:00:00", None),
        ("Foo 12 10:00:00", None),
        ("anf 12 10:00:00", None),
        ("Jan 12 24:00:00", None),
        ("Jan 12 10:60:00", None),
        ("Jan 12 10:00:60", None),
        ("not a timestamp", None),
    ],
)
def test_times(spark, ts, expected):
    rows = parse(spark, line(ts))
    assert [r[0] for r in rows] == ([expected] if expected else [])


def test_leap_day_needs_a_leap_year(spark):
    assert parse(spark, line("Feb 29 10:00:00"), year=2024)[0][0] == datetime(2024, 2, 29, 10)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Failed password for root from 1.2.3.4 port 22 ssh2", ("root", "1.2.3.4", "failed")),
        ("Failed password for invalid user a$b\\c from 1.2.3.4 port 22", ("a$b\\c", "1.2.3.4", "failed")),
        ("Failed password for invalid user from 1.2.3.4 port 22", None),
        ("Failed password for root from 1.2.3.4", None),
        ("Failed password for root from host port 22", None),
        ("Failed password for x from 1.2.3 port 22 Invalid user x from 1.2.3.4", None),
        ("Invalid user x from 1.2.3.4 Accepted password", None),
        ("Invalid user x from 999.2.3.4567", ("x", "999.2.3.456", "failed")),
        ("Invalid user  from 1.2.3.4", None),
        ("Accepted publickey for x from 1.2.3.4 port 22", None),
        ("Accepted password for x from 1.2.3.4 port 22   tail", ("x", "1.2.3.4", "success")),
    ],
)
def test_messages(spark, text, expected):
    rows = parse(spark, line(text=text))
    assert [r[1:] for r in rows] == ([expected] if expected else [])


def test_lines_are_stripped_and_bad_bytes_dropped(spark, tmp_path):
    log = tmp_path / "auth.log"
    log.write_bytes(
        b"\t " + line().encode() + b" \r\n" + line(text="Invalid user r\xffoot from 1.2.3.4").encode("latin-1") + b"\n"
    )
    assert sorted(r.username for r in parse_attempts(read_lines(spark, str(log)), 2026).collect()) == ["root", "root"]


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([(7, line()), (8, "junk")], "id int, line string")
    assert [r.id for r in parse_attempts(df, 2026).collect()] == [7]
    assert [r.id for r in rejected_lines(df, 2026).collect()] == [8]


def test_each_pattern_stands_once_in_the_plan(spark):
    df = spark.createDataFrame([(line(),)], "line string")
    plan = parse_attempts(df, 2026)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(") == 3


def test_counts_are_observed_by_the_pass_that_stores(spark, tmp_path):
    """The same counts as by a pass of their own, also without lines, also over several tasks."""
    texts = [line(text=text) for text, _ in MESSAGES] * 50 + ["", " \t", "junk"] * 20
    for given in (texts, []):
        lines = spark.createDataFrame([(t,) for t in given], "line string").repartition(7)
        counts = Observation()
        kept = stored(parse_attempts(lines, 2026, counts=counts), str(tmp_path / f"kept{len(given)}"))
        expected = count_outcomes(parse_outcomes(lines, 2026)).first()
        assert observed_counts(spark, counts).first() == expected
        assert kept.count() == expected.attempts and kept.columns == ["timestamp", "username", "ip", "status"]


def test_blank_lines_are_no_outcome(spark):
    df = spark.createDataFrame([(1, ""), (2, " \t\x0b "), (3, "\u2003"), (4, "x"), (5, None)], "id int, line string")
    assert [r.id for r in parse_outcomes(df, 2026).collect()] == [4]
    assert [r.id for r in rejected_lines(df, 2026).collect()] == [4]


def test_normalize(attempts):
    df = attempts([(0, " 1.2.3.4\t", "\xa0ALICE  "), (1, None, None), (2, "1.1.1.1", "bob", "success")])
    rows = {(r.ip, r.username, r.status) for r in normalize_attempts(df).collect()}
    assert rows == {("1.2.3.4", "alice", "failed"), ("", "", "failed"), ("1.1.1.1", "bob", "success")}
