import random
from datetime import datetime, timedelta

import pytest
from conftest import BASE
from pyspark.sql import functions as F

from knockwatch.functions.times import wall_micros
from knockwatch.operators.bursts import Burst, best_burst, slice_micros, trailing_ranges
from knockwatch.operators.failures import Failures
from knockwatch.operators.rules import ip_profile
from knockwatch.settings import RuleSettings


def brute_force(times, width):
    """Largest number of times in [t - width, t] over all t, earliest t first."""
    best = None
    for end in sorted(set(times)):
        inside = [t for t in times if end - timedelta(seconds=width) <= t <= end]
        if best is None or len(inside) > best[0]:
            best = (len(inside), min(inside), end)
    return best


def run(attempts, rows, width, **options):
    df = best_burst(attempts(rows), seconds=width, **options)
    return {r.ip: (r.failed_count, r.window_start, r.window_end) for r in df.collect()}


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def test_both_ends_count(attempts):
    assert run(attempts, [(0, "a", ""), (60, "a", "")], 60) == {"a": (2, at(0), at(60))}
    assert run(attempts, [(0, "a", ""), (61, "a", "")], 60) == {"a": (1, at(0), at(0))}


def test_equal_times_and_first_maximum(attempts):
    rows = [(0, "a", ""), (0, "a", ""), (100, "a", ""), (100, "a", "")]
    assert run(attempts, rows, 60) == {"a": (2, at(0), at(0))}


def test_empty(attempts):
    assert run(attempts, [], 60) == {}


def test_range_across_midnight_and_slices(attempts):
    start = datetime(2026, 1, 12, 23, 59, 30)
    rows = [(start + timedelta(seconds=i * 10), "a", "") for i in range(7)]
    assert run(attempts, rows, 60) == {"a": (7, rows[0][0], rows[-1][0])}


@pytest.mark.parametrize("width, slice_seconds", [(60, 21600), (60, 50), (300, 90), (600, 600), (7, 1)])
def test_against_brute_force(attempts, width, slice_seconds):
    rng = random.Random(width * 1000 + slice_seconds)
    rows = []
    for ip, n, span in (("a", 200, 900), ("b", 60, 6000), ("c", 5, 10**6), ("d", 1, 1)):
        rows += [(rng.randrange(span), ip, "") for _ in range(n)]
    got = run(attempts, rows, width, slice_seconds=slice_seconds)
    for ip in "abcd":
        assert got[ip] == brute_force([at(s) for s, i, _ in rows if i == ip], width)


def test_sub_second_and_before_1970(attempts):
    rng = random.Random(5)
    for origin in (datetime(1969, 12, 31, 23, 58), datetime(2026, 3, 8, 1, 58)):
        times = [origin + timedelta(microseconds=rng.randrange(240 * 10**6)) for _ in range(80)]
        rows = [(t, "a", "") for t in times]
        assert run(attempts, rows, 60, slice_seconds=100) == {"a": brute_force(times, 60)}


@pytest.mark.parametrize("width", [7 * 86400, 30 * 86400])
def test_ranges_of_days(attempts, width):
    """Wider than a slice would be: slices grow with the range."""
    rng = random.Random(width)
    rows = [(rng.randrange(90 * 86400), ip, "") for ip in "abc" for _ in range(120)]
    got = run(attempts, rows, width)
    for ip in "abc":
        assert got[ip] == brute_force([at(s) for s, i, _ in rows if i == ip], width)


@pytest.mark.parametrize("slice_rows", [40, 1000])
def test_flood_of_sub_second_times(attempts, slice_rows):
    """Very many distinct times in a few seconds: slices get shorter, results stay."""
    rng = random.Random(slice_rows)
    times = [BASE + timedelta(microseconds=rng.randrange(20 * 10**6)) for _ in range(500)]
    times += [BASE + timedelta(seconds=rng.randrange(40000)) for _ in range(100)]
    assert run(attempts, [(t, "a", "") for t in times], 3, slice_rows=slice_rows) == {"a": brute_force(times, 3)}


@pytest.mark.parametrize("widest, slice_seconds, slice_rows", [(60, 21600, 1000), (60, 10, 1000), (60, 21600, 1), (7 * 86400, 21600, 1000)])
def test_a_row_has_two_copies_at_most(spark, attempts, widest, slice_seconds, slice_rows):
    df = attempts([(i * 7, "a", "") for i in range(400)])
    failures = Failures(df)
    size = slice_micros(failures.hours, widest, slice_seconds, slice_rows)
    shortest = failures.hours.select(size.alias("size")).first().size
    assert widest * 10**6 <= shortest <= max(widest, slice_seconds) * 10**6
    plan = trailing_ranges(failures.seconds, ["ip"], [Burst("b", "n", widest)], size)
    assert plan.count() == 400  # each row once in the end
    sliced = failures.seconds.select(F.explode(F.sequence(
        F.floor((wall_micros("timestamp") - widest * 10**6) / size), F.floor(wall_micros("timestamp") / size)
    )))
    assert sliced.count() <= 2 * 400


def test_a_measured_flood_shortens_slices(attempts):
    slow = Failures(attempts([(i, "a", "") for i in range(600)])).hours
    flood = Failures(attempts([(BASE + timedelta(milliseconds=i), "a", "") for i in range(600)])).hours
    for hours, rows in ((slow, 600), (flood, 600)):
        assert hours.first().times == rows
        assert hours.select(slice_micros(hours, 1, slice_rows=10).alias("s")).first().s == 60 * 10**6
    assert attempts([]).select(slice_micros(Failures(attempts([])).hours, 1).alias("s")).count() == 0


def test_other_keys(attempts):
    rows = [(0, "a", "x"), (10, "a", "y"), (20, "a", "y")]
    df = best_burst(attempts(rows), keys=("ip", "username"), seconds=60)
    assert {(r.ip, r.username, r.failed_count) for r in df.collect()} == {("a", "x", 1), ("a", "y", 2)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_session_time_zone_does_not_matter(spark, attempts, zone):
    """Wall-clock times inside a daylight-saving gap stay where they are."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [datetime(2026, 3, 8, 1, 59, 50) + timedelta(seconds=20 * i) for i in range(400)]
        rows = [(t, "a", "") for t in times]
        assert run(attempts, rows, 60, slice_seconds=600) == {"a": (4, times[0], times[3])}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_profile_counts_named_failures_apart(attempts):
    rng = random.Random(11)
    rows = [(rng.randrange(4000), "a", rng.choice(["", "", "x", "y"])) for _ in range(150)]
    settings = RuleSettings(static_window=30, adaptive_window=100, account_diversity_window=250)
    row = ip_profile(attempts(rows), settings).first()
    every = [at(s) for s, _, _ in rows]
    named = [at(s) for s, _, u in rows if u]
    for burst, times, width in ((row.static, every, 30), (row.adaptive, every, 100), (row.diversity, named, 250)):
        assert (-burst.negated, burst.window_start, burst.window_end) == brute_force(times, width)
