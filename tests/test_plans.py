"""The shape of the plans, which decides how they scale."""

import os

import pytest

from pyspark.sql import DataFrameWriter

from knockwatch.operators.alerts import all_alerts
from knockwatch.operators.attempts import parse_attempts
from knockwatch.operators.baseline import global_baseline
from knockwatch.operators.failures import Failures, failures_by_second
from knockwatch.operators.rules import distributed_attack, off_hours, static_threshold
from knockwatch.operators.scoring import detection_metrics, missed_attackers
from knockwatch.plans.catalog import QUERIES
from knockwatch.plans.detect import detect
from knockwatch.plans.restart import keep_in, stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def whole_paths(spark):
    """Plans name the folders they read in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in text


@pytest.fixture
def table(attempts, tmp_path):
    return stored(attempts([(i, "a", f"u{i}") for i in range(9)]), str(tmp_path / "attempts"))


def test_status_filter_reaches_the_files(table):
    text = plan(off_hours(table))
    assert "EqualTo(status,failed)" in text
    assert "ReadSchema: struct<timestamp:timestamp_ntz,ip:string,status:string>" in text


@pytest.fixture
def failures(table, tmp_path):
    return Failures(table, keep_in(str(tmp_path / "counts")))


def test_windows_are_partitioned_by_slice(table, failures):
    assert "partial_count" in plan(failures_by_second(table))  # counted before the first shuffle
    text = plan(static_threshold(failures))
    main = text[: text.index("Subquery")] if "Subquery" in text else text
    assert main.count("Exchange hashpartitioning(ip") == 2
    assert "_slice" in main.split("Window")[1]


def test_the_line_expression_stands_once_in_the_parse(spark):
    lines = spark.sql("select id, concat('made ', cast(id as string)) as line from range(9)")
    assert plan(parse_attempts(lines, 2026)).count("made ") == 1
    assert "Filter" not in plan(parse_attempts(lines, 2026))


def test_lists_are_made_of_groups_that_fire(failures):
    text = plan(distributed_attack(failures))
    assert text.index("collect_list") < text.index("Join") < text.index(">= 3)")
    assert "collect" not in text[text.index(">= 3)") :]


def test_counts_are_shuffled_once_for_all_alerts(failures, tmp_path):
    """Counting by time and by username is over when the alerts are planned: both tables come from files."""
    text = plan(all_alerts(failures, global_baseline(failures)))
    shuffles = [part.split("]")[0] for part in text.split("Exchange hashpartitioning(")[1:]]
    assert not any("ip#" in s and ("timestamp#" in s or "username#" in s) for s in shuffles)
    assert f"{tmp_path}/attempts" not in text
    assert text.count(f"{tmp_path}/counts/seconds") == 1


def executed_plans(monkeypatch):
    """The plan of every table that is written, as Spark has run it."""
    plans = []

    def noted(write):
        def run(self, *args, **options):
            done = write(self, *args, **options)
            plans.append(plan(self._df))
            return done

        return run

    for name in ("parquet", "json", "csv", "text"):
        monkeypatch.setattr(DataFrameWriter, name, noted(getattr(DataFrameWriter, name)))
    return plans


def test_the_job_reads_text_once_and_attempts_twice(spark, tmp_path, monkeypatch):
    lines = [f"Mar  3 04:{m:02d}:{s:02d} gate sshd[5]: Invalid user n{s} from 45.0.0.{m}" for m in range(5) for s in range(9)]
    (tmp_path / "auth.log").write_text("\n".join(lines + ["junk", ""]))
    known = spark.createDataFrame([("45.0.0.1",), ("45.0.0.9",)], "ip string")
    plans = executed_plans(monkeypatch)
    detect(spark, str(tmp_path / "auth.log"), str(tmp_path / "out"), known, 2026, summaries=True, work=str(tmp_path / "work"))
    everything = "\n".join(plans)
    assert everything.count("FileScan text") == 1
    reads = [text for text in everything.split("FileScan parquet")[1:] if "/attempts]" in text.split("PushedFilters")[0]]
    assert len(reads) == 2
    assert everything.count("regexp_replace(") >= 3  # the parse itself is among the plans


def reported_by_hand(alerts, attackers):
    subnets = {a.split("/")[0].removesuffix(".0") + "." for a in alerts if "/" in a}
    return {a for a in attackers if a in alerts or any(a.startswith(s) for s in subnets)}


def test_attackers_under_one_octet_do_not_meet(spark):
    """Only keys move, and of attackers only those that were reported."""
    attackers = [f"45.{i % 7}.{i // 256 % 256}.{i % 256}" for i in range(6000)]
    alerts = [f"45.3.{n}.0/24" for n in range(6)] + attackers[:40] + ["46.1.1.1", "47.0.0.0/24"]
    given = spark.createDataFrame([(a,) for a in alerts], "ip string"), spark.createDataFrame([(a,) for a in attackers], "ip string")
    missed = missed_attackers(*given)
    expected = set(attackers) - reported_by_hand(alerts, attackers)
    assert {r.ip for r in missed.collect()} == expected
    metrics = detection_metrics(*given)
    assert metrics.first().false_negatives == len(expected)
    text = plan(metrics)
    assert "LeftSemi" in text
    keyed = [part for part in text.split("Exchange hashpartitioning(kind")[1:]]
    # what is shuffled by key was counted by key before
    assert keyed and all("partial" in part.split("\n")[1] or "HashAggregate(keys=[kind" in part for part in keyed)
