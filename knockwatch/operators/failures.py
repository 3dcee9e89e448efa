"""Failed attempts, counted once for every rule and summary.

``seconds`` has a row for each address and time, ``usernames`` one for each address and
username, ``hours`` rolls the first up by clock hour. Attempts are read for the first two
alone; everything else starts from these tables, which are far smaller: a flood of any rate
is one row a second, and a day of an address 24 rows of ``hours``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.functions.times import clock_hour
from knockwatch.operators.attempts import failed_attempts


def failures_by_second(attempts: DataFrame) -> DataFrame:
    """Failures per address and time: ``n``, and ``named`` with a username."""
    return (
        failed_attempts(attempts)
        .groupBy("ip", "timestamp")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("username") != "").alias("named"))
    )


def failures_by_username(attempts: DataFrame) -> DataFrame:
    """Failures per address and (non-empty) username: ``n``, ``first``, ``last``."""
    return (
        failed_attempts(attempts)
        .filter("username <> ''")
        .groupBy("ip", "username")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("timestamp").alias("first"),
            F.max("timestamp").alias("last"),
        )
    )


def failures_by_hour(seconds: DataFrame) -> DataFrame:
    """``failures_by_second`` per address and clock hour: ``failures``, ``times`` (rows rolled up), ``first``, ``last``."""
    return seconds.groupBy("ip", clock_hour("timestamp").alias("hour")).agg(
        F.sum("n").alias("failures"),
        F.count(F.lit(1)).alias("times"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


class Failures:
    """The three tables of some attempts, each computed when it is first asked for.

    ``keep`` is given a table and its name and returns the table to go on from, such as one
    stored and read again; without it the tables are plans that every use computes anew.
    """

    def __init__(self, attempts: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None):
        self._attempts = attempts
        self._keep = keep or (lambda table, name: table)

    @classmethod
    def of(cls, source: DataFrame | Failures) -> Failures:
        return source if isinstance(source, Failures) else cls(source)

    @cached_property
    def seconds(self) -> DataFrame:
        return self._keep(failures_by_second(self._attempts), "seconds")

    @cached_property
    def usernames(self) -> DataFrame:
        return self._keep(failures_by_username(self._attempts), "usernames")

    @cached_property
    def hours(self) -> DataFrame:
        return self._keep(failures_by_hour(self.seconds), "hours")


#: What the rules and summaries read: attempts, or failures counted before.
Source = DataFrame | Failures


def hourly_rows(source: Source) -> DataFrame:
    """Rows that stand for ``failures`` failures of ``ip`` in an ``hour``, from ``first`` to ``last``: the roll-up,
    or each failed attempt by itself where nothing was counted before."""
    if isinstance(source, Failures):
        return source.hours
    time = F.col("timestamp")
    return failed_attempts(source).select(
        "ip", clock_hour("timestamp").alias("hour"), F.lit(1).cast("long").alias("failures"), time.alias("first"), time.alias("last")
    )
