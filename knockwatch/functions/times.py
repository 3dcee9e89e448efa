"""Zone-free time arithmetic on ``timestamp_ntz`` columns.

``date_trunc`` and ``unix_micros`` go through the session time zone, where a
local time inside a daylight-saving gap would move by an hour; the forms below
never leave wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def clock_hour(ts: str) -> Column:
    """Start of the clock hour."""
    return F.window(ts, "1 hour").start


def wall_micros(ts: str) -> Column:
    """Microseconds of wall-clock time since 1970-01-01, as a long."""
    return F.expr(
        f"(unix_date(date({ts})) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60) * {MICROS}"
        f" + bigint(date_part('SECOND', {ts}) * {MICROS})"
    )
