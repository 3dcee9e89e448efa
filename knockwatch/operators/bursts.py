"""Best burst per key: the most events within any trailing time range.

Shape of the plan, and why it holds at any size:

1. Events are first counted per (key, time). At the log's second resolution a flood
   of any rate shrinks to one row per second before the shuffle, and that shuffle is
   hashed on key and time, so one busy key is spread over all tasks.
2. Each key is cut into slices of a few hours, each slice starting with a copy of
   the last stretch (one range width) of the slice before. A task sorts slices, not
   keys: a key with a third of all rows is as many groups as it has slices. Slices are
   as long as the widest range at least, so no row has more than two copies, and get
   shorter where a measured hour of some key has very many distinct times (a flood
   with sub-second times), so that a slice has about ``SLICE_ROWS`` rows, or those of
   two widest ranges where that is more.
3. In a slice, the events of ``[t - w, t]`` are the running total minus the total of
   what lies more than ``w`` back. Both frames only grow, so the cost is linear; a
   moving frame would be added up again at every row. The range starts at the event
   after the last one left behind, found by the same growing frame.
4. One partial/final aggregate per key keeps the largest count, earliest end first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knockwatch.functions.times import MICROS, clock_hour, wall_micros

SLICE_SECONDS = 6 * 3600
SLICE_ROWS = 1_000_000


@dataclass(frozen=True)
class Burst:
    """A burst to look for: events of count column ``count`` within ``width`` seconds."""

    name: str
    count: str
    width: int


def slice_micros(hours: DataFrame, widest: int, slice_seconds: int = SLICE_SECONDS, slice_rows: int = SLICE_ROWS) -> Column:
    """Length of a slice for ranges up to ``widest`` seconds, by the most ``times`` that any row of ``hours`` has."""
    densest = F.coalesce(hours.agg(F.max("times")).scalar(), F.lit(1))
    fitting = (F.lit(float(slice_rows * 3600 * MICROS)) / densest).cast("long")
    longest, shortest = (F.lit(s * MICROS).cast("long") for s in (slice_seconds, widest))
    return F.greatest(shortest, F.least(longest, fitting))


def trailing_ranges(counts: DataFrame, keys: Sequence[str], bursts: Sequence[Burst], slice_size: Column) -> DataFrame:
    """``counts`` (one row per key and ``timestamp``) with, per burst, the column ``name``:
    struct(failed_count, window_start, window_end) of the range that ends at this row,
    null where the row has no event of the burst's kind.

    All bursts share one shuffle and one sort. ``slice_size`` (microseconds, as of
    ``slice_micros``) is no less than the longest width.
    """
    longest = max(b.width for b in bursts) * MICROS
    # Slice k opens at k * size and answers for the rows from `longest` after that on; a
    # row also opens the next slice when that has begun by then.
    sliced = (
        counts.withColumns({"_at": wall_micros("timestamp"), "_size": slice_size})
        .selectExpr("*", f"{_floor_div(f'_at - {longest}', '_size')} as _home", f"{_floor_div('_at', '_size')} as _last")
        .selectExpr("*", "explode(sequence(_home, _last)) as _slice")
    )

    ordered = f"partition by {', '.join(f'`{k}`' for k in [*keys, '_slice'])} order by _at"
    so_far = f"({ordered} rows between unbounded preceding and current row)"
    steps, behind, ranges = [], [], []
    for c in sorted({b.count for b in bursts}):
        time = f"if(`{c}` > 0, timestamp, null)"
        steps += [
            f"sum(`{c}`) over {so_far} as `_total_{c}`",
            f"min({time}) over {so_far} as `_first_{c}`",
            f"lead({time}) ignore nulls over ({ordered}) as `_next_{c}`",
        ]
    for b in bursts:
        left = f"({ordered} range between unbounded preceding and {b.width * MICROS + 1} preceding)"
        behind += [
            f"sum(`{b.count}`) over {left} as `_behind_{b.name}`",
            f"max(`_next_{b.count}`) over {left} as `_after_{b.name}`",
        ]
        ranges.append(
            f"if(`{b.count}` > 0, struct("
            f"`_total_{b.count}` - coalesce(`_behind_{b.name}`, 0) as failed_count,"
            f" coalesce(`_after_{b.name}`, `_first_{b.count}`) as window_start,"
            f" timestamp as window_end), null) as `{b.name}`"
        )
    return (
        sliced.selectExpr("*", *steps)
        .selectExpr("*", *behind)
        .filter("_slice = _home")
        .selectExpr(*[f"`{c}`" for c in counts.columns], *ranges)
    )


def _floor_div(value: str, size: str) -> str:
    return f"((({value}) - pmod({value}, {size})) div {size})"


def best(name: str) -> Column:
    """Aggregate: the largest range of column ``name``; the earliest end wins a tie.

    Written as the least (-count, end, start), so that the running best is one struct.
    """
    return F.expr(
        f"min(if({name} is null, null, struct(-{name}.failed_count as negated,"
        f" {name}.window_end as window_end, {name}.window_start as window_start))) as {name}"
    )


def best_burst(
    events: DataFrame,
    keys: Sequence[str] = ("ip",),
    seconds: int = 600,
    slice_seconds: int = SLICE_SECONDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Per key: ``failed_count`` (most events within ``seconds``, both ends included),
    ``window_start`` and ``window_end`` (times of that range's first and last event).

    Counts every row of ``events``; filter first. Keys without events have no row. Events are
    counted twice, once to measure how close they lie; ``best_burst_of`` takes counts instead.
    """
    counts = events.groupBy(*keys, "timestamp").agg(F.count(F.lit(1)).alias("n"))
    hours = counts.groupBy(*keys, clock_hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("times"))
    return best_burst_of(counts, hours, keys, seconds, slice_seconds, slice_rows)


def best_burst_of(
    counts: DataFrame,
    hours: DataFrame,
    keys: Sequence[str] = ("ip",),
    seconds: int = 600,
    slice_seconds: int = SLICE_SECONDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``best_burst`` of events counted before: ``n`` per key and ``timestamp``, and ``times`` (rows of ``counts``) per
    key and hour."""
    size = slice_micros(hours, seconds, slice_seconds, slice_rows)
    return (
        trailing_ranges(counts, keys, [Burst("burst", "n", seconds)], size)
        .groupBy(*keys)
        .agg(best("burst"))
        .selectExpr(
            *[f"`{k}`" for k in keys],
            "-burst.negated as failed_count",
            "burst.window_start as window_start",
            "burst.window_end as window_end",
        )
    )
