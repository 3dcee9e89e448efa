"""Column helpers for operators that stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words of lower-cased text: ASCII other than digits and small letters.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """Words of a text; none for a null text."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def places(last: Column) -> Column:
    """1 to ``last``, empty when that is below 1."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _scan(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each number what ``step`` makes of ``start`` and the numbers before it."""
    return F.aggregate(
        values,
        F.struct(start.cast("long").alias("so_far"), F.array().cast("array<bigint>").alias("out")),
        lambda a, v: F.struct(step(a["so_far"], v).cast("long").alias("so_far"), F.array_append(a["out"], a["so_far"]).alias("out")),
        lambda a: a["out"],
    )


def scan_before(values: Column, start: int, step: Callable[[Column, Column], Column], chunk: int = 128) -> Column:
    """``_scan`` of an associative ``step``. The array is read in chunks, since appending to an array copies it."""

    def of(v: Column) -> Column:
        chunks = places(F.ceil(F.size(v) / chunk).cast("int"))
        first = F.lit(start).cast("long")

        def part(c: Column) -> Column:
            return F.slice(v, (c - 1) * chunk + 1, F.lit(chunk))

        wholes = F.transform(chunks, lambda c: F.aggregate(part(c), first, lambda a, x: step(a, x).cast("long")))
        return let(
            _scan(wholes, first, step),
            lambda starts: F.flatten(F.transform(chunks, lambda c: _scan(part(c), F.get(starts, c - 1), step))),
        )

    return let(values, of)


def totals_before(values: Column, chunk: int = 128) -> Column:
    """For each number of an array the sum of those before it."""
    return scan_before(values, 0, lambda a, x: a + x, chunk)


def most_before(values: Column, least: int) -> Column:
    """For each number of an array the greatest of those before it, at least ``least``."""
    return scan_before(values, least, lambda a, x: F.greatest(a, x))
