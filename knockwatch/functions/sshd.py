"""The three sshd messages that carry a login attempt, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message texts, line patterns and month names. Character classes
# are Unicode-aware. The patterns are anchored at the line start only.
HEADER = r"(?U)^(\w{3})\s+(\d+)\s+(\d{2}:\d{2}:\d{2})\s+\S+\s+sshd\[\d+\]:\s+"
ADDRESS = r"(\d{1,3}(?:\.\d{1,3}){3})"
FAILED = HEADER + r"Failed password for(?:\s+invalid user)?\s+(\S+)\s+from\s+" + ADDRESS + r"\s+port\s+\d+"
ACCEPTED = HEADER + r"Accepted password for\s+(\S+)\s+from\s+" + ADDRESS + r"\s+port\s+\d+"
INVALID_USER = HEADER + r"Invalid user\s+(\S+)\s+from\s+" + ADDRESS
MONTHS = " jan feb mar apr may jun jul aug sep oct nov dec"
MESSAGES = [
    ("Failed password", FAILED, "failed"),
    ("Accepted password", ACCEPTED, "success"),
    ("Invalid user", INVALID_USER, "failed"),
]


def message_fields(line: Column) -> Column:
    """Split a stripped line into ``['', user, ip, status, month, day, time]``.

    The first message text found in the line picks the one pattern that is tried,
    and that pattern runs once per line: it rewrites the line into blank-separated
    fields (none of which can hold a blank). A line that fails its pattern stays as
    it was, so its first field is not empty; a line without any of the texts is null.
    """
    fields = None
    for text, pattern, status in MESSAGES:
        rewritten = F.regexp_replace(line, pattern + "(?s:.*)", f" $4 $5 {status} $1 $2 $3")
        found = line.contains(text)
        fields = F.when(found, rewritten) if fields is None else fields.when(found, rewritten)
    return F.split(fields, " ")


def log_time(year: int, month: Column, day: Column, time: Column) -> Column:
    """``Jan``, ``5``, ``10:00:00`` → timestamp_ntz, null when that is no date or time."""
    number = ((F.instr(F.lit(MONTHS), F.concat(F.lit(" "), F.lower(month))) + 3) / 4).cast("int")
    text = F.concat(F.lit(f"{year:04d}-"), number.cast("string"), F.lit("-"), day, F.lit(" "), time)
    return text.try_cast("timestamp_ntz")
