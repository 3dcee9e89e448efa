"""Schemas shared by the readers, the rules and the writers.

Times are zone-free (``timestamp_ntz``): the log carries local wall-clock text,
and hour-of-day rules must not move with the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

ATTEMPTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("username", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# Field order is the key order of an exported alert.
ALERTS = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("unique_usernames", T.LongType()),
        T.StructField("attacking_ips", T.ArrayType(T.StringType())),
        T.StructField("target_username", T.StringType()),
        T.StructField("failed_count", T.LongType()),
        T.StructField("threshold_used", T.IntegerType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("first_seen", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
    ]
)

ATTACKERS = T.StructType([T.StructField("ip", T.StringType())])
