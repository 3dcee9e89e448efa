"""Readers and writers."""

from knockwatch.sources.readers import read_attackers, read_attackers_file, read_lines
from knockwatch.sources.writers import (
    alert_details,
    alerts_json_lines,
    metrics_json_lines,
    write_alerts_csv,
    write_alerts_json,
    write_metrics_json,
)

__all__ = [
    "read_attackers",
    "read_attackers_file",
    "read_lines",
    "alert_details",
    "alerts_json_lines",
    "metrics_json_lines",
    "write_alerts_csv",
    "write_alerts_json",
    "write_metrics_json",
]
