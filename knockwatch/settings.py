"""Thresholds of the detection rules.

Every number is a keyword with a default, so one job can be tuned without
touching the queries.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleSettings:
    # These defaults decide which alerts are raised.
    static_threshold: int = 5
    static_window: int = 60
    adaptive_multiplier: float = 3
    adaptive_window: int = 300
    adaptive_floor: int = 6
    fallback_baseline: int = 5
    account_diversity_min: int = 3
    account_diversity_window: int = 600
    working_hours_start: int = 8
    working_hours_end: int = 20
    off_hours_min: int = 3
    distributed_min_ips: int = 3
    distributed_window: int = 600
    quiet_limit: int = 2
    baseline_floor: int = 3
    baseline_headroom: int = 4
