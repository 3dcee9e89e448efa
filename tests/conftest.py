from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from knockwatch.schemas import ATTEMPTS  # noqa: E402

BASE = datetime(2026, 1, 12, 10, 0, 0)


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    """Stands for the cluster's shared checkpoint folder."""
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def spark(shared):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def attempts(spark):
    """Build attempts from (timestamp or seconds after BASE, ip, username[, status]) tuples."""

    def build(rows):
        full = []
        for when, ip, username, *status in rows:
            ts = when if isinstance(when, datetime) or when is None else BASE + timedelta(seconds=when)
            full.append((ts, username, ip, status[0] if status else "failed"))
        return spark.createDataFrame(full, ATTEMPTS)

    return build
