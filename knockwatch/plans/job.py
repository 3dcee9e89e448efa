"""Start the job from a shell: ``spark-submit knockwatch/plans/job.py /logs/auth.log* --out /results``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from knockwatch.plans.detect import detect
from knockwatch.sources import read_attackers_file


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Find password-guessing attacks in sshd logs.")
    parser.add_argument("paths", nargs="+", help="log files, folders or globs")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--attackers", help="known attackers: a Parquet, JSON or CSV table with a column ip, or text lines")
    parser.add_argument("--year", type=int, help="year of the log (default: the current one)")
    parser.add_argument("--summaries", action="store_true", help="also write the report tables")
    parser.add_argument("--work", help="folder for stored intermediate tables")
    parser.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments(argv)
    spark = SparkSession.builder.appName("knockwatch").getOrCreate()
    known = read_attackers_file(spark, given.attackers) if given.attackers else None
    detect(spark, given.paths, given.out, known, given.year, given.summaries, given.mode, given.work)


if __name__ == "__main__":
    main()
