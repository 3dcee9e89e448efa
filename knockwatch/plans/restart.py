"""Points from which a job goes on when executors are lost."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, tempfile.TemporaryDirectory] = {}


def _shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. A local session where that is
    unset gets a folder of its own, which goes with the process; a cluster must name one."""
    shared = _shared_folder(spark)
    if shared is not None:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.TemporaryDirectory(prefix="knockwatch-")
    return _own_folders[context.applicationId].name


def work_folder(spark: SparkSession, work: str | None, out: str | None = None) -> str:
    """A folder of its own for this run: in ``work`` if given, else in the shared folder
    the cluster names in ``spark.checkpoint.dir``, else beside the results."""
    base = work or _shared_folder(spark) or out or scratch_folder(spark)
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def stored(table: DataFrame, path: str) -> DataFrame:
    """Write ``table`` and go on from the files: nothing above is computed again,
    also when executors are lost."""
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def keep_in(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """Stores tables by name below ``folder``."""
    return lambda table, name: stored(table, f"{folder}/{name}")
