"""Tables in the shared folder, from which a job goes on when executors are lost."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from knockwatch.plans.restart import scratch_folder


def cut(table: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``table`` and read it back: its lineage ends here, and Spark knows its size.

    It goes to the folder named by ``spark.checkpoint.dir`` and can be deleted once the
    results are written; a local session without that setting gets a folder that goes with it.
    """
    path = f"{scratch_folder(table.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    table.write.option("compression", codec).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
