"""Alert and metric files. Every writer writes a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def iso_times(table: DataFrame) -> DataFrame:
    """``table`` with its wall-clock times as ISO text: seconds, and six more digits where
    the fraction is not zero. The session time zone plays no part."""

    def text(name: str) -> Column:
        plain = F.translate(F.col(name).cast("string"), " ", "T")
        return F.when(F.contains(plain, F.lit(".")), F.rpad(plain, 26, "0")).otherwise(plain)

    return table.withColumns({name: text(name) for name, kind in table.dtypes if kind == "timestamp_ntz"})


def json_line(table: DataFrame) -> Column:
    """A row of ``table`` as a JSON object that holds only what is not null."""
    return F.to_json(F.struct(*table.columns), {"ignoreNullFields": "true"})


def alerts_json_lines(alerts: DataFrame) -> DataFrame:
    """``rule``, ``ip`` and the whole alert as ``json``: only the keys its rule fills, times in ISO form."""
    timed = iso_times(alerts)
    return timed.select("rule", "ip", json_line(timed).alias("json"))


def metrics_json_lines(metrics: DataFrame) -> DataFrame:
    """The metrics as ``json``."""
    return metrics.select(json_line(metrics).alias("json"))


def write_alerts_json(alerts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per alert, as of ``alerts_json_lines``."""
    alerts_json_lines(alerts).select("json").write.mode(mode).text(path)


def alert_details(alerts: DataFrame) -> DataFrame:
    """``rule``, ``ip`` and the other filled fields as JSON text in ``details``."""
    timed = iso_times(alerts)
    return timed.select("rule", "ip", json_line(timed.drop("rule", "ip")).alias("details"))


def write_alerts_csv(alerts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``rule, ip, details, timestamp`` with a header (also without alerts); ``timestamp`` is the write time."""
    (
        alert_details(alerts)
        .withColumn("timestamp", F.date_format(F.current_timestamp(), ISO_SECONDS))
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_metrics_json(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The metrics, as of ``metrics_json_lines``."""
    metrics_json_lines(metrics).write.mode(mode).text(path)
