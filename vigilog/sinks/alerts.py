"""Alert and OK lines of parsed entries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERT_COLUMNS = [
    "timestamp", "anomaly_type", "cpu_max_pct", "mem_used_pct", "top_proc_name", "top_pid",
]


def alerts(entries: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """What an alert shows, for entries labelled as anomalies."""
    return entries.where(F.col("is_anomaly") == 1).select(*(keep or []), *ALERT_COLUMNS)


def ok_lines(entries: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """What is noted for every other entry."""
    return entries.where(F.col("is_anomaly") == 0).select(
        *(keep or []), "cpu_max_pct", "mem_used_pct", "top_proc_name"
    )
