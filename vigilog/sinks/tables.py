"""Parsed table, sample, report and model writers."""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.labels import flatten
from vigilog.operators.paging import first_record
from vigilog.schema import CSV_DIALECT, FEATURES, REPORT_SCHEMA, ROLLING_REPORT, TABLE_SCHEMA
from vigilog.sources.tables import read_report


def write_entries(entries: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write the flat table, replacing ``path``; nothing is written if empty."""
    flat = flatten(entries).select(*TABLE_SCHEMA.names)
    if flat.isEmpty():
        return False
    writer = flat.write.mode("overwrite")
    (writer.options(header=True, **CSV_DIALECT) if fmt == "csv" else writer).format(fmt).save(path)
    return True


def write_sample(entries: DataFrame, path: str) -> None:
    """The first entry by line number as JSON."""
    first_record(flatten(entries)).write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """The model report, without a rolling section yet."""
    report.select(*[f for f in REPORT_SCHEMA.names if f != "rolling_baseline"]).write.mode(
        "overwrite"
    ).json(path)


def merge_rolling(rolling: DataFrame, path: str) -> bool:
    """Add the rolling section to the saved report; False if there is no report.

    ``rolling`` and the report are one row each, so they are held as values
    while the file they came from is replaced.
    """
    saved = read_report(rolling.sparkSession, path)
    base = saved.first() if saved is not None else None
    if base is None:
        return False
    section = rolling.select(*ROLLING_REPORT.names).first()
    merged = {**base.asDict(), "rolling_baseline": section.asDict()}
    rolling.sparkSession.createDataFrame([merged], REPORT_SCHEMA).coalesce(1).write.mode(
        "overwrite"
    ).json(path)
    return True


def write_model(model, path: str) -> None:
    """Scaler, node table and settings of a forest, replacing ``path``."""
    spark = model.nodes.sparkSession
    model.scaler.coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    model.nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = spark.createDataFrame([(json.dumps(model.meta),)], "meta string")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")


def training_report(scored: DataFrame, contamination: float) -> DataFrame:
    """Total, predicted anomalies and normals of a forest over its training rows."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("iso_anomaly") == 1).alias("anomalies"),
        F.count_if(F.col("iso_anomaly") == 0).alias("normals"),
    ).withColumns(
        {
            "features": F.array(*[F.lit(f) for f in FEATURES]),
            "contamination": F.lit(contamination),
        }
    )
