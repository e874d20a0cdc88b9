"""Parsed tables, saved reports and saved models."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.schema import CSV_DIALECT, REPORT_SCHEMA, TABLE_SCHEMA


def read_entries(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The parsed table with its fixed schema; a missing path is an error.

    Parquet is the working format (column pruning, pushed filters); ``csv`` is
    for interchange, with quotes doubled inside quoted fields.
    """
    reader = spark.read.schema(TABLE_SCHEMA)
    if fmt == "csv":
        return reader.options(header=True, enforceSchema=False, multiLine=True, **CSV_DIALECT).csv(path)
    return reader.format(fmt).load(path)


def overview(df: DataFrame) -> DataFrame:
    """Row and column counts of a loaded table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def optional(read):
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved report, one row; None if there is none.

    A report without the rolling section has null there.
    """
    return optional(
        lambda: spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)
    )


def read_rolling_section(spark: SparkSession, path: str) -> DataFrame:
    """Only the rolling section; empty if the report or the section is missing."""
    report = read_report(spark, path)
    if report is None:
        report = spark.createDataFrame([], REPORT_SCHEMA)
    return report.where(F.col("rolling_baseline").isNotNull()).select("rolling_baseline.*")


def read_model(spark: SparkSession, path: str):
    """A saved model, or None ("not loaded") unless all its parts are there."""
    from vigilog.operators.forest import ForestModel

    parts = [optional(lambda p=p: spark.read.parquet(f"{path}/{p}")) for p in ("scaler", "nodes", "meta")]
    if any(p is None for p in parts):
        return None
    scaler, nodes, meta = parts
    return ForestModel(scaler=scaler, nodes=nodes, meta=json.loads(meta.first().meta))
