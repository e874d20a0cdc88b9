"""The batch job: log files -> parsed table -> model -> report."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.parse import PARSED, entries, quarantine, with_parse
from vigilog.operators.evaluate import classification_report, compare_detectors, confusion_matrix, rolling_report
from vigilog.operators.forest import ForestModel, fit_forest, iso_flag, with_score
from vigilog.operators.rolling import detections
from vigilog.operators.stats import entry_counts, extremes, parse_tally, type_breakdown
from vigilog.sinks.tables import merge_rolling, training_report, write_entries, write_model, write_report, write_sample
from vigilog.sources.text import read_log
from vigilog.sources.tables import read_model
from vigilog.storage import scratch
from vigilog.schema import TABLE_SCHEMA


@dataclass(frozen=True)
class BatchResult:
    table: DataFrame
    refused: DataFrame
    tally: DataFrame
    model: ForestModel


def ingest(spark: SparkSession, log_path: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Parse log files once; returns the stored entries and the stored refused lines.

    Lines are written with their status in one pass, split by it into folders,
    so the table and the quarantine are two reads of the same output. The text is
    kept for refused lines only.
    """
    parsed = with_parse(read_log(spark, log_path)).withColumn(
        "value", F.when(F.col("parse_status") != PARSED, F.col("value"))
    )
    parsed.write.mode("overwrite").partitionBy("parse_status").parquet(f"{out}/lines")
    stored = spark.read.schema(parsed.schema).parquet(f"{out}/lines")
    return stored, quarantine(stored)


def run(spark: SparkSession, log_path: str, out: str) -> BatchResult:
    """All steps of the batch job for one log; outputs below ``out``.

    ``lines`` (entries and refused lines), ``csv``, ``sample``, ``model``, ``report`` and,
    for the forest against the labels, ``forest_matrix`` and ``forest_classes``; ``counts``,
    ``extremes`` and ``types`` describe the entries. Baselines start anew in each file.
    """
    with scratch(spark):
        stored, refused = ingest(spark, log_path, out)
        table = entries(stored).select("file", *TABLE_SCHEMA.names)
        write_entries(table, f"{out}/csv", "csv")
        write_sample(table, f"{out}/sample")
        for name, facts in (("counts", entry_counts(table)), ("extremes", extremes(table)), ("types", type_breakdown(table))):
            facts.write.mode("overwrite").parquet(f"{out}/{name}")
        write_model(fit_forest(table, ["file", "line_no"]), f"{out}/model")
        model = read_model(spark, f"{out}/model")
        judged_by_forest(table, model).write.mode("overwrite").parquet(f"{out}/scored")
        scored = spark.read.parquet(f"{out}/scored")
        write_report(training_report(scored, model.meta["contamination"]), f"{out}/report")
        confusion_matrix(scored, predicted="iso_anomaly").write.mode("overwrite").parquet(f"{out}/forest_matrix")
        classification_report(scored, predicted="iso_anomaly").write.mode("overwrite").parquet(f"{out}/forest_classes")
        found = detections(table, stream_key="file", dense=True)
        merge_rolling(rolling_report(compare_detectors(found)), f"{out}/report")
    return BatchResult(table, refused, parse_tally(stored), model)


def judged_by_forest(table: DataFrame, model: ForestModel) -> DataFrame:
    """Score and decision of the forest next to the label of every entry."""
    scored = with_score(table, model)
    return scored.select("file", "line_no", "is_anomaly", "score", iso_flag(F.col("score"), model.meta["offset"]).alias("iso_anomaly"))
