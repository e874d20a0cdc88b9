"""Detector quality against labels: confusion matrix, report, comparison."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.schema import ROLLING_WINDOW, STATIC_CPU, STATIC_MEM, Z_THRESHOLD


def _both(label: str, predicted: str, y: int, p: int) -> Column:
    return F.count_if((F.col(label) == y) & (F.col(predicted) == p))


def confusion_matrix(df: DataFrame, label: str = "is_anomaly", predicted: str = "predicted") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return df.agg(
        _both(label, predicted, 0, 0).alias("tn"),
        _both(label, predicted, 0, 1).alias("fp"),
        _both(label, predicted, 1, 0).alias("fn"),
        _both(label, predicted, 1, 1).alias("tp"),
    )


def classification_report(df: DataFrame, label: str = "is_anomaly", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class and averaged; 0/0 counts as 0."""
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    per_class = confusion_matrix(df, label, predicted).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("Normal").alias("class"), ratio(tn, tn + fn).alias("precision"),
                    ratio(tn, tn + fp).alias("recall"), (tn + fp).alias("support"),
                    ratio(tn + tp, total).alias("accuracy"), total.alias("total"),
                ),
                F.struct(
                    F.lit("Anomaly").alias("class"), ratio(tp, tp + fp).alias("precision"),
                    ratio(tp, tp + fn).alias("recall"), (tp + fn).alias("support"),
                    ratio(tn + tp, total).alias("accuracy"), total.alias("total"),
                ),
            )
        )
    )
    p, r = F.col("precision"), F.col("recall")
    scored = per_class.withColumn("f1", ratio(2 * p * r, p + r))
    measures = ("precision", "recall", "f1")
    weight = F.col("support").cast("double")
    # One row holding both classes and the averages, then one row per line.
    wide = scored.agg(
        F.sort_array(F.collect_list(F.struct("class", *measures, "support")), asc=False).alias("c"),
        F.max("accuracy").alias("accuracy"),
        F.max("total").alias("total"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[ratio(F.sum(F.col(m) * weight), F.sum(weight)).alias(f"weighted_{m}") for m in measures],
    )

    def line(name: str, prefix: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[F.col(f"{prefix}_{m}").alias(m) for m in measures],
            F.col("total").alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[F.lit(None).cast("double").alias(m) for m in ("precision", "recall")],
        F.col("accuracy").alias("f1"),
        F.col("total").alias("support"),
    )
    rows = F.concat(
        F.col("c"), F.array(accuracy, line("macro avg", "macro"), line("weighted avg", "weighted"))
    )
    return wide.select(F.inline(rows))


def compare_detectors(detected: DataFrame) -> DataFrame:
    """Rolling z-score against static thresholds; one row, one pass.

    ``detected`` has ``is_anomaly``, ``smart_alert`` and ``static_alert``.
    """
    counts = detected.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_anomaly") == 1).alias("labelled"),
        _both("is_anomaly", "static_alert", 1, 1).alias("static_tp"),
        _both("is_anomaly", "static_alert", 0, 1).alias("static_fp"),
        _both("is_anomaly", "smart_alert", 0, 1).alias("smart_fp"),
        _both("is_anomaly", "smart_alert", 1, 1).alias("smart_tp"),
        _both("is_anomaly", "smart_alert", 1, 0).alias("smart_fn"),
        _both("is_anomaly", "smart_alert", 0, 0).alias("smart_tn"),
    )
    normal = F.greatest(F.col("total") - F.col("labelled"), F.lit(1))
    return counts.withColumns(
        {
            "fp_rate_static": 100 * F.col("static_fp") / normal,
            "fp_rate_smart": 100 * F.col("smart_fp") / normal,
            "fp_eliminated": F.col("static_fp") - F.col("smart_fp"),
        }
    )


def rolling_report(comparison: DataFrame) -> DataFrame:
    """The comparison in the layout of the saved report."""
    return comparison.select(
        F.lit(ROLLING_WINDOW).alias("rolling_window"),
        F.lit(Z_THRESHOLD).alias("z_threshold"),
        "static_fp", "smart_fp", "smart_tp", "smart_fn", "smart_tn", "fp_eliminated",
        F.lit(STATIC_CPU).alias("static_cpu_thresh"),
        F.lit(STATIC_MEM).alias("static_mem_thresh"),
    )
