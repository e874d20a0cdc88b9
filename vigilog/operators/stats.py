"""Counts, extremes and breakdowns over parsed entries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.functions.numeric import round_exact
from vigilog.functions.parse import ERROR, PARSED, SKIPPED
from vigilog.schema import ROLLING_REPORT


def entry_counts(df: DataFrame) -> DataFrame:
    """Total, normal and anomaly counts with whole percentages (floored).

    No row if there are no entries.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_anomaly") == 0).alias("normals"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
    ).where(F.col("total") > 0)
    return counts.withColumns(
        {
            "normal_pct": F.expr("100 * normals div total"),
            "anomaly_pct": F.expr("100 * anomalies div total"),
        }
    )


def extremes(df: DataFrame) -> DataFrame:
    """Min, max and mean of CPU and memory, one pass."""
    return df.agg(
        *[
            fn(col).alias(f"{short}_{name}")
            for short, col in (("cpu", "cpu_max_pct"), ("mem", "mem_used_pct"))
            for name, fn in (("min", F.min), ("max", F.max), ("avg", F.avg))
        ]
    )


def type_breakdown(df: DataFrame, anomalies_only: bool = True) -> DataFrame:
    """Entries per anomaly type, most frequent first."""
    rows = df.where(F.col("is_anomaly") == 1) if anomalies_only else df
    return (
        rows.groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("entries"))
        .orderBy(F.desc("entries"), "anomaly_type")
    )


def stats_summary(
    df: DataFrame, model_loaded: bool = False, rolling: DataFrame | None = None
) -> DataFrame:
    """Dashboard summary in one row: totals, averages, type map, report.

    The entries are read once: rows are first counted per type, and the few
    type rows are then folded into one.
    """
    real = lambda c: F.when(~F.isnan(c), F.col(c))
    per_type = df.groupBy("anomaly_type", "is_anomaly").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            a
            for short, col in (("cpu", "cpu_max_pct"), ("mem", "mem_used_pct"))
            for a in (
                F.sum(real(col)).alias(f"{short}_sum"),
                F.count(real(col)).alias(f"{short}_n"),
                F.max(real(col)).alias(f"{short}_top"),
            )
        ],
    )
    flagged = F.col("is_anomaly") == 1
    one = per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0)).alias("anomalies"),
        F.try_divide(F.sum("cpu_sum"), F.sum("cpu_n")).alias("_cpu_avg"),
        F.max("cpu_top").alias("_cpu_max"),
        F.try_divide(F.sum("mem_sum"), F.sum("mem_n")).alias("_mem_avg"),
        F.max("mem_top").alias("_mem_max"),
        F.map_from_entries(
            # A null type is no key; such rows count in the totals only.
            F.collect_list(F.when(flagged & F.col("anomaly_type").isNotNull(), F.struct("anomaly_type", "n")))
        ).alias("anomaly_types"),
    ).withColumn("_pct", F.try_divide(100 * F.col("anomalies"), F.col("total")))
    summary = one.select(
        "total",
        (F.col("total") - F.col("anomalies")).alias("normals"),
        "anomalies",
        F.coalesce(round_exact("_pct", 1), F.lit(0.0)).alias("anomaly_pct"),
        *[
            round_exact(f"_{c}", 1).alias(c)
            for c in ("cpu_avg", "cpu_max", "mem_avg", "mem_max")
        ],
        "anomaly_types",
        F.lit(model_loaded).alias("model_loaded"),
    )
    if rolling is None:
        return summary.withColumn("rolling_baseline", F.lit(None).cast(ROLLING_REPORT))
    # A scalar subquery: null if the report has no rolling section.
    section = rolling.select(F.struct(*ROLLING_REPORT.names))
    return summary.select("*", section.scalar().alias("rolling_baseline"))


def donut(df: DataFrame) -> DataFrame:
    """Slices of the type chart; absent types are 0."""
    def typed(name: str):
        return F.count_if((F.col("is_anomaly") == 1) & (F.col("anomaly_type") == name))

    return df.agg(
        F.count_if(F.col("is_anomaly") == 0).alias("normal"),
        typed("CPU_SPIKE").alias("cpu_spike"),
        typed("MEM_SPIKE").alias("mem_spike"),
    )


def parse_tally(parsed: DataFrame, status: str = "parse_status") -> DataFrame:
    """Lines parsed, skipped and in error."""
    return parsed.agg(
        F.count_if(F.col(status) == PARSED).alias("parsed"),
        F.count_if(F.col(status) == SKIPPED).alias("skipped"),
        F.count_if(F.col(status) == ERROR).alias("errors"),
    )


def verdict_totals(scored: DataFrame) -> DataFrame:
    """Totals over the final decision of a scored table."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_anomaly") == 0).alias("normals"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
    )
