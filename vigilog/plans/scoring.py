"""Jobs that join the forest and the rolling baseline into one verdict."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilog.functions.parse import PARSED, with_parse
from vigilog.operators.forest import ForestModel, with_score, with_verdict
from vigilog.operators.labels import verdict
from vigilog.operators.rolling import smart_alerts
from vigilog.streaming.baseline import run_stateful

_PASSED = [
    "timestamp", "disk_read_mb", "disk_write_mb", "net_sent_mb", "net_recv_mb",
    "top_proc_name", "anomaly_type",
]


def scored_entries(
    entries: DataFrame, model: ForestModel, stream_key: str | None = None,
    order_col: str = "line_no", carry: list[str] | None = None, **baseline,
) -> DataFrame:
    """Forest score, smart alert and final decision for every entry.

    The score is added before the shuffle of the rolling window, so Python sees
    every row once, in scan order.
    """
    passed = list(carry or [])
    scored = with_score(entries, model).select(
        *([stream_key] if stream_key else []), order_col, "cpu_max_pct", "mem_used_pct",
        "score", *passed,
    )
    detected = smart_alerts(
        scored, stream_key=stream_key, order_col=order_col, carry=["score", *passed], **baseline
    )
    return with_verdict(detected, model.meta["offset"])


def scored_history(
    entries: DataFrame, model: ForestModel, stream_key: str | None = None,
    order_col: str = "line_no", **baseline,
) -> DataFrame:
    """The whole table scored by both detectors, with fresh baselines."""
    scored = scored_entries(entries, model, stream_key, order_col, _PASSED, **baseline)
    nonan = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return scored.select(
        *([stream_key] if stream_key else []),
        order_col,
        F.coalesce("timestamp", F.lit("")).alias("timestamp"),
        F.col("cpu_max_pct").alias("cpu"),
        F.col("mem_used_pct").alias("mem"),
        nonan("disk_read_mb").alias("disk_r"),
        nonan("disk_write_mb").alias("disk_w"),
        nonan("net_sent_mb").alias("net_s"),
        nonan("net_recv_mb").alias("net_r"),
        F.coalesce("top_proc_name", F.lit("")).alias("proc"),
        "is_anomaly", "iso_anomaly", "smart_alert", "smart_reason", "label", "score",
        F.coalesce("anomaly_type", F.lit("none")).alias("anomaly_type"),
    )


def score_lines(
    lines: DataFrame, model: ForestModel, stream_key: str | None = None,
    order_col: str = "line_no", **baseline,
) -> tuple[DataFrame, DataFrame]:
    """Raw lines (``value``) -> scored entries, and the refused lines with the reason."""
    parsed = with_parse(lines)
    good = parsed.where(F.col("parse_status") == PARSED)
    scored = scored_entries(
        good, model, stream_key, order_col, ["timestamp", "top_proc_name"], **baseline
    ).select(
        *([stream_key] if stream_key else []), order_col,
        "is_anomaly", "label", "score", "iso_anomaly", "smart_alert", "smart_reason",
        "cpu_max_pct", "mem_used_pct", "timestamp", F.col("top_proc_name").alias("top_proc"),
    )
    empty = F.coalesce(F.col("value"), F.lit("")) == ""
    refused = parsed.where(F.col("parse_status") != PARSED).select(
        *([stream_key] if stream_key else []), order_col, "value",
        F.when(empty, "raw_log field is required").otherwise("Could not parse log line").alias("error"),
    )
    return scored, refused


def first_scored(scored: DataFrame, n: int = 5, order_col: str = "line_no") -> DataFrame:
    """The first entries with the decisions of both detectors side by side."""
    return scored.orderBy(order_col).limit(n).select(
        order_col, F.col("cpu_max_pct").alias("cpu"), F.col("mem_used_pct").alias("mem"),
        verdict(F.col("iso_anomaly")).alias("iso_label"),
        verdict(F.col("smart_alert")).alias("smart_label"), "smart_reason",
    )


def run_scored_stream(
    entries: DataFrame, model: ForestModel, stream_key: str, out: str, checkpoint: str,
    order_col: str = "line_no", carry: list[str] | None = None, **options,
) -> StreamingQuery:
    """Streaming entries -> verdict of both detectors; baselines outlive the batches.

    The forest is a map over the stream, the rolling baseline is kept in the state store;
    options as for ``run_stateful``.
    """
    passed = list(carry or [])
    scored = with_score(entries, model).select(
        stream_key, order_col, "cpu_max_pct", "mem_used_pct", "score", *passed
    )
    return run_stateful(
        scored, stream_key, out, checkpoint, order_col, ["score", *passed],
        finish=lambda found: with_verdict(found, model.meta["offset"]), **options,
    )
