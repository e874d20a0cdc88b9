"""Parse-and-alert stream, counters and totals."""

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilog.functions.parse import PARSED, with_parse

# What names a message whatever broker offset a resend got.
MESSAGE = ("producer", "line_no")
NAMES = ("received", "parsed", "anomalies")


def sent_once(envelopes: DataFrame, within: str, key: tuple[str, ...] = MESSAGE) -> DataFrame:
    """Streaming envelopes without those that a sender repeats after a failure.

    A message is known by ``key``: producer and line number, or the broker's topic, partition and
    offset where only the delivery repeats. Keys stay in the state store, over restarts too,
    until the watermark, which follows ``sent_at`` by ``within``, has passed them; a message without
    the time of sending counts as sent now. Keys spread by hash; one with a null is a key too.
    """
    at = F.coalesce(F.timestamp_seconds("sent_at"), F.current_timestamp())
    return envelopes.withColumn("_sent", at).withWatermark("_sent", within).dropDuplicatesWithinWatermark(list(key)).drop("_sent")


def run_alerts(
    envelopes: DataFrame, out: str, checkpoint: str, available_now: bool = True, counts: str | None = None,
) -> StreamingQuery:
    """Write every entry, alerts and OK entries in separate folders, and count every batch.

    Without a key or an aggregate the job has no state. A batch of fewer partitions than the
    cluster has cores, such as one file, is dealt out to all of them before its lines are parsed;
    any other is not shuffled. Entries go to
    ``out/batch=n/is_anomaly=x``; a row of counts goes to ``counts/batch=n`` (by default
    beside the checkpoint). A batch that is run again after a failure replaces its own
    folders, so each entry is stored and counted once; for messages that the sender repeats
    pass the envelopes through ``sent_once``. A broker's own topic, partition
    and offset stay as ``broker_topic``, ``broker_partition`` and ``broker_offset``; the
    envelope's line number is ``kafka_offset``.
    """
    tallies = counts or counts_path(checkpoint)
    fields = {
        "kafka_offset": F.col("line_no"),
        "producer_pid": F.col("producer"),
        "message_sent_at": F.col("sent_at"),
    }
    used = ("parse_status", "raw_log", "line_no", "producer", "sent_at", "topic")

    def process(batch: DataFrame, batch_id: int) -> None:
        began = time.time()
        seen = Observation()
        cores = batch.sparkSession.sparkContext.defaultParallelism
        spread = batch.repartition(cores) if batch.rdd.getNumPartitions() < cores else batch
        parsed = with_parse(spread, "raw_log").observe(
            seen,
            F.count(F.lit(1)).alias("received"),
            F.count_if(F.col("parse_status") == PARSED).alias("parsed"),
            F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
        )
        found = parsed.where(F.col("parse_status") == PARSED).withColumns(fields).drop(*used)
        found.write.mode("overwrite").partitionBy("is_anomaly").parquet(f"{out}/batch={batch_id}")
        row = [(*(seen.get[n] or 0 for n in NAMES), began, time.time())]
        tally = batch.sparkSession.createDataFrame(row, COUNT_SCHEMA)
        tally.coalesce(1).write.mode("overwrite").parquet(f"{tallies}/batch={batch_id}")

    writer = envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


COUNT_SCHEMA = "received bigint, parsed bigint, anomalies bigint, began double, ended double"


def counts_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-counts"


def stream_counts(spark: SparkSession, counts: str) -> DataFrame:
    """One row: totals over all batches since the first start, elapsed seconds and rate.

    ``received`` counts every message, also those that give no entry. A batch counts
    once however often it was run.
    """
    total = spark.read.schema(COUNT_SCHEMA).parquet(f"{counts}/batch=*").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in NAMES], (F.max("ended") - F.min("began")).alias("seconds"),
    )
    rate = F.when(F.col("seconds") > 0, F.round(F.col("received") / F.col("seconds"), 1)).otherwise(0.0)
    return total.withColumn("rate", rate)


def run_totals(
    entries: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Running count of normal and anomalous entries; ``out`` holds the latest."""
    counts = entries.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("entries"))

    def replace(batch: DataFrame, _: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(out)

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
