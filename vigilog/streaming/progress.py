"""Rates and lag of running streams, kept as a table."""

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = (
    "at string, rows bigint, arriving_per_second double, processed_per_second double, "
    "batch_ms bigint, state_rows bigint, state_bytes bigint, watermark string"
)


class ProgressTable(StreamingQueryListener):
    """Writes a row for each batch to ``folder/query=id/batch=n``; one that is run again replaces its own.

    A query keeps its id over restarts, so the table goes on where it was. Batches without rows leave none.
    Register with ``spark.streams.addListener``; ``finish`` waits until a stopped query's rows are written.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if not p["numInputRows"]:
            return
        state = p.get("stateOperators", [])
        row = (
            p["timestamp"], p["numInputRows"], p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"),
            p.get("durationMs", {}).get("triggerExecution"), sum(s["numRowsTotal"] for s in state),
            sum(s["memoryUsedBytes"] for s in state), p.get("eventTime", {}).get("watermark"),
        )
        path = f"{self.folder}/query={p['id']}/batch={p['batchId']}"
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def finish(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        return self._event(str(query.runId)).wait(seconds)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """``query, batch`` and the figures of ``SCHEMA``."""
    return spark.read.schema(f"{SCHEMA}, query string, batch bigint").option("basePath", folder).parquet(f"{folder}/query=*")


def rates(progress: DataFrame) -> DataFrame:
    """For each query: batches, rows, mean and least rows a second, longest batch, state of the newest batch.

    ``behind_ms`` is how long the newest batch ran beyond what its rows took to arrive, as far as
    Spark reports an arrival rate; null otherwise.
    """
    busy = F.sum("batch_ms") / 1000.0
    arrival = F.when(F.col("arriving_per_second") > 0, F.col("rows") * 1000.0 / F.col("arriving_per_second"))
    return progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), (F.sum("rows") / busy).alias("rows_per_second"),
        F.min("processed_per_second").alias("least_per_second"), F.max("batch_ms").alias("longest_ms"),
        F.max_by("state_rows", "batch").alias("state_rows"), F.max_by(F.col("batch_ms") - arrival, F.col("batch")).alias("behind_ms"),
    )
