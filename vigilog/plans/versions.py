"""Versions of a model, and a stream that takes up a new one at a batch boundary."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilog.operators.forest import ForestModel, with_score, with_verdict
from vigilog.schema import FEATURES
from vigilog.sinks.tables import write_model
from vigilog.sources.tables import optional, read_model
from vigilog.streaming.baseline import CPU, MEM, ROCKSDB, settings, stateful_alerts

_VERSION = "version bigint"


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest published version; None if there is none."""
    ready = optional(lambda: spark.read.schema(_VERSION).parquet(f"{root}/ready"))
    return None if ready is None else ready.agg(F.max("version")).first()[0]


def publish_model(model: ForestModel, root: str) -> int:
    """Stores ``model`` as the next version under ``root`` and returns its number, from 1.

    Versions are never changed. Readers see one when its parts are complete, since its
    number is added last. One publisher at a time.
    """
    spark = model.nodes.sparkSession
    version = (latest_version(spark, root) or 0) + 1
    write_model(model, f"{root}/version={version}")
    spark.createDataFrame([(version,)], _VERSION).coalesce(1).write.mode("append").parquet(f"{root}/ready")
    return version


def read_version(spark: SparkSession, root: str, version: int) -> ForestModel:
    model = read_model(spark, f"{root}/version={version}")
    if model is None:
        raise ValueError(f"version {version} is missing under {root}")
    return model


def run_versioned_stream(
    entries: DataFrame, models: str, stream_key: str, out: str, checkpoint: str,
    order_col: str = "line_no", carry: list[str] | None = None, features: list[str] = FEATURES,
    available_now: bool = True, keep_ms: int | None = None,
) -> StreamingQuery:
    """As ``run_scored_stream``, with the model that is newest when a batch begins, and its ``model_version``.

    The version a batch takes is written beside the checkpoint before its rows are, so a batch
    that is run again after a failure takes the same one, whatever was published since, and
    replaces its own folder ``out/batch=n``. Baselines run on over a change of model. Without
    any published version the query is refused at its start.
    """
    spark = entries.sparkSession
    if latest_version(spark, models) is None:
        raise ValueError(f"no model was published under {models}")
    passed = list(carry or [])
    read = [c for c in features if c not in (CPU, MEM, *passed)]
    found = stateful_alerts(entries, stream_key, order_col, [*passed, *read], keep_ms=keep_ms)
    choices = f"{checkpoint.rstrip('/')}-versions"
    held: dict[int, ForestModel] = {}

    def chosen(session: SparkSession, batch_id: int) -> int:
        path = f"{choices}/batch={batch_id}"
        before = optional(lambda: session.read.schema(_VERSION).parquet(path))
        row = before.first() if before is not None else None
        if row is not None:
            return row.version
        version = latest_version(session, models)
        session.createDataFrame([(version,)], _VERSION).coalesce(1).write.mode("overwrite").parquet(path)
        return version

    def process(batch: DataFrame, batch_id: int) -> None:
        version = chosen(batch.sparkSession, batch_id)
        if version not in held:
            held.clear()
            held[version] = read_version(batch.sparkSession, models, version)
        model = held[version]
        judged = with_verdict(with_score(batch, model).drop(*read), model.meta["offset"])
        judged.withColumn("model_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = found.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(process)
    with settings(spark, provider=ROCKSDB, empty_batches="false"):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
