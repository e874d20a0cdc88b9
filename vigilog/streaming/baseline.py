"""The rolling baseline on a live stream, with the last readings of every stream in Spark's state store.

* ``run_stateful`` keeps them as a list in RocksDB by ``transformWithStateInPandas``; streams
  without rows for a while can be forgotten.
* ``keyed_alerts`` keeps them by ``applyInPandasWithState``, for sessions with another state store.

Both give what the batch operator gives. A group is one stream's rows of one micro-batch:
bound it by the source's ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``.
"""

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigilog.operators.rolling import CPU, MEM, with_smart_alert, with_zscores
from vigilog.schema import ROLLING_WINDOW

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# With a time to live the operator asks for batches without data for ever, so that a query over what is there never ends.
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
FIGURES = ["cpu_mean", "cpu_std", "mem_mean", "mem_std"]
# Deviations take window times the memory of their rows, so figures are made for so many rows at a time.
SLICE_ROWS = 10_000


def preceding_stats(values: np.ndarray, before: int, window: int) -> tuple:
    """Count, mean and population deviation of the readings before each new one.

    ``values`` starts with ``before`` earlier readings; one result per later one.
    """
    n = len(values) - before
    count = np.minimum(np.arange(before, before + n), window)
    mean, std = np.full(n, np.nan), np.full(n, np.nan)
    short = max(0, min(n, window - before))
    for i in range(short):
        past = values[: before + i]
        if len(past):
            mean[i], std[i] = past.mean(), past.std()
    if n > short:
        first = before + short - window
        views = np.lib.stride_tricks.sliding_window_view(values[first:-1], window)
        mean[short:], std[short:] = views.mean(axis=1), views.std(axis=1)
    return count, mean, std


def with_figures(new: pd.DataFrame, cpu: list[float], mem: list[float], window: int) -> tuple[pd.DataFrame, list[float], list[float]]:
    """One stream's new rows in order with their window figures, and the readings to keep."""
    kept = []
    for column, short, old in ((CPU, "cpu", cpu), (MEM, "mem", mem)):
        values = np.concatenate([np.asarray(old, float), new[column].to_numpy(float)])
        count, mean, std = preceding_stats(values, len(old), window)
        new["history"], new[f"{short}_mean"], new[f"{short}_std"] = count, mean, std
        kept.append(values[-window:].tolist())
    return new, *kept


def figures_in_slices(
    chunks: Iterator[pd.DataFrame], order_col: str, cpu: list[float], mem: list[float], window: int, names: list[str],
) -> Iterator[tuple[pd.DataFrame, list[float], list[float]]]:
    """One stream's rows of a batch in order, a slice at a time: its columns ``names`` and the readings to keep after it.

    The rows are held once, column by column; what is computed is held for one slice only.
    """
    parts: dict[str, list[pd.Series]] = {}
    for chunk in chunks:
        for column in chunk.columns:
            parts.setdefault(column, []).append(chunk[column].copy())
    whole = {column: pd.concat(parts.pop(column), ignore_index=True) for column in list(parts)}
    order = whole[order_col].sort_values().index.to_numpy()
    for at in range(0, len(order), SLICE_ROWS):
        rows = order[at : at + SLICE_ROWS]
        new, cpu, mem = with_figures(pd.DataFrame({c: v.iloc[rows] for c, v in whole.items()}), cpu, mem, window)
        yield new[names], cpu, mem


def _figured(rows: DataFrame) -> T.StructType:
    figures = [T.StructField("history", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in FIGURES]]
    return T.StructType(rows.schema.fields + figures)


def _checked(figured: DataFrame) -> DataFrame:
    """The checks on the figures; without history these are null here as in the batch operator."""
    nan = F.lit(float("nan"))
    return with_smart_alert(with_zscores(figured.withColumns({c: F.coalesce(F.col(c), nan) for c in (CPU, MEM)})))


class LastReadings(StatefulProcessor):
    """Adds the window figures to a stream's rows; its state is a list of the last readings."""

    def __init__(self, order_col: str, names: list[str], window: int, keep_ms: int | None):
        self.order_col, self.names, self.window, self.keep_ms = order_col, names, window, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        reading = T.StructType([T.StructField("cpu", T.DoubleType()), T.StructField("mem", T.DoubleType())])
        self.last = handle.getListState("last", reading, ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        past = list(self.last.get())
        cpu, mem = [r[0] for r in past], [r[1] for r in past]
        for new, cpu, mem in figures_in_slices(rows, self.order_col, cpu, mem, self.window, self.names):
            yield new
        self.last.put(list(zip(cpu, mem)))

    def close(self) -> None:
        pass


def stateful_alerts(
    entries: DataFrame, stream_key: str, order_col: str = "line_no", carry: list[str] | None = None,
    window: int = ROLLING_WINDOW, keep_ms: int | None = None,
) -> DataFrame:
    """Streaming entries -> baseline, z-scores and smart alert per entry; needs the RocksDB state store, see ``run_stateful``.

    Within a micro-batch rows are ordered by ``order_col``; rows of a later batch come after all
    earlier ones. A stream that had no row for ``keep_ms`` milliseconds of processing time is
    forgotten and begins anew; without it readings are kept for good.
    """
    rows = entries.select(stream_key, order_col, CPU, MEM, *(carry or []))
    shape = _figured(rows)
    figured = rows.groupBy(stream_key).transformWithStateInPandas(
        LastReadings(order_col, shape.names, window, keep_ms), shape, "Append", "ProcessingTime" if keep_ms else "None"
    )
    return _checked(figured)


@contextlib.contextmanager
def settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """Queries started inside take these settings with them; the session's own are restored."""
    names = {"provider": PROVIDER, "empty_batches": EMPTY_BATCHES}
    before = {names[k]: spark.conf.get(names[k], None) for k in wanted}
    for k, value in wanted.items():
        spark.conf.set(names[k], value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_stateful(
    entries: DataFrame, stream_key: str, out: str, checkpoint: str, order_col: str = "line_no",
    carry: list[str] | None = None, available_now: bool = True, keep_ms: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """``stateful_alerts`` to Parquet files, each row once; ``finish`` is applied to them before."""
    found = stateful_alerts(entries, stream_key, order_col, carry, keep_ms=keep_ms)
    writer = (
        (finish(found) if finish else found).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    with settings(entries.sparkSession, provider=ROCKSDB, empty_batches="false"):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def keyed_alerts(
    entries: DataFrame, stream_key: str, order_col: str = "line_no",
    carry: list[str] | None = None, window: int = ROLLING_WINDOW,
) -> DataFrame:
    """As ``stateful_alerts``, with two lists of at most ``window`` readings in any state store."""
    rows = entries.select(stream_key, order_col, CPU, MEM, *(carry or []))
    shape = _figured(rows)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        cpu, mem = state.get if state.exists else ([], [])
        for new, cpu, mem in figures_in_slices(chunks, order_col, cpu, mem, window, shape.names):
            yield new
        state.update((cpu, mem))

    figured = rows.groupBy(stream_key).applyInPandasWithState(
        step, shape, "cpu array<double>, mem array<double>", "append", GroupStateTimeout.NoTimeout
    )
    return _checked(figured)


def run_keyed(
    entries: DataFrame, stream_key: str, out: str, checkpoint: str, order_col: str = "line_no",
    carry: list[str] | None = None, available_now: bool = True,
) -> StreamingQuery:
    """``keyed_alerts`` to Parquet files, each row once."""
    writer = (
        keyed_alerts(entries, stream_key, order_col, carry)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
