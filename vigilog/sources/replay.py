"""Stored log lines replayed as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vigilog.sources.text import read_log
from vigilog.storage import scratch

LINE_SCHEMA = T.StructType(
    [T.StructField("line_no", T.LongType()), T.StructField("value", T.StringType())]
)


def replay_lines(
    spark: SparkSession, path: str, max_files: int | None = None, schema: T.StructType = LINE_SCHEMA
) -> DataFrame:
    """Stream over a folder of numbered lines (Parquet).

    ``max_files`` bounds a micro-batch, the counterpart of a full buffer making
    the sender wait.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def replay_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream over a folder of text files; ``value`` only, without line numbers."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def replay_log(
    spark: SparkSession, path: str | list[str], inbox: str, max_files: int | None = None
) -> DataFrame:
    """Stream over raw log files, each line with its file and number.

    A line's number depends on all lines before it, so the files are numbered once into
    ``inbox`` (Parquet) and replayed from there.
    """
    with scratch(spark):
        read_log(spark, path).write.mode("overwrite").parquet(inbox)
    fields = [T.StructField("file", T.StringType()), *LINE_SCHEMA.fields]
    return replay_lines(spark, inbox, max_files, T.StructType(fields))
