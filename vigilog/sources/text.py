"""Raw log text with physical line numbers."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilog.storage import materialize

# A split row is four longs; this many stay well below 200 MB when broadcast.
MAX_BROADCAST_SPLITS = 1_000_000


def read_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line_no, value``: every line of every file, numbered from 1 per file.

    Pass one counts the lines of each input split; the prefix sums of those
    counts are a small table (one row per split). Pass two adds a line's place
    in its split. No line is shuffled or sorted.

    Both passes have to see the same splits. Where executors come and go, set
    ``spark.sql.files.minPartitionNum`` so that the split size does not follow
    their number; a difference ends the job with an error instead of giving
    wrong numbers.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_block_length").alias("_length"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    split_id = F.xxhash64("file", "_start", "_length").alias("_split")
    earlier = (
        Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = materialize(
        raw.groupBy("file", "_start", "_length")
        .agg(F.count(F.lit(1)).alias("_lines"), F.min("_pos").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
        .select(
            split_id, "_first", (F.col("_first") + F.col("_lines") - 1).alias("_last"), "_before"
        ),
        "splits",
    )
    if splits.count() <= MAX_BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    rows = raw.select("value", "file", "_pos", split_id.alias("_row_split"))
    here = (F.col("_row_split") == F.col("_split")) & F.col("_pos").between(
        F.col("_first"), F.col("_last")
    )
    line_no = F.when(
        F.col("_split").isNull(), F.raise_error(F.lit("input splits changed between passes"))
    ).otherwise(F.col("_before") + F.col("_pos") - F.col("_first") + 1)
    return rows.join(splits, here, "left").select(
        "file", line_no.cast("bigint").alias("line_no"), "value"
    )
