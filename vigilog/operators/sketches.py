"""Quantiles of values that keep arriving: mergeable sketches by batch, made exact by a scan or two."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators.quantiles import BUCKETS, _numbers, _search, _slot, exact_quantile, interpolated, place_of

SCHEMA = "n bigint, sketch binary"
K = 800
# A sketch of ``K`` misses a rank by less than this share of the rows but for rare cases, which cost more scans.
MARGIN = 0.006


def sketch(df: DataFrame, column: str) -> DataFrame:
    """One row: count and KLL sketch of ``column``; nulls and NaN have no rank, infinities do."""
    x = F.col(column).cast("double")
    return _numbers(df, column).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(x, K).alias("sketch"))


def add_batch(df: DataFrame, column: str, folder: str, batch_id: int) -> None:
    """Stores the sketch of a micro-batch; one that is run again replaces its own."""
    sketch(df, column).coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """One row for all batches; of each, its sketch is read (some 20 kB) and none of its values."""
    stored = spark.read.schema(SCHEMA).parquet(f"{folder}/batch=*")
    return stored.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.kll_merge_agg_double("sketch", K).alias("sketch"))


def sketched_quantile(summary: DataFrame, p: float) -> float | None:
    """The sketch's own estimate, without looking at the values; None if there are none."""
    if not summary.first().n:
        return None
    return summary.select(F.kll_sketch_get_quantile_double("sketch", F.lit(p))).first()[0]


def quantile_by_sketch(df: DataFrame, column: str, p: float, summary: DataFrame) -> float | None:
    """As ``exact_quantile``, with the search begun between the bounds that ``summary`` gives for the rank.

    ``df`` holds all values the sketches have seen. One scan counts the rows below the
    bounds and in slices between them; mostly one more ends the search. Should the rank
    lie outside the bounds, or the sketches have seen other rows, the search over the whole
    range decides, so the result never depends on the sketch.
    """
    total = summary.first().n
    if not total:
        return exact_quantile(df, column, p)
    rank, part = place_of(total, p)
    at = [min(1.0, max(0.0, rank / total + side * MARGIN)) for side in (-1, 1)]
    lo, hi = summary.select(*[F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"q{i}") for i, q in enumerate(at)]).first()
    x = F.col(column).cast("double")
    slot = F.when(x < lo, -1).when(x > hi, BUCKETS).otherwise(_slot(x, lo, hi) if lo < hi else F.lit(0))
    place = F.when(x < lo, 0).when(x > hi, 2).otherwise(1)
    numbers = _numbers(df, column)
    # At most BUCKETS slices and the two sides.
    slots = (
        numbers.groupBy(place.alias("place"), slot.alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).orderBy("lo").collect()
    )
    if sum(s.n for s in slots) != total:
        return exact_quantile(df, column, p)
    below = 0
    for i, s in enumerate(slots):
        if rank < below + s.n:
            break
        below += s.n
    if rank == below + s.n - 1:
        return interpolated(s.hi, slots[i + 1].lo if i + 1 < len(slots) else None, part)
    if s.place != 1 and s.lo < s.hi:
        return exact_quantile(df, column, p)
    return interpolated(*_search(numbers.withColumn(column, x), column, rank, s.lo, s.hi, below), part)
