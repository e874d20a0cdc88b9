"""Mixing sources to target weights by systematic sampling."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.frame import col, flat, salts, unflat, with_positions
from vigilog.storage import materialize

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3.0
# Offsets drawn for each source, of which the one whose sum comes nearest the target is used.
DRAWS = 16


def targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to ``(_source, _null, source_size)``, one row for each source.

    Sources in code-point order, null last, get ``weights`` in turn and share the sum
    of all sizes. A target stops at ``most`` times its source's size and the rest goes
    to the others by weight. Filling in the order of size over weight makes that one
    pass: a source is full if its stop lies under the level that the rest would reach.
    """
    rank = F.row_number().over(Window.orderBy("_null", "_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    by_stop = everything.orderBy(F.col("_stop") / F.col("_weight"), "_null", "_source")
    left = F.sum("source_size").over(everything) - (F.sum("_stop").over(by_stop.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_stop"))
    open_weight = F.sum("_weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    levels = (
        sources.withColumn("_weight", weight).withColumn("_stop", F.col("source_size") * F.lit(most))
        .withColumn("_level", left / open_weight)
        .withColumn("_full", F.col("_stop") <= F.col("_level") * F.col("_weight"))
    )
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return levels.select(
        "_source", "_null", "source_size",
        F.when(F.col("_full"), F.col("_stop")).otherwise(F.least(F.col("_stop"), level * F.col("_weight"))).alias("target"),
    )


def mix(docs: DataFrame, size: Column, source: str = "source", weights=WEIGHTS, most: float = MOST_COPIES, seed: int = 17) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` to every row of ``docs``.

    Systematic sampling: rows of a source stand in order of falling size class; each
    expects target / source_size copies, these are prefix-summed, one offset drawn for
    the source is added, and a copy is made for each integer crossed. The order keeps
    a source's sum within about one largest row of its target; of ``DRAWS`` hashed offsets the
    one that comes nearest is used, which helps sources of few rows. No row is taken
    more than ``most`` times. Draws are hashes, so reruns agree.

    A null or negative size counts as 0; a source of size 0 takes nothing; the null
    source is a source of its own; equal rows are separate rows and differ at most in
    which of them gets a copy. An empty table gives an empty result. A result replaces
    an input column of the same name.

    Rows are written once with their sizes; all counting is done on a few narrow columns,
    and a hot source is split in cells of one size class and one hash part.
    """
    names = docs.columns
    whole = [col(c) for c in names]
    rows = docs.select(
        *flat(docs), F.coalesce(col(source).cast("string"), F.lit("")).alias("_source"), col(source).isNull().alias("_null"),
        F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("_size"),
        F.xxhash64(*whole).alias("_hash"), F.xxhash64(*whole, F.lit(seed)).alias("_draw"),
    )
    base = materialize(rows.withColumn("_number", F.monotonically_increasing_id()), "rows")
    sized = base.select("_number", "_source", "_null", "_size", "_hash", "_draw")
    sources = materialize(targets(sized.groupBy("_source", "_null").agg(F.sum("_size").alias("source_size")), weights, most), "sources")
    parts = salts(base.count())
    large_first = 1024 - F.floor(F.log2(F.col("_size") + 1.0) * 8)
    cell = (large_first * parts + F.pmod("_draw", F.lit(parts))).cast("long")
    cells = sized.withColumn("_cell", F.coalesce(cell, F.lit(0)))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0)
    placed = with_positions(cells, ["_source", "_null"], "_cell", [F.desc("_size"), F.col("_hash"), F.col("_draw")])
    placed = materialize(placed.join(sources.withColumn("_rate", rate), ["_source", "_null"]).select("_number", "_source", "_null", "_size", "_index", "_rate"), "placed")
    copies = lambda offset: F.floor((F.col("_index") + 1) * F.col("_rate") + offset) - F.floor(F.col("_index") * F.col("_rate") + offset)
    drawn = [F.pmod(F.xxhash64("_source", "_null", F.lit(seed + i)), F.lit(1 << 30)) / F.lit(float(1 << 30)) for i in range(DRAWS)]
    sums = placed.groupBy("_source", "_null").agg(*[F.sum(F.col("_size") * copies(offset)).alias(f"_sum_{i}") for i, offset in enumerate(drawn)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_sum_{i}") - F.col("target")), F.lit(i), offset.alias("offset")) for i, offset in enumerate(drawn)]))
    chosen = materialize(sources.join(sums, ["_source", "_null"]).select("_source", "_null", "source_size", "target", nearest.getField("offset").alias("_offset")), "offsets")
    taken = placed.join(chosen, ["_source", "_null"]).select("_number", "source_size", "target", copies(F.col("_offset")).cast("int").alias("_copies"))
    joined = base.join(taken, "_number")
    return unflat(joined, names, {"size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"), "copies": F.col("_copies")})


def repeated(mixed: DataFrame, names: list[str]) -> DataFrame:
    """The mixed rows themselves: each as often as ``copies`` says, with the columns ``names``."""
    return mixed.where("copies > 0").select(*[col(c) for c in names], F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).drop("_copy")
