import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilog.operators import sketches
from vigilog.operators.quantiles import exact_quantile
from vigilog.storage import scratch_path


def stored(spark, values, batches=3):
    """The values as a table and as the sketches of so many batches, one of them run twice."""
    path, folder = scratch_path(spark, "values"), scratch_path(spark, "sketches")
    spark.createDataFrame([(v, i % batches) for i, v in enumerate(values)], "x double, b int").write.parquet(path)
    table = spark.read.parquet(path)
    for b in [*range(batches), 0]:
        sketches.add_batch(table.where(F.col("b") == b), "x", folder, b)
    return table, sketches.merged(spark, folder)


def cases():
    rng = np.random.default_rng(3)
    yield "spread", rng.normal(size=30_000).tolist()
    yield "ties", (rng.integers(0, 5, 4000) / 2).tolist()
    yield "one", [2.5] * 100
    yield "odd", [None, float("nan"), float("inf"), float("-inf"), 1e300, -1e-300, 0.0, *rng.normal(size=50).tolist()]
    yield "sizes", (10.0 ** rng.uniform(-300, 300, 3000)).tolist()


@pytest.mark.parametrize("name,values", list(cases()))
def test_equal_to_the_search_over_the_whole_range(spark, name, values):
    table, summary = stored(spark, values)
    for p in (0.0, 0.05, 0.5, 1.0):
        assert sketches.quantile_by_sketch(table, "x", p, summary) == exact_quantile(table, "x", p)


def test_a_sketch_that_saw_other_rows_does_not_change_the_result(spark):
    table, _ = stored(spark, [float(i) for i in range(2000)])
    other = sketches.sketch(table.where("x < 100"), "x")
    moved = sketches.sketch(table.select((F.col("x") + 5000).alias("x")), "x")
    for summary in (other, moved):
        assert sketches.quantile_by_sketch(table, "x", 0.05, summary) == pytest.approx(99.95)


def test_estimate_and_no_values(spark):
    table, summary = stored(spark, [float(i) for i in range(20_000)])
    assert abs(sketches.sketched_quantile(summary, 0.05) - 1000) < 200
    empty, nothing = stored(spark, [None, float("nan")])
    assert sketches.sketched_quantile(nothing, 0.5) is None and sketches.quantile_by_sketch(empty, "x", 0.5, nothing) is None
