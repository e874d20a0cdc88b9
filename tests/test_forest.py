import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilog.operators import forest
from vigilog.operators.quantiles import exact_quantile, value_at_rank
from vigilog.schema import FEATURES
from vigilog.sinks.tables import write_model
from vigilog.sources.tables import read_model
from vigilog.storage import scratch_path


@pytest.fixture(scope="module")
def model(table):
    return forest.fit_forest(table, ["line_no"])


def test_scaler_is_population_and_guards_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "a double, b double")
    got = {r.feature: (r.mean, r.scale) for r in forest.fit_scaler(df, ["a", "b"]).collect()}
    assert got["a"] == (2.0, pytest.approx(math.sqrt(2 / 3)))
    assert got["b"] == (pytest.approx(10 / 3), pytest.approx(np.std([5, 5, 0])))
    flat = spark.createDataFrame([(4.0,), (4.0,)], "a double")
    scaled = forest.apply_scaler(flat, forest.fit_scaler(flat, ["a"]), ["a"])
    assert [r.a for r in scaled.collect()] == [0.0, 0.0]


def test_trees_are_sound(table, model):
    n = table.count()
    nodes = model.nodes.toPandas()
    assert sorted(nodes["tree"].unique()) == list(range(100))
    roots = nodes[nodes["node"] == 0]
    assert (roots["size"] == min(256, n)).all()
    leaves = nodes[nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == min(256, n)).all()
    assert (nodes.groupby("tree").size() <= 2 * 256 - 1).all()
    assert leaves["path"].max() <= 8 + forest.average_path(256)


def test_scores_equal_a_plain_walk(table, model):
    scaled = forest.apply_scaler(table, model.scaler)
    rows = forest.with_score(table, model).select("line_no", "score").orderBy("line_no").limit(40).collect()
    xs = {r.line_no: r for r in scaled.where(F.col("line_no") <= rows[-1].line_no).collect()}
    trees = {t: g.set_index("node") for t, g in model.nodes.toPandas().groupby("tree")}
    for r in rows:
        x = [xs[r.line_no][c] for c in FEATURES]
        total = 0.0
        for g in trees.values():
            node = g.loc[0]
            while node["feature"] >= 0:
                side = "left" if x[int(node["feature"])] <= node["threshold"] else "right"
                node = g.loc[int(node[side])]
            total += node["path"]
        want = -(2 ** (-(total / len(trees)) / forest.average_path(256)))
        assert r.score == pytest.approx(want, abs=1e-12)


def test_flags_the_share_and_finds_spikes(table, model):
    scored = forest.with_score(table, model)
    offset = model.meta["offset"]
    flagged = scored.withColumn("iso", forest.iso_flag(F.col("score"), offset))
    got = flagged.agg(
        F.count("*").alias("n"), F.sum("iso").alias("flagged"), F.min("score").alias("lo"),
        F.max("score").alias("hi"), F.sum(F.col("iso") * F.col("is_anomaly")).alias("hits"),
        F.sum("is_anomaly").alias("labelled"),
    ).first()
    assert -1 < got.lo < got.hi < 0
    assert got.flagged == math.ceil(0.05 * (got.n - 1))
    # Spikes are 4 % of the rows; chance alone would flag 5 % of them.
    assert got.hits > 0.25 * got.labelled


def test_same_forest_for_any_partitioning(table, model):
    again = forest.fit_forest(table.repartition(7, "top_pid"), ["line_no"])
    order = ["tree", "node"]
    a = model.nodes.orderBy(*order).collect()
    b = again.nodes.orderBy(*order).collect()
    assert [(r.tree, r.node, r.feature, r.size) for r in a] == [(r.tree, r.node, r.feature, r.size) for r in b]
    assert again.meta["offset"] == pytest.approx(model.meta["offset"], abs=1e-9)
    other = forest.fit_forest(table, ["line_no"], seed=7)
    assert other.meta["offset"] != model.meta["offset"]


def test_pool_bounds_the_sample(spark):
    """A table far larger than the pool still gives every tree its full sample."""
    df = spark.range(60_000).select(
        F.col("id").alias("line_no"), *[F.rand(i).alias(c) for i, c in enumerate(FEATURES)]
    )
    nodes = forest.fit_nodes(df, ["line_no"], 60_000, trees=5, sample=64)
    assert nodes.where("node = 0 and size = 64").count() == 5


def test_ids_must_identify_rows(spark):
    df = spark.range(200).select(F.lit(None).cast("int").alias("k"), *[F.rand(1).alias(c) for c in FEATURES])
    nodes = forest.fit_nodes(df, ["k"], 50, trees=2, sample=64)  # count off: too many rows
    assert nodes.where("node = 0").count() == 2
    with pytest.raises(ValueError):
        forest.fit_nodes(df.limit(10), ["k"], 50, trees=2, sample=64)


def test_small_and_empty_tables(spark, table):
    few = table.limit(3)
    model = forest.fit_forest(few, ["line_no"], trees=10)
    assert forest.with_score(few, model).where("score < 0 and score > -1.0001").count() == 3
    with pytest.raises(ValueError):
        forest.fit_forest(table.limit(0), ["line_no"])


def test_model_round_trip(spark, table, model):
    path = scratch_path(spark, "model")
    assert read_model(spark, path) is None
    write_model(model, path)
    loaded = read_model(spark, path)
    assert loaded.meta == model.meta
    a = forest.with_score(table, model).select("line_no", "score").orderBy("line_no").collect()
    assert a == forest.with_score(table, loaded).select("line_no", "score").orderBy("line_no").collect()


def test_scoring_jobs(spark, table, model):
    from checks.inputs import log_lines
    from tests.conftest import SF
    from vigilog.operators.rolling import smart_alerts
    from vigilog.operators.stats import verdict_totals
    from vigilog.plans import scoring

    history = scoring.scored_history(table, model, block_rows=128).cache()
    assert history.count() == table.count()
    smart = {r.line_no: r.smart_alert for r in smart_alerts(table, reason=False).collect()}
    for r in history.collect():
        assert r.smart_alert == smart[r.line_no]
        assert r.is_anomaly == int(r.iso_anomaly or r.smart_alert)
        assert r.label == ("ANOMALY" if r.is_anomaly else "NORMAL")
        assert (r.smart_reason == "normal") == (r.smart_alert == 0)
    totals = verdict_totals(history).first()
    assert totals.total == totals.normals + totals.anomalies
    scored, refused = scoring.score_lines(log_lines(spark, SF), model, block_rows=128)
    assert scored.count() == 920 and refused.count() == 80
    assert {r.error for r in refused.collect()} == {"raw_log field is required", "Could not parse log line"}
    from checks.queries import event_stream, lines_of
    from vigilog.functions.parse import parse_lines

    paths = [scratch_path(spark, x) for x in ("out", "progress")]
    scoring.run_scored_stream(
        parse_lines(lines_of(event_stream(spark, SF))), model, "host_id", *paths
    ).awaitTermination()
    columns = ["line_no", "score", "iso_anomaly", "smart_alert", "smart_reason", "is_anomaly", "label"]
    live = spark.read.option("recursiveFileLookup", True).parquet(paths[0]).select(*columns)
    stored = scoring.scored_entries(table, model, "host_id").select(*columns)
    assert live.orderBy("line_no").collect() == stored.orderBy("line_no").collect()

    first = scoring.first_scored(scoring.scored_entries(table, model)).collect()
    assert len(first) == 5 and {r.smart_label for r in first} <= {"ANOMALY", "NORMAL"}


@pytest.mark.parametrize("p", [0.0, 0.05, 0.333, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, p):
    rng = np.random.default_rng(4)
    values = {
        "spread": rng.normal(size=3001),
        "ties": rng.integers(0, 5, 1000).astype(float),
        "outlier": np.append(rng.normal(size=500), 1e15),
        "one": np.array([3.5]),
        "same": np.full(10, -2.0),
    }
    for name, v in values.items():
        df = spark.createDataFrame([(float(x),) for x in v], "x double").repartition(3)
        assert exact_quantile(df, "x", p) == pytest.approx(np.quantile(v, p), rel=1e-12), name


def test_value_at_rank(spark):
    df = spark.range(5000).select((F.col("id") * 3 - 900).alias("x"))
    for rank in (0, 1, 4095, 4096, 4999):
        assert value_at_rank(df, "x", rank) == rank * 3 - 900
    assert value_at_rank(df, "x", 5000) is None
    assert value_at_rank(df.limit(0), "x", 0) is None


def test_filter_on_the_score_runs_python_once(table, model):
    low = forest.with_score(table, model).where("score < -0.6")
    plan = low._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
