"""Results that must not depend on size, ties, odd numbers or leftovers."""

import csv
import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vigilog import storage
from vigilog.functions.numeric import float_text
from vigilog.operators import forest, paging, stats
from vigilog.operators.quantiles import exact_quantile, value_at_rank
from vigilog.schema import FEATURES, TABLE_SCHEMA
from vigilog.sinks.tables import write_entries
from vigilog.sources.tables import read_entries


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantiles_of_odd_numbers(spark, p):
    rng = np.random.default_rng(1)
    finite = [*map(float, 10.0 ** rng.integers(-300, 300, 400) * rng.choice([-1, 1], 400)), 0.0, -0.0, 5e-324, 1.7e308, -1.7e308]
    with np.errstate(all="ignore"):
        want = np.quantile(np.array(finite) / 4, p) * 4
    assert exact_quantile(doubles(spark, [*finite, math.nan, None]), "x", p) == pytest.approx(want, rel=1e-9)
    every = sorted([*finite, -math.inf, math.inf, math.inf])
    for rank in (0, 1, len(every) // 2, len(every) - 3, len(every) - 2, len(every) - 1):
        assert value_at_rank(doubles(spark, [*every, math.nan]), "x", rank) == every[rank]


def test_median_with_a_missing_number(spark):
    assert exact_quantile(doubles(spark, [*map(float, range(100)), math.nan]), "x", 0.5) == 49.5
    assert exact_quantile(doubles(spark, [math.nan, None]), "x", 0.5) is None
    assert exact_quantile(doubles(spark, [math.inf, math.inf, 1.0]), "x", 0.5) == math.inf


@pytest.mark.parametrize("order", ["line_no", ["file", "line_no"], ["line_no", "file"], ["file"]])
def test_pages_are_the_table(spark, order):
    rows = [(f"f{i % 3}" if i % 11 else None, i // 3 % 20, i) for i in range(130)] + [("f1", None, 500)]
    df = spark.createDataFrame(rows, "file string, line_no bigint, id bigint").withColumn("is_anomaly", F.lit(0)).repartition(5)
    for shallow in (-1, 7, 1000):
        got = [r.id for page in range(1, 15) for r in paging.page_of_records(df, page, 10, order_col=order, shallow_rows=shallow).collect()]
        assert sorted(got) == sorted(r[2] for r in rows), (order, shallow)
        if shallow == -1:
            first = got
        assert got == first


def test_number_text_is_plain(spark):
    values = [0.0005, 0.0001, 12345678.123456, 1e7, 123456789012345.6, 0.1, 99.0, 2.05, 0.0, 1e15, 4321.000001]
    texts = [r[0] for r in doubles(spark, values).coalesce(1).select(float_text("x"), "x").orderBy("x").collect()]
    assert texts == [repr(v) for v in sorted(values)]


def test_unknown_types_are_no_key(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, 2.0), (1, "CPU_SPIKE", 1.0, 2.0), (0, None, 1.0, 2.0)], "is_anomaly int, anomaly_type string, cpu_max_pct double, mem_used_pct double"
    )
    row = stats.stats_summary(df).first()
    assert row.anomaly_types == {"CPU_SPIKE": 1} and (row.total, row.anomalies) == (3, 2)


def test_csv_of_another_writer(spark, tmp_path, table):
    statuses = ['a"b', "x,\\", '\\"q,', 'say ""', "plain", "\\"]
    entry = table.select(*TABLE_SCHEMA.names).first().asDict()
    with open(tmp_path / "in.csv", "w", newline="") as f:
        out = csv.DictWriter(f, TABLE_SCHEMA.names)
        out.writeheader()
        out.writerows({**entry, "line_no": i, "status": s} for i, s in enumerate(statuses))
    read = read_entries(spark, str(tmp_path / "in.csv"), "csv")
    assert {r.line_no: r.status for r in read.collect()} == dict(enumerate(statuses))
    write_entries(read, str(tmp_path / "out"), "csv")
    parts = [p for p in os.listdir(tmp_path / "out") if p.endswith(".csv")]
    back = {}
    for p in parts:
        with open(tmp_path / "out" / p, newline="") as f:
            back |= {int(r["line_no"]): r["status"] for r in csv.DictReader(f)}
    assert back == dict(enumerate(statuses))


@pytest.mark.parametrize("rows", [300, 40_000])
def test_trees_draw_from_the_whole_table(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("line_no"), *[(F.xxhash64("id", F.lit(c)) % 1000).cast("double").alias(c) for c in FEATURES])
    picked = forest._tree_samples(df, ["line_no"], min(1.0, (1.6 * 256 + 40) / rows), 256, 100, 7)
    counts = {r.tree: r["count"] for r in picked.groupBy("tree").count().collect()}
    assert counts == {t: 256 for t in range(100)}
    again = forest._tree_samples(df.repartition(7), ["line_no"], min(1.0, (1.6 * 256 + 40) / rows), 256, 100, 7)
    key = lambda d: {(r.tree, r.line_no) for r in d.select("tree", "line_no").collect()}
    assert key(picked) == key(again) and len(key(picked)) == 25_600
    # Every part of the table is drawn about alike, by early trees and late ones.
    spread = picked.groupBy((F.col("tree") / 50).cast("int"), (F.col("line_no") * 10 / rows).cast("int")).count().agg(F.min("count"), F.max("count")).first()
    assert spread[0] > 1080 and spread[1] < 1480


def held(spark):
    root = f"{storage.shared_root(spark)}/vigilog"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_no_folder_is_left(spark, table, tmp_path):
    from checks.inputs import log_lines
    from vigilog.plans import batch
    from vigilog.streaming import baseline

    before = held(spark)
    model = forest.fit_forest(table, ["line_no"], trees=5, sample=32)
    assert held(spark) == before and forest.with_score(table, model).count() == 920
    log_lines(spark, SF).orderBy("line_no").coalesce(1).select("value").write.text(str(tmp_path / "log"))
    out = str(tmp_path / "out")
    result = batch.run(spark, str(tmp_path / "log"), out)
    assert held(spark) == before and result.table.count() == 920
    names = "csv sample model report scored forest_matrix forest_classes counts extremes types".split()
    assert all(os.path.isdir(f"{out}/{n}") for n in names)
    matrix = spark.read.parquet(f"{out}/forest_matrix").first()
    assert sum(matrix) == 920 and matrix.fn + matrix.tp == 40
    assert spark.read.parquet(f"{out}/counts").first().total == 920
    rows = spark.range(200).select(F.lit("h").alias("host"), F.col("id").alias("line_no"), F.lit(1.0).alias("cpu_max_pct"), F.lit(2.0).alias("mem_used_pct"))
    rows.repartition(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    baseline.run_stateful(stream, "host", str(tmp_path / "found"), str(tmp_path / "progress")).awaitTermination()
    assert held(spark) == before and spark.read.parquet(str(tmp_path / "found")).count() == 200


def test_idle_streams_are_forgotten(spark, tmp_path):
    """With a time to live a stream that paused begins anew, over restarts; without one it goes on."""
    from vigilog.streaming import baseline

    shape, n = "host string, line_no bigint, cpu_max_pct double, mem_used_pct double", 0
    for part in range(3):
        rows = []
        for host in ["busy", "paused"] if part != 1 else ["busy"]:
            for _ in range(25):
                n += 1
                rows.append((host, n, float(n % 17), 1.0))
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if part:
            time.sleep(3)
        for name, keep in (("kept", None), ("short", 2000)):
            stream = spark.readStream.schema(shape).parquet(str(tmp_path / "in"))
            baseline.run_stateful(stream, "host", str(tmp_path / name), str(tmp_path / f"{name}-progress"), keep_ms=keep).awaitTermination()
    for name, starts in (("kept", {"busy": 1, "paused": 1}), ("short", {"busy": 3, "paused": 2})):
        got = spark.read.parquet(str(tmp_path / name))
        assert got.count() == 125
        assert {r.host: r["count"] for r in got.where("history = 0").groupBy("host").count().collect()} == starts
    assert spark.conf.get(baseline.PROVIDER, None) != baseline.ROCKSDB
