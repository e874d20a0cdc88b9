import random

import numpy as np
from pyspark.sql import functions as F

from tests.test_parse import line
from vigilog.functions import lines as L
from vigilog.functions.numeric import deviation_sql, float_text, mean_sql, round_exact
from vigilog.functions.parse import parse_lines
from vigilog.operators import labels
from vigilog.operators.inject import inject_anomalies


def test_round_exact_agrees_with_python(spark):
    rng = random.Random(5)
    xs = [2.675, 0.125, 0.375, -0.125, 10.275, 1.005, 0.5, 1.5, 2.5, -2.5, 0.0, 1e-9, 99.995, 123456789.125]
    xs += [rng.uniform(-1000, 1000) for _ in range(2000)]
    xs += [rng.randrange(-10**6, 10**6) / 1000 for _ in range(2000)]
    xs += [rng.randrange(-10**5, 10**5) / 16 for _ in range(1000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", *[round_exact("x", d).alias(f"r{d}") for d in range(5)]).collect()
    assert len(got) == len(xs)
    for r in got:
        for d in range(5):
            assert r[f"r{d}"] == round(r.x, d), (r.x, d)


def test_round_exact_special_values(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1e300,)], "x double")
    got = [r[0] for r in df.select(round_exact("x", 2)).collect()]
    assert np.isnan(got[0]) and got[1] is None and got[2] == 1e300


def test_display_text(spark):
    df = spark.createDataFrame([(0.25,), (44.0,), (12345678.94,), (None,), (0.05,)], "x double")
    assert [r[0] for r in df.select(labels.one_decimal("x")).collect()] == ["0.3", "44.0", "12345678.9", "—", "0.1"]
    big = spark.createDataFrame([(12345678.9,), (1e7,), (2.05,), (99.0,)], "x double")
    assert [r[0] for r in big.select(float_text("x")).collect()] == ["12345678.9", "10000000.0", "2.05", "99.0"]


def test_line_round_trip(spark):
    df = parse_lines(spark.createDataFrame([(1, line())], "line_no bigint, value string"))
    proc = F.format_string("pid=%d name=%s cpu=%s%%", "top_pid", "top_proc_name", F.col("top_proc_cpu").cast("string"))
    again = L.metric_lines(df.withColumn("top_proc", proc))
    assert again.first().value == line()


def test_units_and_severity(spark):
    df = spark.createDataFrame([(None, "NORMAL"), (3 * 1048576 + 524288, "ANOMALY:X")], "b bigint, status string")
    got = L.with_megabytes(df, {"mb": ("b", 2)}).select("mb", L.severity(F.col("status"))).collect()
    assert [tuple(r) for r in got] == [(0.0, "INFO"), (3.5, "WARNING")]


def test_fill_and_filters(spark):
    df = spark.createDataFrame(
        [(float("nan"), None, 1), (None, "Python3", 0), (2.0, "bash", 0)],
        "cpu_max_pct double, top_proc_name string, is_anomaly int",
    )
    assert [r[0] for r in labels.fill_features(df, ["cpu_max_pct"]).collect()] == [0.0, 0.0, 2.0]
    assert [r[0] for r in labels.fill_records(df).collect()] == ["", "", "2.0"]
    assert labels.process_search(df, "PYTH").count() == 1
    assert labels.process_search(df, "").count() == 3
    assert [labels.label_filter(df, w).count() for w in ("anomaly", "normal", "all", "other")] == [1, 2, 3, 3]


def test_injection_is_repeatable_and_near_its_rate(spark):
    base = spark.range(20_000).select(
        F.col("id").alias("line_no"), F.array(F.lit(1.0), F.lit(2.0)).alias("cpu_cores"),
        F.lit(30.0).alias("mem_used_pct"), F.lit("NORMAL").alias("status"),
    )
    a = inject_anomalies(base, ["line_no"]).orderBy("line_no").collect()
    b = inject_anomalies(base.repartition(7), ["line_no"]).orderBy("line_no").collect()
    assert a == b
    cpu = [r for r in a if r.status == "ANOMALY:CPU_SPIKE"]
    mem = [r for r in a if r.status == "ANOMALY:MEM_SPIKE"]
    assert 0.04 < (len(cpu) + len(mem)) / len(a) < 0.06 and 0.4 < len(cpu) / (len(cpu) + len(mem)) < 0.6
    assert all(95 <= r.cpu_cores[0] <= 100 and r.cpu_cores[1] == 2.0 and r.mem_used_pct == 30.0 for r in cpu)
    assert all(92 <= r.mem_used_pct <= 99 and r.cpu_cores == [1.0, 2.0] for r in mem)


def test_window_figures_equal_numpy_to_the_last_bit(spark):
    rng = random.Random(8)
    for usual in (3, 20, 37):
        lists = [[round(rng.uniform(0, 100), 1) for _ in range(n)] for n in range(1, usual + 1) for _ in range(20)]
        df = spark.createDataFrame([(x,) for x in lists], "h array<double>")
        got = df.selectExpr("h", f"{mean_sql('h', usual)} as m").selectExpr(
            "h", "m", f"{deviation_sql('h', 'm', usual)} as s"
        )
        for r in got.collect():
            assert (r.m, r.s) == (np.mean(r.h), np.std(r.h)), len(r.h)
    empty = spark.createDataFrame([([],)], "h array<double>")
    assert empty.selectExpr(f"{mean_sql('h', 20)} as m").first().m is None
