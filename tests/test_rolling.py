import random

import pytest

from tests.brute import rolling as brute
from tests.brute import same
from vigilog.operators import rolling

SCHEMA = "host string, line_no bigint, cpu_max_pct double, mem_used_pct double"


def alerts(spark, cpu, mem=None):
    mem = mem or [50.0] * len(cpu)
    rows = [("a", i + 1, float(c), float(m)) for i, (c, m) in enumerate(zip(cpu, mem))]
    df = spark.createDataFrame(rows, SCHEMA)
    return rolling.smart_alerts(df, stream_key="host").orderBy("line_no").collect()


def test_too_little_history(spark):
    last = alerts(spark, [10, 20, 30, 40, 99])[-1]
    assert (last.smart_alert, last.cpu_z, last.cpu_mean, last.cpu_std) == (0, 0.0, 99.0, 0.0)
    assert last.smart_reason == "normal"


def test_flat_history(spark):
    last = alerts(spark, [40] * 10 + [99])[-1]
    assert (last.smart_alert, last.cpu_mean) == (0, 40.0)


def test_threshold_is_strict_and_upper_only(spark):
    six = [38, 42, 38, 42, 38, 42]
    at = alerts(spark, six + [44.0])[-1]
    assert (at.cpu_z, at.cpu_mean, at.cpu_std, at.smart_alert) == (2.0, 40.0, 2.0, 0)
    over = alerts(spark, six + [44.1])[-1]
    assert over.smart_alert == 1
    assert over.smart_reason == "CPU Z=2.05 (now=44.1% vs baseline avg=40.0%±2.0)"
    assert alerts(spark, six + [20.0])[-1].smart_alert == 0


def test_window_covers_twenty_readings(spark):
    values = [90, 91, 92, 93] + [10 + i % 5 for i in range(21)]
    last = alerts(spark, values)[-1]
    assert last.history == 20 and abs(last.cpu_mean - sum(values[4:24]) / 20) < 1e-12


def test_both_reasons_cpu_first(spark):
    six = [38, 42, 38, 42, 38, 42]
    last = alerts(spark, six + [60], six + [70])[-1]
    cpu, mem = last.smart_reason.split(" | ")
    assert cpu.startswith("CPU Z=10.0 (now=60.0%") and mem.startswith("MEM Z=15.0 (now=70.0%")


def test_missing_reading_silences_the_window(spark):
    values = [38, 42] * 4 + [float("nan")] + [38, 42] * 9 + [95, 38, 95]
    got = alerts(spark, values)
    # 95 at place 28 still has the NaN among its 20 predecessors, the one at 30 not.
    assert [r.line_no for r in got if r.smart_alert == 1] == [30]
    rows = [("a", i + 1, None if v != v else v, 50.0) for i, v in enumerate(map(float, values))]
    df = spark.createDataFrame(rows, SCHEMA)
    again = rolling.smart_alerts(df, stream_key="host").where("smart_alert = 1").collect()
    assert [r.line_no for r in again] == [30]


@pytest.mark.parametrize("block_rows", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("key, dense", [("host", None), ("host", True), (None, None), (None, False)])
def test_blocks_equal_one_pass(spark, block_rows, key, dense):
    """Hot stream, thin stream, gaps longer than a block, negative order values."""
    rng = random.Random(3)
    rows, n = [], -40
    for _ in range(700):
        n += rng.choice([1, 1, 1, 2, 30])
        host = rng.choices(["hot", "b", "thin"], [0.8, 0.17, 0.03])[0]
        rows.append((host, n, round(rng.uniform(0, 100), 1), round(rng.uniform(0, 100), 1)))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {
        r.line_no: r
        for r in rolling.smart_alerts(df, stream_key=key, carry=None if key else ["host"], block_rows=block_rows, dense=dense).collect()
    }
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(r[0] if key else "all", []).append(r)
    for part in groups.values():
        cpu, mem = brute([r[2] for r in part]), brute([r[3] for r in part])
        for row, c, m in zip(part, cpu, mem):
            g = got[row[1]]
            assert g.history == c[0]
            assert all(same(x, y) for x, y in zip((g.cpu_mean, g.cpu_std, g.cpu_z), c[1:4]))
            assert all(same(x, y) for x, y in zip((g.mem_mean, g.mem_std, g.mem_z), m[1:4]))
            assert g.smart_alert == int(c[4] or m[4])


def test_result_does_not_depend_on_partitions(spark, table):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found = rolling.detections(table, block_rows=64).orderBy("line_no")
        return found.select("line_no", "cpu_z", "smart_alert").collect()

    try:
        assert run(1) == run(3) == run(11)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_one_scan_and_one_shuffle_of_the_rows(spark):
    """The tails read the shuffle output of the rows, and no data row goes to one task."""
    from checks.queries import found
    from tests.conftest import SF
    from vigilog.operators.evaluate import compare_detectors

    df = compare_detectors(found(spark, SF, block_rows=64))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1
    assert plan.count("ReusedExchange") == 1
    # SinglePartition: one row for each thousand blocks, and the final one-row aggregate.
    assert plan.count("SinglePartition") == 2


def test_static_alert(spark):
    rows = [("a", 1, 80.0, 85.0), ("a", 2, 80.1, 0.0), ("a", 3, 0.0, 85.1), ("a", 4, float("nan"), None)]
    got = rolling.with_static_alert(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.static_alert for r in got] == [0, 1, 1, 0]


def test_blocks_are_filled_and_bounded(spark):
    """A stream on every 50th order value gets few, full blocks; small streams get one."""
    rows = spark.range(20_000).selectExpr(
        "case when id % 50 = 7 then 'rare' when id % 5000 = 3 then 'tiny' else 'hot' end as host",
        "id as line_no", "1D as cpu_max_pct", "1D as mem_used_pct",
    )
    widths = {r["_stream"]: r["_width"] for r in rolling.block_widths(rows, "host", "line_no", 100).collect()}
    assert widths == {"rare": 5000, "hot": 100}
    done = rolling.with_baseline(rows, "host", block_rows=100)
    assert done.count() == 20_000
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastNestedLoopJoin" in plan


def test_null_stream_key(spark):
    rows = [(None, i, float(i % 7), 1.0) for i in range(60)] + [("a", i, float(i % 5), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for block_rows in (8, 1000):
        got = rolling.with_baseline(df, "host", block_rows=block_rows).collect()
        assert len(got) == 120
        assert sorted(r.history for r in got if r.host is None) == sorted(min(i, 20) for i in range(60))


def test_filter_on_alerts_does_not_repeat_the_statistics(spark, table):
    alerts = rolling.smart_alerts(table).where("smart_alert = 1")
    plan = alerts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sqrt(") + plan.count("SQRT(") == 2


def test_many_large_streams_join_without_broadcast(spark, table, monkeypatch):
    want = rolling.with_baseline(table, "host_id", block_rows=16).orderBy("line_no").collect()
    monkeypatch.setattr(rolling, "MAX_BROADCAST_STREAMS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = rolling.with_baseline(table, "host_id", block_rows=16)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.orderBy("line_no").collect() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["host_id", None])
def test_tails_are_handed_on_from_span_to_span(spark, table, monkeypatch, key):
    """Spans of few thin blocks give what one span gives; readings come from several spans back."""
    rows = lambda: rolling.with_baseline(table, key, block_rows=3, carry=None if key else ["host_id"]).orderBy("line_no").collect()
    want = rolling.with_baseline(table, key, carry=None if key else ["host_id"]).orderBy("line_no").collect()
    assert rows() == want
    for fan in (1, 2, 5):
        monkeypatch.setattr(rolling, "FAN", fan)
        assert rows() == want
