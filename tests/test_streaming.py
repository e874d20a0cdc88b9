import tracemalloc
import types

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.brute import rolling as brute
from tests.brute import same
from tests.conftest import SF
from vigilog.sources import kafka
from vigilog.sources.replay import replay_lines, replay_text
from vigilog.storage import scratch_path
from vigilog.streaming import alerts, baseline


def arrivals(spark, parts, start):
    """Store each part in turn and run the query over it, restarting every time."""
    inbox = scratch_path(spark, "in")
    for part in parts:
        df = spark.createDataFrame(part, "host string, line_no bigint, cpu_max_pct double, mem_used_pct double")
        df.write.mode("append").parquet(inbox)
        start(replay_lines(spark, inbox, schema=df.schema)).awaitTermination()


def start_stateful(spark, out):
    progress = scratch_path(spark, "progress")
    return lambda s: baseline.run_stateful(s, "host", out, progress)


def start_keyed(spark, out):
    progress = scratch_path(spark, "progress")
    return lambda s: baseline.run_keyed(s, "host", out, progress)


@pytest.mark.parametrize("start", [start_stateful, start_keyed])
def test_rolling_stream_over_restarts(spark, start):
    """Hot and thin streams, one that pauses, and rows that come a batch too late."""
    parts, n = [], 0
    for b in range(5):
        rows = []
        for i in range(60):
            n += 1
            host = "thin" if i % 29 == 0 else "pause" if b in (0, 4) and i % 3 == 0 else "hot"
            rows.append((host, n, float((n * 37) % 90) + (60 if n % 41 == 0 else 0), float((n * 11) % 50)))
        parts.append(rows)
    late = parts[2].pop(10)
    parts[3].append(late)
    out = scratch_path(spark, "out")
    arrivals(spark, parts, start(spark, out))
    got = spark.read.option("recursiveFileLookup", True).parquet(out).collect()
    assert len(got) == 300 and len({r.line_no if r.line_no else None for r in got}) >= 299
    order = [r for part in parts for r in sorted(part, key=lambda r: r[1])]
    for host in ("hot", "thin", "pause"):
        mine = [r for r in order if r[0] == host]
        want = brute([r[2] for r in mine])
        alerts_by_value = {}
        for r in got:
            if r.host == host:
                alerts_by_value.setdefault((r.cpu_max_pct, r.mem_used_pct), []).append(r)
        for row, w in zip(mine, want):
            found = alerts_by_value[(row[2], row[3])]
            assert any(
                g.history == w[0] and same(g.cpu_mean, w[1]) and same(g.cpu_std, w[2]) and same(g.cpu_z, w[3])
                for g in found
            ), (row, w, found)


def test_alert_stream_counts_and_restart(spark):
    from checks.inputs import log_lines
    from checks.queries import envelopes

    lines = log_lines(spark, SF).select("line_no", "value")
    inbox, out, progress = (scratch_path(spark, x) for x in ("in", "out", "progress"))

    def run():
        query = alerts.run_alerts(envelopes(replay_lines(spark, inbox, max_files=1)), out, progress)
        query.awaitTermination()
        return query

    def totals():
        return alerts.stream_counts(spark, alerts.counts_path(progress)).first()

    lines.where("line_no <= 400").repartition(3).write.parquet(inbox)
    first = run()
    assert len(first.recentProgress) >= 3  # one file at a time
    lines.where("line_no > 400").write.mode("append").parquet(inbox)
    run()
    run()  # nothing new
    stored = spark.read.parquet(out)
    assert stored.count() == 920 and stored.select("kafka_offset").distinct().count() == 920
    assert stored.where("is_anomaly = 1").count() == 40
    both = totals()
    assert (both.received, both.parsed, both.anomalies) == (960, 920, 40)  # 40 blank or header lines are not sent
    assert both.rate > 0 and both.seconds > 0


def test_text_replay(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\n\ny\n")
    query = replay_text(spark, str(tmp_path)).writeStream.format("memory").queryName("texts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.value for r in spark.table("texts").collect()) == ["", "x", "y"]


def test_message_stream_end_to_end(spark):
    """JSON messages on disk stand in for the broker."""
    from checks.inputs import log_lines
    from checks.queries import envelopes

    inbox = scratch_path(spark, "messages")
    kafka.to_messages(envelopes(log_lines(spark, SF))).write.text(inbox)
    out = scratch_path(spark, "found")
    opened = kafka.open_envelopes(spark.readStream.text(inbox))
    alerts.run_alerts(opened, out, scratch_path(spark, "progress")).awaitTermination()
    assert spark.read.parquet(out).where(F.col("is_anomaly") == 1).count() == 40


def test_messages_sent_twice_are_stored_once(spark):
    """Repeats within a batch, in a later batch and after a restart, also of null keys and times."""
    shape = "line_no bigint, raw_log string, sent_at double, producer bigint, topic string"
    line = (
        "2026-05-22 18:33:44 | INFO     | CPU:[12.3] MEM_PCT:23.4 MEM_AVAIL:1.0MB DISK_R:0.1MB DISK_W:0.4MB NET_S:1.0MB NET_R:3.0MB "
        "TOP_PROC:pid=1 name=x cpu=4.0% STATUS:NORMAL"
    )
    rows = [(i, line, 1000.0 + i, 7, "t") for i in range(30)] + [(i, line, 1000.0, 8, "t") for i in range(3)] + [(None, line, None, 7, "t")]
    inbox, out, progress = (scratch_path(spark, x) for x in ("in", "out", "progress"))
    for part in (rows[:20] + rows[:5], rows[10:], rows):
        spark.createDataFrame(part, shape).repartition(2).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(inbox)
        alerts.run_alerts(alerts.sent_once(stream, "1 hour"), out, progress).awaitTermination()
    got = spark.read.parquet(out).select("producer_pid", "kafka_offset").collect()
    assert len(got) == len(set(got)) == 34
    assert alerts.stream_counts(spark, alerts.counts_path(progress)).first().received == 34


def test_a_repeat_by_the_broker_is_known_by_its_offset(spark):
    shape = "line_no bigint, raw_log string, sent_at double, producer bigint, broker_topic string, broker_partition int, broker_offset bigint"
    rows = [(1, "x", 1.0, 7, "t", p, o) for p in range(2) for o in range(5)]
    inbox, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    spark.createDataFrame(rows + rows[:4], shape).write.parquet(inbox)
    key = ("broker_topic", "broker_partition", "broker_offset")
    once = alerts.sent_once(spark.readStream.schema(shape).parquet(inbox), "1 hour", key)
    once.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 10


@pytest.mark.parametrize("before", [0, 3])
def test_window_figures_take_little_more_than_the_rows(before):
    """Figures of 300,000 rows of one stream, in slices as over the whole, within three times the memory of the rows."""
    n, names = 300_000, ["line_no", "cpu_max_pct", "mem_used_pct", "score", "history", *baseline.FIGURES]
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"line_no": rng.permutation(n), "cpu_max_pct": rng.random(n), "mem_used_pct": rng.random(n), "score": rng.random(n)})
    rows.loc[rng.integers(0, n, 50), "mem_used_pct"] = np.nan
    past = rng.random((2, before)).tolist()
    state = types.SimpleNamespace(get=lambda: iter(list(zip(*past))), put=lambda readings: kept.extend(readings))
    kept, sizes, checked = [], [], 0
    want, cpu, mem = baseline.with_figures(rows.sort_values("line_no").reset_index(drop=True), *past, 20)
    want = want[names]
    operator = baseline.LastReadings("line_no", names, 20, None)
    operator.init(types.SimpleNamespace(getListState=lambda *_, **__: state))
    tracemalloc.start()
    for part in operator.handleInputRows(("h",), (rows.iloc[i : i + 10_000] for i in range(0, n, 10_000)), None):
        assert part.reset_index(drop=True).equals(want.iloc[checked : checked + len(part)].reset_index(drop=True))
        checked += len(part)
        sizes.append(len(part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert checked == n and max(sizes) <= 10_000
    assert np.array_equal(kept, list(zip(cpu, mem)), equal_nan=True)
    assert peak < 3 * rows.memory_usage(index=False).sum()


def test_a_batch_of_one_file_is_parsed_by_all_cores(spark, table):
    """Lines that lie in one file are dealt out before they are parsed, and each is stored once."""
    from checks.queries import envelopes, log_lines

    inbox, out, progress = (scratch_path(spark, x) for x in ("one", "out", "progress"))
    log_lines(spark, SF).select("line_no", "value").coalesce(1).write.parquet(inbox)
    alerts.run_alerts(envelopes(replay_lines(spark, inbox, max_files=1)), out, progress).awaitTermination()
    found = spark.read.parquet(out)
    files = [f for f in found.inputFiles() if "is_anomaly=0" in f]
    assert len(files) == spark.sparkContext.defaultParallelism
    assert sorted(r[0] for r in found.select("kafka_offset").collect()) == sorted(r[0] for r in table.select("line_no").collect())
