import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.test_parse import line
from vigilog.operators import evaluate, paging, rolling, stats
from vigilog.plans import batch
from vigilog.schema import TABLE_SCHEMA
from vigilog.sinks import kafka as kafka_sink
from vigilog.sinks import tables as sink
from vigilog.sources import kafka, tables
from vigilog.sources.text import read_log
from vigilog.storage import scratch_path, shared_root


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers_over_many_splits(spark, tmp_path, small_splits):
    texts = {
        "a.log": [f"line {i} " + "x" * (i % 90) for i in range(1, 401)],
        "b.log": ["", "only", "", "é" * 300, ""],
        "c.log": ["no end"],
    }
    for name, rows in texts.items():
        end = "" if name == "c.log" else "\n"
        (tmp_path / name).write_bytes(("\n".join(rows) + end).encode())
    (tmp_path / "crlf.log").write_bytes("\r\n".join(f"w{i}" for i in range(300)).encode())
    texts["crlf.log"] = [f"w{i}" for i in range(300)]
    (tmp_path / "empty.log").write_bytes(b"")
    df = read_log(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 10
    got = {}
    for r in df.collect():
        got.setdefault(os.path.basename(r.file), {})[r.line_no] = r.value
    assert got == {name: dict(enumerate(rows, 1)) for name, rows in texts.items()}


def test_line_numbers_do_not_shuffle_the_text(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\ny\n")
    plan = read_log(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_missing_paths(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_log(spark, str(tmp_path / "none.log")).count()
    with pytest.raises(AnalysisException):
        tables.read_entries(spark, str(tmp_path / "none")).count()
    assert tables.read_report(spark, str(tmp_path / "none")) is None
    assert tables.read_rolling_section(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_model(spark, str(tmp_path / "none")) is None


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_table_round_trip(spark, table, fmt):
    path = scratch_path(spark, "t")
    assert sink.write_entries(table, path, fmt)
    back = tables.read_entries(spark, path, fmt)
    assert back.schema.names == TABLE_SCHEMA.names and len(back.schema) == 17
    flat = table.select(*TABLE_SCHEMA.names)
    assert back.orderBy("line_no").collect() == flat.orderBy("line_no").collect()
    assert tables.overview(back).first().asDict() == {"row_count": 920, "column_count": 17}


def test_nothing_is_written_for_an_empty_table(spark, table):
    path = scratch_path(spark, "t")
    assert not sink.write_entries(table.limit(0), path)
    with pytest.raises(AnalysisException):
        tables.read_entries(spark, path)


def test_scan_reads_two_columns_and_pushes_the_filter(spark, table):
    path = scratch_path(spark, "t")
    sink.write_entries(table, path)
    df = tables.read_entries(spark, path).where("is_anomaly = 1").select("cpu_max_pct")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cpu_max_pct:double,is_anomaly:int>" in plan
    assert "EqualTo(is_anomaly,1)" in plan


def test_report_merge(spark, table):
    path = scratch_path(spark, "report")
    compared = evaluate.rolling_report(evaluate.compare_detectors(rolling.detections(table)))
    assert not sink.merge_rolling(compared, path)
    scored = table.withColumn("iso_anomaly", F.col("is_anomaly"))
    sink.write_report(sink.training_report(scored, 0.05), path)
    assert tables.read_rolling_section(spark, path).count() == 0
    assert sink.merge_rolling(compared, path)
    saved = tables.read_report(spark, path).collect()
    assert len(saved) == 1
    r = saved[0]
    assert (r.total, r.anomalies, r.normals, len(r.features), r.contamination) == (920, 40, 880, 9, 0.05)
    assert r.rolling_baseline.asDict() == {
        "rolling_window": 20, "z_threshold": 2.0, "static_fp": 0, "smart_fp": 28, "smart_tp": 40,
        "smart_fn": 0, "smart_tn": 852, "fp_eliminated": -28, "static_cpu_thresh": 80.0,
        "static_mem_thresh": 85.0,
    }
    summary = stats.stats_summary(table, True, tables.read_rolling_section(spark, path)).first()
    assert summary.rolling_baseline.smart_fp == 28 and summary.model_loaded
    assert stats.stats_summary(table).first().rolling_baseline is None


def test_sample(spark, table):
    path = scratch_path(spark, "sample")
    sink.write_sample(table, path)
    got = spark.read.schema(TABLE_SCHEMA).json(path).collect()
    assert got == table.select(*TABLE_SCHEMA.names).orderBy("line_no").limit(1).collect()
    assert paging.first_record(table.limit(0)).count() == 0


def test_envelopes(spark):
    lines = spark.createDataFrame(
        [(1, ""), (2, "======"), (3, "  " + line() + "\t"), (4, "Log generator up"), (5, "noise")],
        "line_no bigint, value string",
    )
    sent = kafka.to_messages(kafka.build_envelopes(lines, producer=42))
    texts = [json.loads(r.value) for r in sent.collect()]
    assert [(t["line_no"], t["producer"], t["topic"]) for t in texts] == [(3, 42, "server-logs"), (5, 42, "server-logs")]
    assert texts[0]["raw_log"] == line() and texts[0]["sent_at"] > 1.6e9
    assert "topic" not in json.loads(kafka.to_messages(kafka.build_envelopes(lines, 1, topic=None)).first().value)
    extra = spark.createDataFrame([('{"line_no": 9}',), ('{"line_no": 8, "raw_log": ""}',), ("no json",)], "value string")
    found = kafka.enriched_entries(kafka.open_envelopes(sent.union(extra))).collect()
    assert len(found) == 1
    r = found[0]
    assert (r.kafka_offset, r.producer_pid, r.cpu_max_pct) == (3, 42, 12.3) and r.message_sent_at > 1.6e9


def test_broker_coordinates_are_kept(spark):
    messages = spark.createDataFrame(
        [(json.dumps({"line_no": 1, "raw_log": line()}), 3, 77)], "value string, partition int, offset bigint"
    )
    opened = kafka.open_envelopes(messages, ["partition", "offset"])
    r = kafka.enriched_entries(opened).first()
    assert (r.partition, r.offset, r.kafka_offset) == (3, 77, 1)


def test_kafka_options():
    assert kafka.source_options("h:9092", max_offsets=100) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "server-logs", "startingOffsets": "earliest",
        "groupIdPrefix": "anomaly-detector-group", "maxOffsetsPerTrigger": "100",
    }
    assert kafka_sink.sink_options("h:9092")["kafka.acks"] == "all"


def test_batch_job(spark, tmp_path):
    from checks.inputs import log_lines
    from tests.conftest import SF

    text = [r.value for r in log_lines(spark, SF).orderBy("line_no").collect()]
    (tmp_path / "server.log").write_text("\n".join(text) + "\n")
    out = scratch_path(spark, "job")
    result = batch.run(spark, str(tmp_path), out)
    assert result.tally.first().asDict() == {"parsed": 920, "skipped": 80, "errors": 0}
    assert result.refused.count() == 80
    assert result.table.agg(F.sum("line_no")).first()[0] == sum(
        r.line_no for r in log_lines(spark, SF).where("line_no % 50 not in (12, 14, 18, 20)").collect()
    )
    report = tables.read_report(spark, f"{out}/report").first()
    assert report.total == 920 and report.anomalies == 46
    assert report.rolling_baseline.smart_tp == 40 and report.rolling_baseline.smart_fp == 28
    assert tables.read_model(spark, f"{out}/model").meta == result.model.meta


def test_shared_root_is_the_session_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    def session(master):
        return N(conf=N(get=lambda name, default: default), sparkContext=N(master=master))

    assert shared_root(session("local[2]")) == shared_root(session("local[2]"))
    with pytest.raises(ValueError):
        shared_root(session("spark://head:7077"))
