import pytest
from pyspark.sql import functions as F

from vigilog.functions import parse as P

T0 = "2026-05-22 18:33:44"


def line(ts=T0, cpu="[12.3,8.1]", mem="23.4", proc="pid=1234 name=python cpu=45.6%", status="NORMAL",
         before="", after="", gap=" "):
    body = gap.join(
        [f"{ts} | INFO     | CPU:{cpu}", f"MEM_PCT:{mem}", "MEM_AVAIL:3200.0MB", "DISK_R:0.12MB",
         "DISK_W:0.45MB", "NET_S:120.3MB", "NET_R:340.1MB", f"TOP_PROC:{proc}", f"STATUS:{status}"]
    )
    return before + body + after


def proc(name="python", pid="1234", cpu="45.6"):
    return f"pid={pid} name={name} cpu={cpu}%"


# (text, status, expected fields)
CORPUS = [
    (line(), "parsed", {"cpu_max_pct": 12.3, "cpu_avg_pct": 10.2, "is_anomaly": 0, "anomaly_type": "none"}),
    (line(status="ANOMALY:CPU_SPIKE"), "parsed", {"is_anomaly": 1, "anomaly_type": "CPU_SPIKE"}),
    (line(status="ANOMALY:UNKNOWN"), "parsed", {"is_anomaly": 0, "anomaly_type": "none", "status": "ANOMALY:UNKNOWN"}),
    (line(status="XANOMALY:NET_FLOOD!"), "parsed", {"is_anomaly": 1, "anomaly_type": "NET_FLOOD"}),
    (line(cpu="[ 12.3 , 8.1 ]"), "parsed", {"cpu_avg_pct": 10.2}),
    (line(cpu="[12.3,]"), "parsed", {"cpu_max_pct": 12.3, "cpu_avg_pct": 12.3}),
    (line(cpu="[,,]"), "error", {}),
    (line(cpu="[]"), "skipped", {}),
    (line(mem="1.2.3"), "error", {}),
    (line(mem="."), "error", {}),
    (line(cpu="[1 2]"), "error", {}),
    (line(proc=proc("kworker/0:1")), "skipped", {}),
    (line(proc=proc("a-b")), "skipped", {}),
    (line(proc=proc("café")), "parsed", {"top_proc_name": "café"}),
    (line(proc=proc("IntervalTimer")), "skipped", {}),
    (line(proc=proc("AnomalyWatch")), "skipped", {}),
    (line(proc="unavailable"), "skipped", {}),
    (line(proc=proc(cpu="None")), "skipped", {}),
    (line(before="junk before "), "parsed", {"timestamp": T0}),
    (line(after=" junk after"), "parsed", {"status": "NORMAL"}),
    (" \t ", "skipped", {}),
    (f"{T0} | INFO     | " + "=" * 60, "skipped", {}),
    ("=" * 9, "skipped", {}),
    (line(ts="2026-99-99 10:00:00"), "parsed", {"timestamp": "2026-99-99 10:00:00"}),
    (line(mem="-1.0"), "skipped", {}),
    (line(mem="23"), "parsed", {"mem_used_pct": 23.0}),
    (line(mem=".5"), "parsed", {"mem_used_pct": 0.5}),
    (line(mem="5."), "parsed", {"mem_used_pct": 5.0}),
    (line(cpu="[7]"), "parsed", {"cpu_max_pct": 7.0, "cpu_avg_pct": 7.0}),
    (line(proc=proc(pid="99999999999")), "parsed", {"top_pid": 99999999999}),
    (line(mem="２３"), "error", {}),
    (line(gap="  \t"), "parsed", {"cpu_max_pct": 12.3}),
    # Beyond the corpus: the separator in the text, Unicode blanks, headers.
    (line(before="a\x1fb ", status="N\x1fX"), "parsed", {"status": "N\x1fX", "top_pid": 1234}),
    ("\x1f" * 12, "skipped", {}),
    (line(gap=" "), "parsed", {"mem_used_pct": 23.4}),
    (line(cpu="[\t12.3, 8.1,  ]"), "parsed", {"cpu_max_pct": 12.3, "cpu_avg_pct": 10.2}),
    (line(after=" PID   : 7"), "skipped", {}),
    (line(after=" Log file"), "skipped", {}),
    ("", "skipped", {}),
    (line() + " " + line(mem="99.0"), "parsed", {"mem_used_pct": 23.4}),
    ("x" * 100_000 + line(), "parsed", {"mem_used_pct": 23.4}),
    (None, "skipped", {}),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CORPUS)]
    df = spark.createDataFrame(rows, "line_no bigint, value string")
    return {r.line_no: r for r in P.with_event_time(P.with_parse(df)).collect()}


@pytest.mark.parametrize("i", range(len(CORPUS)))
def test_corpus(parsed, i):
    text, status, fields = CORPUS[i]
    row = parsed[i]
    assert row.parse_status == status
    for name, value in fields.items():
        assert row[name] == value
    if status != "parsed":
        assert row.cpu_max_pct is None and row.is_anomaly is None


def test_impossible_date_has_no_event_time(parsed):
    assert parsed[23].ts is None
    assert str(parsed[0].ts) == T0


def test_tally_and_quarantine(spark):
    from vigilog.operators.stats import parse_tally

    df = spark.createDataFrame([(t,) for t, _, _ in CORPUS], "value string")
    p = P.with_parse(df)
    counts = parse_tally(p).first()
    want = [s for _, s, _ in CORPUS]
    assert counts.asDict() == {
        "parsed": want.count("parsed"), "skipped": want.count("skipped"), "errors": want.count("error"),
    }
    assert P.quarantine(p).count() == len(want) - want.count("parsed")
    assert P.parse_lines(df).count() == want.count("parsed")


def test_pattern_runs_once_per_line(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("value"))
    lines = P.parse_lines(df).where("is_anomaly = 1").select("cpu_max_pct", "top_pid")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(value") == 1


def test_header_and_replay_filters(spark):
    df = spark.createDataFrame(
        [("===",), ("==========",), ("Log generator started",), ("PID        : 1",), ("PID",), ("",), ("x",)],
        "value string",
    )
    got = df.select(
        "value", P.is_header("value").alias("h"), P.is_replay_noise(F.col("value")).alias("n")
    ).collect()
    assert {r.value: (r.h, r.n) for r in got} == {
        "===": (False, True), "==========": (True, True), "Log generator started": (True, True),
        "PID        : 1": (True, False), "PID": (False, False), "": (False, True), "x": (False, False),
    }
