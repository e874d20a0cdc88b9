"""The registered queries. Names follow the operator ids of the survey."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.catalog import query
from checks.inputs import events, lines_of, log_lines, metrics
from checks.sql import (
    ENTRIES_SQL, FLAT, GLOBAL_SQL, KEYED_SQL, LINES_SQL, METRICS_SQL, fixed, parse_of,
)
from vigilog.functions import lines as L
from vigilog.functions import parse as P
from vigilog.functions.numeric import float_text, round_exact
from vigilog.operators import evaluate, forest, inject, labels, paging, rolling, sketches, stats
from vigilog.operators.quantiles import exact_quantile
from vigilog.plans import scoring, versions
from vigilog.schema import FEATURES, TABLE_SCHEMA
from vigilog.sinks import alerts as alert_sink
from vigilog.sinks import tables as table_sink
from vigilog.sources import follow, kafka, replay
from vigilog.sources import tables as table_source
from vigilog.sources.text import read_log
from vigilog.storage import materialize, scratch_path
from vigilog.streaming import alerts as alert_stream
from vigilog.streaming import baseline as baseline_stream
from vigilog.streaming import progress as progress_table

# Small blocks, so that the hand-over between blocks is exercised at every scale.
BLOCK = 4096


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_lines(log_lines(spark, sf_dir))


def found(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return rolling.detections(entries(spark, sf_dir), **{"block_rows": BLOCK, **kw})


def six(*names: str) -> list:
    """Columns rounded to 6 decimals, out of reach of summation order."""
    return [(F.round(F.col(n), 6) + F.lit(0.0)).alias(n) for n in names]


def six_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 as {n}" for n in names)


# --- parse, filter, project --------------------------------------------------


@query("p1_parse", f"{ENTRIES_SQL} select {FLAT} from e")
def p1(spark, sf):
    return entries(spark, sf).select(*TABLE_SCHEMA.names)


@query(
    "p2_skip",
    f"""{LINES_SQL} select line_no, trim(value) = '' as blank,
    regexp_matches(value, '={{10,}}|Log generator|PID\\s+:|Log file|Interval|Anomaly|Generator stopped') as header from l""",
)
def p2(spark, sf):
    v = F.col("value")
    return log_lines(spark, sf).select(
        "line_no", P.is_blank(v).alias("blank"), P.is_header("value").alias("header")
    )


@query(
    "p3_prefilter",
    f"""{LINES_SQL} select line_no, value from l
    where trim(value) <> '' and not contains(value, '===') and not contains(value, 'Log generator')""",
)
def p3(spark, sf):
    return log_lines(spark, sf).where(~P.is_replay_noise(F.col("value"))).select("line_no", "value")


_DAMAGED = """case when line_no%10=0 then replace(value, ' MEM_PCT:', ' MEM_PCT:1.2.')
  when line_no%21=0 then replace(value, 'CPU:[', 'CPU:[1 2,')
  when line_no%33=0 then replace(value, 'CPU:[', 'CPU:[ , ,') else value end"""
_DAMAGED_SQL = (
    LINES_SQL + f",\nx as (select line_no, host_id, {_DAMAGED} as value from l),\n" + parse_of("x")
)


def damaged(spark, sf):
    return log_lines(spark, sf).withColumn("value", F.expr(_DAMAGED))


@query("p4_quarantine", f"{_DAMAGED_SQL} select line_no, value, parse_status from p where parse_status <> 'parsed'")
def p4(spark, sf):
    return P.quarantine(P.with_parse(damaged(spark, sf))).select("line_no", "value", "parse_status")


@query(
    "p5_cores",
    f"{_DAMAGED_SQL} select line_no, cast(len(cores) as integer) as n_cores, list_max(cores) as cpu_max_pct, "
    f"{fixed('list_sum(cores)/len(cores)', 2)} as cpu_avg_pct from p where parse_status = 'parsed'",
)
def p5(spark, sf):
    return P.parse_lines(damaged(spark, sf)).select(
        "line_no", F.size("cpu_cores").alias("n_cores"), "cpu_max_pct", "cpu_avg_pct"
    )


@query("p6_label", f"{ENTRIES_SQL} select line_no, status, is_anomaly, anomaly_type from e")
def p6(spark, sf):
    return entries(spark, sf).select("line_no", "status", "is_anomaly", "anomaly_type")


_SENT = "cast(1700000000 + line_no as double)"
_ENVELOPES_SQL = f"""select line_no, trim(value) as raw_log, {_SENT} as sent_at, cast(7 as bigint) as producer,
 'server-logs' as topic from l
 where trim(value) <> '' and not contains(value, '===') and not contains(value, 'Log generator')"""


def envelopes(lines: DataFrame) -> DataFrame:
    return kafka.build_envelopes(lines, producer=7, sent_at=F.expr(_SENT))


@query("p7_envelope", f"{LINES_SQL} {_ENVELOPES_SQL}")
def p7(spark, sf):
    return kafka.open_envelopes(kafka.to_messages(envelopes(log_lines(spark, sf))))


@query(
    "p8_unwrap",
    f"""{ENTRIES_SQL} select {FLAT.replace(', line_no', '')}, line_no as kafka_offset,
    cast(7 as bigint) as producer_pid, {_SENT} as message_sent_at from e""",
)
def p8(spark, sf):
    messages = kafka.to_messages(envelopes(log_lines(spark, sf)))
    return labels.flatten(kafka.enriched_entries(kafka.open_envelopes(messages)))


@query("p9_filter", f"{ENTRIES_SQL} select {FLAT} from e where is_anomaly = 0")
def p9(spark, sf):
    return labels.label_filter(entries(spark, sf), "normal").select(*TABLE_SCHEMA.names)


@query("p10_search", f"{ENTRIES_SQL} select line_no, top_proc_name from e where contains(lower(top_proc_name), 'li')")
def p10(spark, sf):
    return labels.process_search(entries(spark, sf), "LI").select("line_no", "top_proc_name")


_GAPS = {
    "cpu_max_pct": "case when line_no%7=0 then null else cpu_max_pct end",
    "net_sent_mb": "case when line_no%5=0 then cast('NaN' as double) else net_sent_mb end",
}


def _gap_sql(name: str) -> str:
    x = _GAPS.get(name, name)
    return f"case when {x} is null or isnan({x}) then 0.0 else {x} end as {name}"


@query("p11_fill", f"{ENTRIES_SQL} select line_no, {', '.join(_gap_sql(c) for c in FEATURES)} from e")
def p11(spark, sf):
    gaps = entries(spark, sf).withColumns({c: F.expr(x) for c, x in _GAPS.items()})
    return labels.fill_features(gaps).select("line_no", *FEATURES)


@query("p12_drop", f"{ENTRIES_SQL} select {FLAT}, host_id from e")
def p12(spark, sf):
    return labels.flatten(entries(spark, sf))


@query("p13_clock", f"""{ENTRIES_SQL} select line_no, substr("timestamp", 12, 8) as clock from e""")
def p13(spark, sf):
    return entries(spark, sf).select("line_no", labels.clock(F.col("timestamp")).alias("clock"))


@query(
    "p14_round",
    f"""with x as (select event_id, cast(event_id as double)/16 - 50 as a, value/7 as b, value as c from events)
    select event_id, {fixed('a', 1)} + 0.0 as a1, {fixed('a', 3)} + 0.0 as a3, {fixed('b', 2)} as b2, {fixed('b', 4)} as b4,
    case when event_id%9=0 then '—'
     else format('{{:.1f}}', case when c*4 = floor(c*4) then c + 0.001 else c end) end as shown from x""",
)
def p14(spark, sf):
    x = events(spark, sf).select(
        "event_id",
        (F.col("event_id").cast("double") / 16 - 50).alias("a"),
        (F.col("value") / 7).alias("b"),
        F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("c"),
    )
    return x.select(
        "event_id",
        *[
            (round_exact(c, d) + F.lit(0.0)).alias(f"{c}{d}")
            for c, d in (("a", 1), ("a", 3), ("b", 2), ("b", 4))
        ],
        labels.one_decimal("c").alias("shown"),
    )


_LINE_SQL = """substr(cast(ts as varchar),1,19) || ' | ' || case when {status}='NORMAL' then 'INFO    ' else 'WARNING ' end
 || ' | CPU:[' || (cast({c0} as double)/10) || ',' || (cast(c1 as double)/10) || ',' || (cast(c2 as double)/10) || ','
 || (cast(c3 as double)/10) || '] MEM_PCT:' || (cast({mem} as double)/10) || ' MEM_AVAIL:' || cast(16000-mem10*16 as varchar)
 || '.0MB DISK_R:' || cast(event_id*3 as varchar) || '.25MB DISK_W:' || cast(event_id*2 as varchar) || '.5MB NET_S:'
 || cast(event_id as varchar) || '.75MB NET_R:' || cast(event_id*4 as varchar) || '.0MB TOP_PROC:pid=' || cast(100+user_id as varchar)
 || ' name=' || event_type || ' cpu=' || (cast(c1 as double)/10) || '% STATUS:' || {status}"""


def metric_table(spark, sf):
    """Metric records as a collector would store them."""
    tenth = lambda c: F.col(c) / 10
    return metrics(spark, sf).select(
        "event_id", "line_no", F.substring(F.col("ts").cast("string"), 1, 19).alias("timestamp"),
        F.array(*[tenth(c) for c in ("c0", "c1", "c2", "c3")]).alias("cpu_cores"),
        tenth("mem10").alias("mem_used_pct"),
        (16000 - F.col("mem10") * 16).cast("double").alias("mem_avail_mb"),
        (F.col("event_id") * 3 + 0.25).alias("disk_read_mb"),
        (F.col("event_id") * 2 + 0.5).alias("disk_write_mb"),
        (F.col("event_id") + 0.75).alias("net_sent_mb"),
        (F.col("event_id") * 4).cast("double").alias("net_recv_mb"),
        F.format_string(
            "pid=%d name=%s cpu=%s%%", F.col("user_id") + 100, "event_type",
            tenth("c1").cast("string"),
        ).alias("top_proc"),
        "status",
    )


@query("p15_format", f"{METRICS_SQL} select line_no, {_LINE_SQL.format(status='status', c0='c0', mem='mem10')} as value from m")
def p15(spark, sf):
    return L.metric_lines(metric_table(spark, sf))


@query("p16_level", f"{METRICS_SQL} select line_no, case when status='NORMAL' then 'INFO' else 'WARNING' end as level from m")
def p16(spark, sf):
    return metrics(spark, sf).select("line_no", L.severity(F.col("status")).alias("level"))


_BYTES = "case when event_id%13=0 then null else event_id*1234567 + user_id*987 end"


@query(
    "p17_units",
    f"""with x as (select event_id, cast({_BYTES} as double)/1048576 as mb from events)
    select event_id, coalesce({fixed('mb', 1)}, 0.0) as mem_mb, coalesce({fixed('mb', 2)}, 0.0) as disk_mb from x""",
)
def p17(spark, sf):
    raw = events(spark, sf).select("event_id", F.expr(_BYTES).alias("bytes"))
    return L.with_megabytes(raw, {"mem_mb": ("bytes", 1), "disk_mb": ("bytes", 2)}).drop("bytes")


@query(
    "p18_tags",
    f"""{GLOBAL_SQL} select line_no, case when smart_alert = 1 then 'ANOMALY' else 'NORMAL' end as label,
    case when smart_alert = 1 then case when is_anomaly = 1 then 'TP' else 'FP' end end as tag from d""",
)
def p18(spark, sf):
    alert = F.col("smart_alert")
    return found(spark, sf).select(
        "line_no", labels.verdict(alert).alias("label"),
        F.when(alert == 1, labels.hit_tag(F.col("is_anomaly"))).alias("tag"),
    )


# --- aggregates --------------------------------------------------------------


@query(
    "a1_counts",
    f"""{ENTRIES_SQL}, c as (select count(*) as total, count(*) filter (is_anomaly=0) as normals,
    count(*) filter (is_anomaly=1) as anomalies from e)
    select *, 100*normals//total as normal_pct, 100*anomalies//total as anomaly_pct from c""",
)
def a1(spark, sf):
    return stats.entry_counts(entries(spark, sf))


@query(
    "a2_minmax",
    f"""{ENTRIES_SQL}, c as (select min(cpu_max_pct) as cpu_min, max(cpu_max_pct) as cpu_max, avg(cpu_max_pct) as cpu_avg,
    min(mem_used_pct) as mem_min, max(mem_used_pct) as mem_max, avg(mem_used_pct) as mem_avg from e)
    select {six_sql('cpu_min', 'cpu_max', 'cpu_avg', 'mem_min', 'mem_max', 'mem_avg')} from c""",
)
def a2(spark, sf):
    return stats.extremes(entries(spark, sf)).select(
        *six("cpu_min", "cpu_max", "cpu_avg", "mem_min", "mem_max", "mem_avg")
    )


@query("a3_types", f"{ENTRIES_SQL} select anomaly_type, count(*) as entries from e where is_anomaly=1 group by all")
def a3(spark, sf):
    return stats.type_breakdown(entries(spark, sf))


@query("a3_all_types", f"{ENTRIES_SQL} select anomaly_type, count(*) as entries from e group by all")
def a3_all(spark, sf):
    return stats.type_breakdown(entries(spark, sf), anomalies_only=False)


@query(
    "a4_stats",
    f"""{ENTRIES_SQL} select count(*) as total, count(*) filter (is_anomaly=0) as normals,
    count(*) filter (is_anomaly=1) as anomalies, {fixed('100.0*cast(sum(is_anomaly) as double)/count(*)', 1)} as anomaly_pct,
    {fixed('avg(cpu_max_pct)', 1)} as cpu_avg, max(cpu_max_pct) as cpu_max,
    {fixed('avg(mem_used_pct)', 1)} as mem_avg, max(mem_used_pct) as mem_max,
    count(*) filter (anomaly_type='CPU_SPIKE') as cpu_spikes, count(*) filter (anomaly_type='MEM_SPIKE') as mem_spikes,
    false as model_loaded from e""",
)
def a4(spark, sf):
    return stats.stats_summary(entries(spark, sf)).select(
        "total", "normals", "anomalies", "anomaly_pct", "cpu_avg", "cpu_max", "mem_avg", "mem_max",
        F.try_element_at("anomaly_types", F.lit("CPU_SPIKE")).alias("cpu_spikes"),
        F.try_element_at("anomaly_types", F.lit("MEM_SPIKE")).alias("mem_spikes"),
        "model_loaded",
    )


@query(
    "a5_donut",
    f"""{ENTRIES_SQL} select count(*) filter (is_anomaly=0) as normal, count(*) filter (anomaly_type='CPU_SPIKE') as cpu_spike,
    count(*) filter (anomaly_type='MEM_SPIKE') as mem_spike from e""",
)
def a5(spark, sf):
    return stats.donut(entries(spark, sf))


_CONFUSION_SQL = """c as (select count(*) filter (is_anomaly=0 and smart_alert=0) as tn,
 count(*) filter (is_anomaly=0 and smart_alert=1) as fp, count(*) filter (is_anomaly=1 and smart_alert=0) as fn,
 count(*) filter (is_anomaly=1 and smart_alert=1) as tp from d)"""


@query("a6_confusion", f"{GLOBAL_SQL}, {_CONFUSION_SQL} select * from c")
def a6(spark, sf):
    return evaluate.confusion_matrix(found(spark, sf), predicted="smart_alert")


@query(
    "a7_report",
    f"""{GLOBAL_SQL}, {_CONFUSION_SQL},
    r as (select 'Normal' as class, coalesce(tn/nullif(tn+fn,0),0.0) as p, coalesce(tn/nullif(tn+fp,0),0.0) as r, tn+fp as s from c
     union all select 'Anomaly', coalesce(tp/nullif(tp+fp,0),0.0), coalesce(tp/nullif(tp+fn,0),0.0), tp+fn from c),
    f as (select *, coalesce(2*p*r/nullif(p+r,0),0.0) as f1 from r),
    o as (select class, p as precision, r as recall, f1, s as support from f
     union all select 'macro avg', avg(p), avg(r), avg(f1), cast(sum(s) as bigint) from f
     union all select 'weighted avg', sum(p*s)/sum(s), sum(r*s)/sum(s), sum(f1*s)/sum(s), cast(sum(s) as bigint) from f
     union all select 'accuracy', null, null, (tn+tp)/(tn+fp+fn+tp), tn+fp+fn+tp from c)
    select class, {six_sql('precision', 'recall', 'f1')}, support from o""",
)
def a7(spark, sf):
    report = evaluate.classification_report(found(spark, sf), predicted="smart_alert")
    return report.select("class", *six("precision", "recall", "f1"), "support")


A8_SQL = f"""{GLOBAL_SQL}, c as (select count(*) as total, count(*) filter (is_anomaly=1) as labelled,
 count(*) filter (static_alert=1 and is_anomaly=1) as static_tp, count(*) filter (static_alert=1 and is_anomaly=0) as static_fp,
 count(*) filter (smart_alert=1 and is_anomaly=0) as smart_fp, count(*) filter (smart_alert=1 and is_anomaly=1) as smart_tp,
 count(*) filter (smart_alert=0 and is_anomaly=1) as smart_fn, count(*) filter (smart_alert=0 and is_anomaly=0) as smart_tn from d)
 select *, round(100.0*static_fp/greatest(total-labelled,1), 6) as fp_rate_static,
 round(100.0*smart_fp/greatest(total-labelled,1), 6) as fp_rate_smart, static_fp - smart_fp as fp_eliminated from c"""


@query("a8_compare", A8_SQL)
def a8(spark, sf):
    return evaluate.compare_detectors(found(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("fp_rate_static", "fp_rate_smart")}
    )


@query(
    "a11_pages",
    f"""{ENTRIES_SQL} select count(*) as total, greatest(1, cast(ceil(count(*)/20.0) as bigint)) as pages
    from e where is_anomaly=1""",
)
def a11(spark, sf):
    return paging.page_counts(entries(spark, sf), 20, "anomaly")


@query(
    "a12_tally",
    f"""{_DAMAGED_SQL} select count(*) filter (parse_status='parsed') as parsed,
    count(*) filter (parse_status='skipped') as skipped, count(*) filter (parse_status='error') as errors from p""",
)
def a12(spark, sf):
    return stats.parse_tally(P.with_parse(damaged(spark, sf)))


# --- rolling window ----------------------------------------------------------

_STATS = ("cpu_mean", "cpu_std", "mem_mean", "mem_std")
_RAW_SQL = "round(cpu_m, 6) as cpu_mean, round(cpu_s, 6) as cpu_std, round(mem_m, 6) as mem_mean, round(mem_s, 6) as mem_std"


@query("w1_baseline", f"{KEYED_SQL} select host_id, line_no, history, {_RAW_SQL} from d")
def w1(spark, sf):
    return rolling.with_baseline(entries(spark, sf), "host_id", block_rows=BLOCK).select(
        "host_id", "line_no", "history", *[F.round(c, 6).alias(c) for c in _STATS]
    )


@query(
    "w2_zscore",
    f"""{KEYED_SQL} select host_id, line_no, {six_sql('cpu_z', 'cpu_mean', 'cpu_std', 'mem_z', 'mem_mean', 'mem_std')},
    cpu_z > 2.0 as cpu_above, mem_z > 2.0 as mem_above from d""",
)
def w2(spark, sf):
    checked = rolling.with_zscores(
        rolling.with_baseline(entries(spark, sf), "host_id", block_rows=BLOCK)
    )
    return checked.select(
        "host_id", "line_no",
        *six("cpu_z", "cpu_mean", "cpu_std", "mem_z", "mem_mean", "mem_std"),
        "cpu_above", "mem_above",
    )


@query(
    "w3_alert",
    f"""{KEYED_SQL} select host_id, line_no, smart_alert, case when smart_alert = 0 then 'normal'
    when cpu_z > 2.0 and mem_z > 2.0 then 'CPU | MEM' when cpu_z > 2.0 then 'CPU' else 'MEM' end as fired from d""",
)
def w3(spark, sf):
    alerts = rolling.smart_alerts(entries(spark, sf), stream_key="host_id", block_rows=BLOCK)
    # The figures in the text depend on rounding; unit tests compare them in full.
    return alerts.select(
        "host_id", "line_no", "smart_alert",
        F.regexp_replace("smart_reason", r" Z=[^)]*\)", "").alias("fired"),
    )


_SHOWN = [(f"{m}_{k}", d) for m in ("cpu", "mem") for k, d in (("z", 3), ("mean", 2), ("std", 2))]


def _clear(x: str, digits: int) -> str:
    """Rounded, and 0 so near to a tie that the order of additions decides."""
    scaled = f"(abs({x}) * {10**digits})"
    return f"case when abs({scaled} - floor({scaled}) - 0.5) < 0.0001 then 0.0 else {{}} end"


@query(
    "w3_figures",
    f"{KEYED_SQL} select host_id, line_no, "
    + ", ".join(f"round({_clear(c, d).format(c)}, {d}) + 0.0 as {c}" for c, d in _SHOWN)
    + " from d where smart_alert = 1",
)
def w3_figures(spark, sf):
    alerts = rolling.smart_alerts(entries(spark, sf), stream_key="host_id", block_rows=BLOCK).where("smart_alert = 1")
    shown = rolling.with_rounded_check(alerts)
    return shown.selectExpr("host_id", "line_no", *[f"{_clear(c, d).format(f'{c}_shown')} + 0.0D as {c}" for c, d in _SHOWN])


@query("w4_static", f"{GLOBAL_SQL} select line_no, static_alert from d")
def w4(spark, sf):
    return rolling.with_static_alert(entries(spark, sf)).select("line_no", "static_alert")


@query(
    "w5_last60",
    f"""{ENTRIES_SQL}, r as (select *, row_number() over (partition by host_id order by line_no desc) as n from e)
    select host_id, line_no, substr("timestamp",12,8) as clock, cpu_max_pct, mem_used_pct from r where n <= 60""",
)
def w5(spark, sf):
    return paging.last_per_stream(entries(spark, sf), "host_id").select(
        "host_id", "line_no", labels.clock(F.col("timestamp")).alias("clock"),
        "cpu_max_pct", "mem_used_pct",
    )


@query(
    "w6_halo",
    f"{GLOBAL_SQL} select line_no, history, {six_sql('cpu_mean', 'cpu_std', 'mem_mean', 'mem_std')}, smart_alert from d",
)
def w6(spark, sf):
    return rolling.smart_alerts(entries(spark, sf), reason=False, block_rows=256).select(
        "line_no", "history", *six(*_STATS), "smart_alert"
    )


# --- pages, feeds, samples ---------------------------------------------------


@query("l1_page", f"{ENTRIES_SQL} select {FLAT} from e where is_anomaly=1 order by line_no limit 20 offset 20")
def l1(spark, sf):
    return paging.page_of_records(entries(spark, sf), 2, 20, "anomaly").select(*TABLE_SCHEMA.names)


@query("l1_deep_page", f"{ENTRIES_SQL} select {FLAT} from e order by line_no limit 50 offset 450")
def l1_deep(spark, sf):
    stored = materialize(entries(spark, sf), "entries")
    return paging.page_of_records(stored, 10, 50, shallow_rows=0).select(*TABLE_SCHEMA.names)


@query("l1_after", f"{ENTRIES_SQL} select {FLAT} from e where line_no > 333 order by line_no limit 50")
def l1_after(spark, sf):
    return paging.page_after(entries(spark, sf), 333).select(*TABLE_SCHEMA.names)


@query(
    "l2_first_alerts",
    f"""{GLOBAL_SQL} select line_no, cpu_max_pct as cpu, mem_used_pct as mem,
    case when is_anomaly=1 then 'TP' else 'FP' end as tag from d where smart_alert=1 order by line_no limit 5""",
)
def l2(spark, sf):
    return paging.first_alerts(found(spark, sf)).select(
        "line_no", F.col("cpu_max_pct").alias("cpu"), F.col("mem_used_pct").alias("mem"), "tag"
    )


@query("l4_feed", f"{ENTRIES_SQL} select {FLAT} from e order by line_no desc limit 100")
def l4(spark, sf):
    return paging.newest(entries(spark, sf)).select(*TABLE_SCHEMA.names)


@query(
    "l5_top_proc",
    """with s as (select user_id%16 as host, date_trunc('hour', ts) as snapshot, user_id as pid, event_type as name,
     case when event_id%50=17 then null else value end as cpu_percent from events),
    r as (select *, row_number() over (partition by host, snapshot order by coalesce(cpu_percent,0.0) desc, pid, name) as n from s)
    select host, cast(snapshot as timestamp) as snapshot, pid, name, cpu_percent from r where n=1""",
)
def l5(spark, sf):
    snapshots = events(spark, sf).select(
        (F.col("user_id") % 16).alias("host"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("snapshot"),
        F.col("user_id").alias("pid"), F.col("event_type").alias("name"),
        F.when(F.col("event_id") % 50 != 17, F.col("value")).alias("cpu_percent"),
    )
    return paging.top_process(snapshots, ["host", "snapshot"]).drop("top_proc")


@query("l1_all_pages", f"{ENTRIES_SQL} select line_no % 500 as line_no, cpu_max_pct, is_anomaly from e")
def l1_pages(spark, sf):
    # Order values tie as those of several files do; deep pages put together are the table.
    table = materialize(entries(spark, sf).withColumn("line_no", F.col("line_no") % 500), "entries")
    n = table.count()
    size = -(-n // 6)
    pages = [paging.page_of_records(table, p, size, order_col=["line_no", "cpu_max_pct"], shallow_rows=0) for p in range(1, 7)]
    whole = pages[0]
    for page in pages[1:]:
        whole = whole.unionByName(page)
    return whole.select("line_no", "cpu_max_pct", "is_anomaly")


@query("l6_sample", f"{ENTRIES_SQL} select {FLAT} from e order by line_no limit 1")
def l6(spark, sf):
    return paging.first_record(entries(spark, sf)).select(*TABLE_SCHEMA.names)


# --- sources and sinks -------------------------------------------------------


@query(
    "s2_csv_dialect",
    f"""{ENTRIES_SQL} select line_no, case line_no % 4 when 0 then 'a"b' when 1 then 'x,\\' when 2 then '\\"q,' else status end as status from e""",
)
def s2_csv(spark, sf):
    status = F.expr(r"""case line_no % 4 when 0 then 'a"b' when 1 then r'x,\' when 2 then r'\"q,' else status end""")
    path = scratch_path(spark, "csv")
    table_sink.write_entries(entries(spark, sf).withColumn("status", status), path, "csv")
    return table_source.read_entries(spark, path, "csv").select("line_no", "status")


@query(
    "p15_digits",
    "select event_id, event_id / 2000.0::double as small, event_id * 1234.5678::double + 12345678.123456::double as large from events",
)
def p15_digits(spark, sf):
    small, large = F.col("event_id") / 2000.0, F.col("event_id") * 1234.5678 + 12345678.123456
    texts = events(spark, sf).select("event_id", small.alias("small"), large.alias("large")).select("event_id", float_text("small").alias("small"), float_text("large").alias("large"))
    # Plain digits only, as the line format asks for; anything else is null here.
    plain = lambda c: F.when(F.col(c).rlike(r"^[0-9]+[.][0-9]+$"), F.col(c).cast("double")).alias(c)
    return texts.select("event_id", plain("small"), plain("large"))


@query("s2_scan", f"{ENTRIES_SQL} select line_no, cpu_max_pct, anomaly_type from e where is_anomaly=1")
def s2(spark, sf):
    path = scratch_path(spark, "table")
    table_sink.write_entries(entries(spark, sf), path)
    table = table_source.read_entries(spark, path)
    return labels.label_filter(table, "anomaly").select("line_no", "cpu_max_pct", "anomaly_type")


@query("s2_overview", f"{ENTRIES_SQL} select count(*) as row_count, cast(17 as integer) as column_count from e")
def s2_overview(spark, sf):
    return table_source.overview(labels.flatten(entries(spark, sf)).drop("host_id"))


@query("k1_csv_roundtrip", f"{ENTRIES_SQL} select {FLAT} from e")
def k1(spark, sf):
    path = scratch_path(spark, "csv")
    table_sink.write_entries(entries(spark, sf), path, "csv")
    return table_source.read_entries(spark, path, "csv")


@query("k2_sample_json", f"{ENTRIES_SQL} select {FLAT} from e order by line_no limit 1")
def k2(spark, sf):
    path = scratch_path(spark, "sample")
    table_sink.write_sample(entries(spark, sf), path)
    return spark.read.schema(TABLE_SCHEMA).json(path)


_ALERTS_SQL = """select line_no, "timestamp", anomaly_type, cpu_max_pct, mem_used_pct, top_proc_name, top_pid
 from e where is_anomaly=1"""


@query("k6_alerts", f"{ENTRIES_SQL} {_ALERTS_SQL}")
def k6(spark, sf):
    return alert_sink.alerts(entries(spark, sf), ["line_no"])


@query("k6_ok", f"{ENTRIES_SQL} select line_no, cpu_max_pct, mem_used_pct, top_proc_name from e where is_anomaly=0")
def k6_ok(spark, sf):
    return alert_sink.ok_lines(entries(spark, sf), ["line_no"])


@query("s1_lines", f"{LINES_SQL} select line_no, trim(value) as value from l")
def s1(spark, sf):
    path = scratch_path(spark, "log")
    ordered = log_lines(spark, sf).orderBy("line_no")
    # One file per range of lines; their sorted names give back the order.
    ordered.select("value").write.text(path)
    files = read_log(spark, path)
    return _whole_numbers(files)


def _whole_numbers(files: DataFrame) -> DataFrame:
    """Numbers over all files in name order from the per-file numbers."""
    from pyspark.sql import Window

    sizes = files.groupBy("file").agg(F.max("line_no").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return files.join(starts, "file").select(
        (F.col("start") + F.col("line_no")).alias("line_no"), "value"
    )


# --- augmentation ------------------------------------------------------------

_PICK_CPU = "event_id%40=9"
_PICK_MEM = "event_id%40=29"


def _injected(spark, sf):
    picked = metric_table(spark, sf)
    return inject.inject_where(
        picked, F.expr(_PICK_CPU), F.expr(_PICK_MEM),
        F.expr("(950 + (event_id*37)%51) / 10D"), F.expr("(920 + (event_id*53)%71) / 10D"),
    )


_INJECTED_SQL = f"""{METRICS_SQL}, i as (select * exclude (status, c0), mem10 as old_mem,
 case when {_PICK_CPU} then 950 + (event_id*37)%51 else c0 end as i0,
 case when {_PICK_MEM} then 920 + (event_id*53)%71 else mem10 end as imem,
 case when {_PICK_CPU} then 'ANOMALY:CPU_SPIKE' when {_PICK_MEM} then 'ANOMALY:MEM_SPIKE' else 'NORMAL' end as status from m)"""


@query(
    "g1_inject",
    f"""{_INJECTED_SQL} select line_no, cast(i0 as double)/10 as core0, cast(c1 as double)/10 as core1,
    cast(4 as integer) as n_cores, cast(imem as double)/10 as mem_used_pct, status from i""",
)
def g1(spark, sf):
    return _injected(spark, sf).select(
        "line_no", F.get("cpu_cores", F.lit(0)).alias("core0"), F.get("cpu_cores", F.lit(1)).alias("core1"),
        F.size("cpu_cores").alias("n_cores"), "mem_used_pct", "status",
    )


@query("g1_random")
def g1_random(spark, sf):
    return inject.inject_anomalies(metric_table(spark, sf), ["line_no"]).select(
        "line_no", "mem_used_pct", F.get("cpu_cores", F.lit(0)).alias("core0"), "status"
    )


@query("g2_lines", f"{_INJECTED_SQL} select line_no, {_LINE_SQL.format(status='status', c0='i0', mem='imem')} as value from i")
def g2(spark, sf):
    return L.metric_lines(_injected(spark, sf))


# --- model -------------------------------------------------------------------


@query("m1_features", f"{ENTRIES_SQL} select line_no, {', '.join(FEATURES)} from e")
def m1(spark, sf):
    return labels.fill_features(entries(spark, sf)).select("line_no", *FEATURES)


_SCALER_SQL = " union all ".join(
    f"select {i} as position, '{c}' as feature, avg({c}) as mean, "
    f"case when stddev_pop({c}) = 0 then 1.0 else stddev_pop({c}) end as scale from e"
    for i, c in enumerate(FEATURES)
)


@query(
    "m2_scaler",
    f"{ENTRIES_SQL}, s as ({_SCALER_SQL}) select position, feature, {six_sql('mean', 'scale')} from s",
)
def m2(spark, sf):
    return forest.fit_scaler(entries(spark, sf)).select("position", "feature", *six("mean", "scale"))


@query(
    "m3_scaled",
    f"""{ENTRIES_SQL}, s as ({_SCALER_SQL}) select line_no, """
    + ", ".join(
        f"round(({c} - (select mean from s where feature='{c}')) / (select scale from s where feature='{c}'), 6) + 0.0 as {c}"
        for c in FEATURES
    )
    + " from e",
)
def m3(spark, sf):
    table = entries(spark, sf)
    scaled = forest.apply_scaler(table, forest.fit_scaler(table))
    return scaled.select("line_no", *six(*FEATURES))


def trained(spark, sf):
    table = materialize(labels.flatten(entries(spark, sf)), "entries")
    return table, forest.fit_forest(table, ["line_no"])


@query("m4_forest")
def m4(spark, sf):
    _, model = trained(spark, sf)
    return model.nodes


@query(
    "m4_facts",
    f"""{ENTRIES_SQL}, sizes as (select least(256, count(*)) as size from e)
    select cast(i as integer) as tree, cast(size as integer) as root_rows, cast(size as bigint) as leaf_rows from sizes, (select unnest(range(100)) as i) as trees""",
)
def m4_facts(spark, sf):
    nodes = trained(spark, sf)[1].nodes
    leaf = F.col("feature") < 0
    return nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root_rows"), F.sum(F.when(leaf, F.col("size"))).alias("leaf_rows")
    )


@query("m5_facts", f"{ENTRIES_SQL} select line_no, true as in_range from e")
def m5_facts(spark, sf):
    table, model = trained(spark, sf)
    score = F.col("score")
    return forest.with_score(table, model).select("line_no", ((score > -1) & (score < 0)).alias("in_range"))


_AGREE = "coalesce(is_anomaly = greatest(iso_anomaly, smart_alert) and label = case when is_anomaly = 1 then 'ANOMALY' else 'NORMAL' end, false) as agrees"


@query("m8_facts", f"{GLOBAL_SQL} select line_no, smart_alert, true as agrees from d")
def m8_facts(spark, sf):
    return m8(spark, sf).selectExpr("line_no", "smart_alert", _AGREE)


@query(
    "m9_facts",
    f"""{GLOBAL_SQL} select line_no, smart_alert, true as agrees, cpu_max_pct, mem_used_pct, "timestamp", top_proc_name as top_proc from d""",
)
def m9_facts(spark, sf):
    return m9(spark, sf).selectExpr("line_no", "smart_alert", _AGREE, "cpu_max_pct", "mem_used_pct", "timestamp", "top_proc")


@query("m9_stream_facts", f"{KEYED_SQL} select host_id, line_no, smart_alert, true as agrees from d")
def m9_stream_facts(spark, sf):
    return m9_stream(spark, sf).selectExpr("host_id", "line_no", "smart_alert", _AGREE)


@query("m10_facts", f"{GLOBAL_SQL} select line_no, smart_alert, true as agrees, true as in_range from d")
def m10_facts(spark, sf):
    return m10(spark, sf).selectExpr("line_no", "smart_alert", _AGREE, "score > -1 and score < 0 as in_range")


@query("k4_facts", f"{ENTRIES_SQL} select count(*) as scored, 0.0::double as greatest_difference from e")
def k4_facts(spark, sf):
    table, model = trained(spark, sf)
    path = scratch_path(spark, "model")
    table_sink.write_model(model, path)
    before = forest.with_score(table, model).withColumnRenamed("score", "_before").select("line_no", "_before")
    after = forest.with_score(table, table_source.read_model(spark, path)).select("line_no", "score")
    return before.join(after, "line_no").agg(F.count(F.lit(1)).alias("scored"), F.max(F.abs(F.col("score") - F.col("_before"))).alias("greatest_difference"))


@query(
    "l3_facts",
    f"""{GLOBAL_SQL} select line_no, cpu_max_pct as cpu, mem_used_pct as mem, case when smart_alert = 1 then 'ANOMALY' else 'NORMAL' end as smart_label
    from d order by line_no limit 5""",
)
def l3_facts(spark, sf):
    return l3(spark, sf).select("line_no", "cpu", "mem", "smart_label")


@query("a9_facts", f"{ENTRIES_SQL} select count(*) as total, true as adds_up from e")
def a9_facts(spark, sf):
    table, model = trained(spark, sf)
    scored = materialize(scoring.scored_entries(table, model, block_rows=BLOCK), "scored")
    sums = scored.agg(F.sum("is_anomaly").alias("flagged"), F.count(F.lit(1)).alias("rows")).first()
    return stats.verdict_totals(scored).selectExpr(
        "total", f"normals + anomalies = total and anomalies = {sums.flagged} and total = {sums.rows} as adds_up"
    )


@query("a13_facts", f"{ENTRIES_SQL} select count(*) as total, true as below_quantile, 0.05::double as contamination from e")
def a13_facts(spark, sf):
    table, model = trained(spark, sf)
    scores = materialize(forest.with_score(table, model).select("score"), "scores")
    below = scores.where(F.col("score") < exact_quantile(scores, "score", 0.05)).count()
    report = a13(spark, sf)
    return report.selectExpr("total", f"anomalies = {below} and anomalies + normals = total as below_quantile", "contamination")


@query(
    "a6_forest",
    f"{ENTRIES_SQL} select count(*) filter (is_anomaly = 0) as normal, count(*) filter (is_anomaly = 1) as labelled, count(*) as total from e",
)
def a6_forest(spark, sf):
    table, model = trained(spark, sf)
    scored = forest.with_score(table, model).withColumn("iso_anomaly", forest.iso_flag(F.col("score"), model.meta["offset"]))
    return evaluate.confusion_matrix(scored, predicted="iso_anomaly").selectExpr("tn + fp as normal", "fn + tp as labelled", "tn + fp + fn + tp as total")


@query(
    "m6_mixed_sizes",
    """with v as (select case when event_id % 7 = 0 then null when event_id % 7 = 1 then 1e300 / (event_id + 1) when event_id % 7 = 2 then -1e-290 * event_id
      else (event_id % 1000) * 1e-3 end as x from events)
    select p, quantile_cont(x, 0.25) as at_quarter, round(quantile_cont(x, 0.9) / 1e295, 6) + 0.0 as at_most from v, (values (1)) t(p) where x is not null group by p""",
)
def m6_mixed(spark, sf):
    i = F.col("event_id")
    x = F.when(i % 7 == 0, F.lit(float("nan"))).when(i % 7 == 1, 1e300 / (i + 1)).when(i % 7 == 2, -1e-290 * i).otherwise((i % 1000) * 1e-3)
    values = materialize(events(spark, sf).select(x.alias("x")), "values")
    row = (1, exact_quantile(values, "x", 0.25), exact_quantile(values, "x", 0.9))
    return values.limit(1).select(F.lit(row[0]).alias("p"), F.lit(row[1]).alias("at_quarter"), (F.round(F.lit(row[2] / 1e295), 6) + F.lit(0.0)).alias("at_most"))


@query("m5_score")
def m5(spark, sf):
    table, model = trained(spark, sf)
    return forest.with_score(table, model).select("line_no", "score")


_SCORE = "-0.35 - ((event_id*7919)%10007)/20014.0"


@query(
    "m6_threshold",
    """with s as (select -0.35 - cast((event_id*7919)%10007 as double)/20014 as score from events),
    o as (select quantile_cont(score, 0.05) as o from s)
    select round(max(o), 9) as threshold, count(*) filter (score < o) as flagged, count(*) as total from s, o""",
)
def m6(spark, sf):
    score = -0.35 - ((F.col("event_id") * 7919) % 10007).cast("double") / 20014
    scores = materialize(events(spark, sf).select(score.alias("score")), "scores")
    offset = exact_quantile(scores, "score", 0.05)
    return scores.agg(
        F.round(F.lit(offset), 9).alias("threshold"),
        F.count_if(forest.iso_flag(F.col("score"), offset) == 1).alias("flagged"),
        F.count(F.lit(1)).alias("total"),
    )


@query(
    "m6_arriving",
    """with s as (select -0.35 - cast((event_id*7919)%10007 as double)/20014 as score from events)
    select count(*) as total, round(quantile_cont(score, 0.05), 9) as threshold, true as estimate_near from s""",
)
def m6_arriving(spark, sf):
    # Scores arrive in four batches, each leaving a sketch; the threshold is then made exact.
    score = -0.35 - ((F.col("event_id") * 7919) % 10007).cast("double") / 20014
    scores = materialize(events(spark, sf).select(score.alias("score"), (F.col("event_id") % 4).alias("part")), "scores")
    folder = scratch_path(spark, "sketches")
    for i in range(4):
        sketches.add_batch(scores.where(F.col("part") == i), "score", folder, i)
    summary = sketches.merged(spark, folder)
    exact = sketches.quantile_by_sketch(scores, "score", 0.05, summary)
    near = abs(sketches.sketched_quantile(summary, 0.05) - exact) < 0.02
    return summary.select("n", F.round(F.lit(exact), 9).alias("threshold"), F.lit(near).alias("estimate_near")).withColumnRenamed("n", "total")


@query(
    "m7_map",
    """with s as (select event_id, -0.35 - cast((event_id*7919)%10007 as double)/20014 as score from events)
    select event_id, cast(case when score < -0.8 then -1 else 1 end as integer) as decision,
    cast(case when score < -0.8 then 1 else 0 end as integer) as iso_anomaly from s""",
)
def m7(spark, sf):
    score = -0.35 - ((F.col("event_id") * 7919) % 10007).cast("double") / 20014
    return events(spark, sf).select("event_id", score.alias("score")).select(
        "event_id", forest.decision(F.col("score"), -0.8).alias("decision"),
        forest.iso_flag(F.col("score"), -0.8).alias("iso_anomaly"),
    )


@query("m8_verdict")
def m8(spark, sf):
    table, model = trained(spark, sf)
    return scoring.scored_entries(table, model, block_rows=BLOCK).select(
        "line_no", "score", "iso_anomaly", "smart_alert", "is_anomaly", "label"
    )


@query("m9_score_lines")
def m9(spark, sf):
    _, model = trained(spark, sf)
    scored, _ = scoring.score_lines(log_lines(spark, sf), model, block_rows=BLOCK)
    return scored


@query(
    "m9_refused",
    f"""{ENTRIES_SQL} select line_no, value, case when value = '' then 'raw_log field is required'
    else 'Could not parse log line' end as error from p where parse_status <> 'parsed'""",
)
def m9_refused(spark, sf):
    _, model = trained(spark, sf)
    return scoring.score_lines(log_lines(spark, sf), model, block_rows=BLOCK)[1]


@query("m10_history")
def m10(spark, sf):
    table, model = trained(spark, sf)
    return scoring.scored_history(table, model, block_rows=BLOCK)


@query("m9_stream")
def m9_stream(spark, sf):
    _, model = trained(spark, sf)
    out = scratch_path(spark, "verdicts")
    arriving = P.parse_lines(lines_of(event_stream(spark, sf)))
    scoring.run_scored_stream(
        arriving, model, "host_id", out, scratch_path(spark, "progress"),
    ).awaitTermination()
    found = spark.read.option("recursiveFileLookup", True).parquet(out)
    return found.select("host_id", "line_no", "score", "iso_anomaly", "smart_alert", "is_anomaly", "label")


@query(
    "m9_model_versions",
    f"""{KEYED_SQL}, half as (select cast(floor(max(line_no) / 2) as bigint) as h from l)
    select host_id, line_no, smart_alert, cast(case when line_no <= h then 1 else 2 end as bigint) as model_version, true as agrees
    from d, half""",
)
def m9_versions(spark, sf):
    # Half of the entries arrive, another model is published, the rest arrives; each row has the score of its version.
    table = materialize(labels.flatten(entries(spark, sf)).select("host_id", "line_no", *FEATURES), "entries")
    models, inbox, out, progress = (scratch_path(spark, x) for x in ("models", "inbox", "verdicts", "progress"))
    half = log_lines(spark, sf).agg(F.floor(F.max("line_no") / 2)).first()[0]
    fitted = []
    for seed, part in ((1, table.where(F.col("line_no") <= half)), (2, table.where(F.col("line_no") > half))):
        fitted.append(forest.fit_forest(table, ["line_no"], seed=seed))
        versions.publish_model(fitted[-1], models)
        part.write.mode("append").parquet(inbox)
        arriving = replay.replay_lines(spark, inbox, schema=table.schema)
        versions.run_versioned_stream(arriving, models, "host_id", out, progress).awaitTermination()
    scores = [
        forest.with_score(table, m).select("host_id", "line_no", F.lit(i + 1).cast("long").alias("model_version"), round_exact("score", 4).alias("want"))
        for i, m in enumerate(fitted)
    ]
    found = spark.read.parquet(out).join(scores[0].unionByName(scores[1]), ["host_id", "line_no", "model_version"], "left")
    return found.select("host_id", "line_no", "smart_alert", "model_version", F.coalesce(F.col("score") == F.col("want"), F.lit(False)).alias("agrees"))


@query("k4_model")
def k4(spark, sf):
    table, model = trained(spark, sf)
    path = scratch_path(spark, "model")
    table_sink.write_model(model, path)
    return forest.with_score(table, table_source.read_model(spark, path)).select("line_no", "score")


@query(
    "m10_rolling_part",
    f"""{GLOBAL_SQL} select line_no, "timestamp", cpu_max_pct as cpu, mem_used_pct as mem, disk_read_mb as disk_r,
    disk_write_mb as disk_w, net_sent_mb as net_s, net_recv_mb as net_r, top_proc_name as proc, smart_alert, anomaly_type from d""",
)
def m10_rolling(spark, sf):
    # The columns of the history that do not depend on the forest's random draws.
    return m10(spark, sf).drop("score", "iso_anomaly", "is_anomaly", "label", "smart_reason")


@query("l3_first_scored")
def l3(spark, sf):
    table, model = trained(spark, sf)
    return scoring.first_scored(scoring.scored_entries(table, model, block_rows=BLOCK))


@query("a9_totals")
def a9(spark, sf):
    table, model = trained(spark, sf)
    return stats.verdict_totals(scoring.scored_entries(table, model, block_rows=BLOCK))


@query("a13_training_report")
def a13(spark, sf):
    table, model = trained(spark, sf)
    offset = model.meta["offset"]
    scored = forest.with_score(table, model).withColumn("iso_anomaly", forest.iso_flag(F.col("score"), offset))
    return table_sink.training_report(scored, model.meta["contamination"]).withColumn(
        "features", F.array_join("features", ",")
    )


@query(
    "k5_report",
    f"""{A8_SQL.replace('select *, round', 'select cast(20 as integer) as rolling_window, 2.0::double as z_threshold, static_fp, smart_fp, smart_tp, smart_fn, smart_tn, static_fp - smart_fp as fp_eliminated, 80.0::double as static_cpu_thresh, 85.0::double as static_mem_thresh, round', 1)}""".split(
        ", round(100.0*static_fp"
    )[0]
    + " from c",
)
def k5(spark, sf):
    path = scratch_path(spark, "report")
    table = entries(spark, sf).withColumn("iso_anomaly", F.col("is_anomaly"))
    table_sink.write_report(table_sink.training_report(table, 0.05), path)
    compared = evaluate.compare_detectors(found(spark, sf))
    table_sink.merge_rolling(evaluate.rolling_report(compared), path)
    return table_source.read_rolling_section(spark, path)


# --- streams -----------------------------------------------------------------


def event_stream(spark, sf):
    return (
        spark.readStream.schema(events(spark, sf).schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )


@query("t1_stream_alerts", f"{ENTRIES_SQL} {_ALERTS_SQL.replace('line_no,', 'line_no as kafka_offset,')}")
def t1(spark, sf):
    out = scratch_path(spark, "alerts")
    messages = kafka.to_messages(envelopes(lines_of(event_stream(spark, sf))))
    alert_stream.run_alerts(
        kafka.open_envelopes(messages), out, scratch_path(spark, "alerts-progress")
    ).awaitTermination()
    return alert_sink.alerts(spark.read.parquet(out), ["kafka_offset"])


@query(
    "a10_stream_counts",
    f"""{ENTRIES_SQL} select (select count(*) from l where trim(value) <> '' and not contains(value, '===')
      and not contains(value, 'Log generator')) as received,
    count(*) as parsed, cast(sum(is_anomaly) as bigint) as anomalies from e""",
)
def a10(spark, sf):
    counts = replayed(spark, sf)[1]
    return alert_stream.stream_counts(spark, counts).select("received", "parsed", "anomalies")


@query("a10_stream_rates", f"{LINES_SQL} select count(*) as rows, cast(8 as bigint) as batches, true as rated from l")
def a10_rates(spark, sf):
    # Eight files, one a batch, with a restart half way; the figures come from the listener's table.
    inbox, out, checkpoint, folder = (scratch_path(spark, x) for x in ("inbox", "sent", "sent-progress", "rates"))
    lines = log_lines(spark, sf).select("line_no", "value")
    table = progress_table.ProgressTable(spark, folder)
    spark.streams.addListener(table)
    try:
        for half in (0, 1):
            lines.where(F.col("line_no") % 2 == half).repartition(4).write.mode("append").parquet(inbox)
            run = (
                replay.replay_lines(spark, inbox, max_files=1).writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            )
            run.awaitTermination()
            table.finish(run)
    finally:
        spark.streams.removeListener(table)
    found = progress_table.rates(progress_table.read_progress(spark, folder))
    return found.select("rows", "batches", (F.col("rows_per_second") > 0).alias("rated"))


# Bytes of a row group: what a task can read of a file, so that a batch of one file is read by several.
ROW_GROUP = 1 << 20


def replayed(spark, sf, batches: int = 124):
    """The lines as so many files, one a batch, with a restart half way: entries, counts and number of batches."""
    inbox, out, progress = (scratch_path(spark, x) for x in ("inbox", "alerts", "alerts-progress"))
    lines = log_lines(spark, sf).select("line_no", "value").withColumn("half", F.col("line_no") % 2)
    for half in (0, 1):
        part = lines.where(F.col("half") == half).drop("half")
        files = part.repartition(batches // 2, "line_no").sortWithinPartitions("line_no").write.mode("append")
        files.option("parquet.block.size", ROW_GROUP).parquet(inbox)
        sent = envelopes(replay.replay_lines(spark, inbox, max_files=1))
        alert_stream.run_alerts(sent, out, progress).awaitTermination()
    counts = alert_stream.counts_path(progress)
    return spark.read.parquet(out), counts, spark.read.parquet(counts).select("batch").distinct().count()


@query("t3_resume", f"{ENTRIES_SQL} select line_no as kafka_offset, is_anomaly from e")
def t3(spark, sf):
    return replayed(spark, sf, 8)[0].select("kafka_offset", F.col("is_anomaly").cast("int").alias("is_anomaly"))


@query("t4_back_pressure", f"{ENTRIES_SQL} select count(*) as parsed, true as bounded from e")
def t4(spark, sf):
    # Eight files, one allowed in a batch: at least eight batches, and none above its file.
    entries_, counts, batches = replayed(spark, sf, 8)
    most = spark.read.parquet(counts).agg(F.max("received") <= F.lit(-(-log_lines(spark, sf).count() // 4))).first()[0]
    return entries_.agg(F.count(F.lit(1)).alias("parsed"), F.lit(bool(batches >= 8 and most)).alias("bounded"))


@query(
    "t5_drained",
    f"""{LINES_SQL} select line_no from l
    where trim(value) <> '' and not contains(value, '===') and not contains(value, 'Log generator')""",
)
def t5(spark, sf):
    # The query ends by itself and has taken all that was there.
    out = scratch_path(spark, "drained")
    run = (
        envelopes(lines_of(event_stream(spark, sf))).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "drained-progress")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(out).select("line_no")


@query(
    "s4_replay_text",
    f"""{LINES_SQL} select line_no, value from l
    where trim(value) <> '' and not contains(value, '===') and not contains(value, 'Log generator')""",
)
def s4_text(spark, sf):
    # The log in files by range; a line's number is that in its file and the lines of the files before it.
    folder, inbox, out = (scratch_path(spark, x) for x in ("text", "numbered", "sent"))
    log_lines(spark, sf).repartitionByRange("line_no").sortWithinPartitions("line_no").select("value").write.text(folder)
    numbered = replay.replay_log(spark, folder, inbox)
    sizes = spark.read.parquet(inbox).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = numbered.join(F.broadcast(sizes.select("file", before.alias("_before"))), "file")
    sent = envelopes(placed.select((F.col("line_no") + F.col("_before")).alias("line_no"), "value"))
    (
        sent.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "sent-progress")).trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(out).select("line_no", F.col("raw_log").alias("value"))


@query("s4_follow", f"{LINES_SQL} select line_no, value from l")
def s4_follow(spark, sf):
    # The log in files by range, half of them written after the first run of the stream.
    folder, out, progress = (scratch_path(spark, x) for x in ("growing", "followed", "follow-progress"))
    lines = log_lines(spark, sf).select("line_no", "value")
    half = lines.agg(F.max("line_no")).first()[0] // 2

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for i, part in enumerate((lines.where(F.col("line_no") <= half), lines.where(F.col("line_no") > half))):
        ordered = part.repartitionByRange("line_no").sortWithinPartitions("line_no")
        ordered.select("value").write.text(f"{folder}/{i}")
        follow.run_numbered(follow.follow_log(spark, folder, "part-*"), store, progress).awaitTermination()
    found = spark.read.parquet(out)
    sizes = found.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = found.join(F.broadcast(sizes.select("file", before.alias("_before"))), "file")
    return placed.select((F.col("line_no") + F.col("_before")).alias("line_no"), "value")


@query(
    "s4_replay",
    f"""{LINES_SQL} select line_no, value from l
    where trim(value) <> '' and not contains(value, '===') and not contains(value, 'Log generator')""",
)
def s4(spark, sf):
    inbox, out = scratch_path(spark, "log"), scratch_path(spark, "replayed")
    log_lines(spark, sf).select("line_no", "value").repartition(4).write.parquet(inbox)
    sent = envelopes(replay.replay_lines(spark, inbox, max_files=2))
    (
        sent.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "replay-progress"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(out).select("line_no", F.col("raw_log").alias("value"))


def _chunks(spark, sf, n: int = 3):
    """The entries in ``n`` parts by line number, as they would arrive."""
    table = materialize(
        entries(spark, sf).select("host_id", "line_no", "cpu_max_pct", "mem_used_pct", "is_anomaly"),
        "arrivals",
    )
    last = table.agg(F.max("line_no")).first()[0]
    for i in range(n):
        low, high = last * i // n, last * (i + 1) // n
        yield table.where((F.col("line_no") > low) & (F.col("line_no") <= high))


_T2_SQL = f"""{KEYED_SQL} select host_id, line_no, is_anomaly, {six_sql('cpu_z', 'mem_z')}, smart_alert from d"""


def _t2(spark, sf, start) -> DataFrame:
    """Let parts arrive one after the other; the query is restarted for each."""
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "found")
    for part in _chunks(spark, sf):
        part.write.mode("append").parquet(inbox)
        start(replay.replay_lines(spark, inbox, schema=part.schema), out).awaitTermination()
    return (
        spark.read.option("recursiveFileLookup", True).parquet(out)
        .select("host_id", "line_no", "is_anomaly", *six("cpu_z", "mem_z"), "smart_alert")
    )


@query("t2_stream_baseline", _T2_SQL)
def t2(spark, sf):
    progress = scratch_path(spark, "progress")
    return _t2(
        spark, sf,
        lambda arriving, out: baseline_stream.run_stateful(
            arriving, "host_id", out, progress, carry=["is_anomaly"]
        ),
    )


@query("t2_keyed_state", _T2_SQL)
def t2_keyed(spark, sf):
    progress = scratch_path(spark, "progress")
    return _t2(
        spark, sf,
        lambda arriving, out: baseline_stream.run_keyed(
            arriving, "host_id", out, progress, carry=["is_anomaly"]
        ),
    )


@query("t3_resent", f"{ENTRIES_SQL} select line_no as kafka_offset, is_anomaly from e")
def t3_resent(spark, sf):
    # Every message twice, some of them only after a restart: each entry once.
    inbox, out, progress = (scratch_path(spark, x) for x in ("inbox", "found", "progress"))
    lines = log_lines(spark, sf).select("line_no", "value")
    half = lines.agg(F.max("line_no")).first()[0] // 2
    for part in (lines.where(F.col("line_no") <= half), lines.where(F.col("line_no") > half // 2), lines):
        kafka.to_messages(envelopes(part)).write.mode("append").text(inbox)
        sent = alert_stream.sent_once(kafka.open_envelopes(spark.readStream.text(inbox)), "3650 days")
        alert_stream.run_alerts(sent, out, progress).awaitTermination()
    return spark.read.parquet(out).select("kafka_offset", "is_anomaly")


@query("t6_stream_totals", f"{ENTRIES_SQL} select is_anomaly, count(*) as entries from e group by all")
def t6(spark, sf):
    out = scratch_path(spark, "totals")
    arriving = P.parse_lines(lines_of(event_stream(spark, sf)))
    alert_stream.run_totals(arriving, out, scratch_path(spark, "totals-progress")).awaitTermination()
    return spark.read.parquet(out)
