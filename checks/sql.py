"""SQL fragments for DuckDB: lines, parse, rolling window."""

from checks.inputs import LINES, METRICS

HEADER = (
    "={10,}|Log generator|PID\\s+:|Log file|Interval|Anomaly|Generator stopped"
)
# The input format written out again, apart from the engine's own.
_NUMBER = "([0-9.]+)"
_READINGS = (("MEM_PCT:", ""), ("MEM_AVAIL:", "MB"), ("DISK_R:", "MB"), ("DISK_W:", "MB"), ("NET_S:", "MB"), ("NET_R:", "MB"))
LINE_PATTERN = (
    "([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2})\\s+[|]\\s+([0-9A-Za-z_]+)\\s+[|]\\s+CPU:[[]([0-9.,\\s]+)[]]"
    + "".join(f"\\s+{name}{_NUMBER}{unit}" for name, unit in _READINGS)
    + f"\\s+TOP_PROC:pid=([0-9]+)\\s+name=([0-9A-Za-z_]+)\\s+cpu={_NUMBER}%\\s+STATUS:(\\S+)"
)
TYPE_PATTERN = "ANOMALY:(CPU_SPIKE|MEM_SPIKE|DISK_FLOOD|NET_FLOOD)"
CAPTURES = "timestamp level cpu mem_pct mem_avail disk_r disk_w net_s net_r pid proc_name proc_cpu status".split()
_NAMES = "[" + ",".join(f"'{c}'" for c in CAPTURES) + "]"


def fixed(x: str, digits: int) -> str:
    """Exact binary rounding, half to even, as a double."""
    return f"cast(format('{{:.{digits}f}}', {x}) as double)"


def parse_of(lines: str) -> str:
    """CTEs from lines ``{lines}`` to ``p``: captures, numbers and a status."""
    return f"""h as (
 select *, not regexp_matches(value, '{HEADER}') and regexp_matches(value, '{LINE_PATTERN}') as hit,
  regexp_extract(value, '{LINE_PATTERN}', {_NAMES}) as g from {lines}),
n as (
 select *, list_transform(list_filter(list_transform(string_split(g.cpu, ','), lambda x: trim(x)), lambda x: x <> ''),
   lambda x: try_cast(x as double)) as cores,
  try_cast(g.mem_pct as double) as mem_used_pct, try_cast(g.mem_avail as double) as mem_avail_mb,
  try_cast(g.disk_r as double) as disk_read_mb, try_cast(g.disk_w as double) as disk_write_mb,
  try_cast(g.net_s as double) as net_sent_mb, try_cast(g.net_r as double) as net_recv_mb,
  try_cast(g.pid as bigint) as top_pid, try_cast(g.proc_cpu as double) as top_proc_cpu,
  coalesce(nullif(regexp_extract(g.status, '{TYPE_PATTERN}', 1), ''), 'none') as anomaly_type
 from h),
p as (
 select *, case when not hit then 'skipped'
   when len(cores) = 0 or len(list_filter(cores, lambda x: x is null)) > 0 or mem_used_pct is null or mem_avail_mb is null
     or disk_read_mb is null or disk_write_mb is null or net_sent_mb is null or net_recv_mb is null
     or top_pid is null or top_proc_cpu is null then 'error'
   else 'parsed' end as parse_status
 from n),
e as (
 select * exclude (g, hit, cores, status_text), status_text as status from (
  select p.* , g."timestamp" as "timestamp", g."level" as "level", list_max(cores) as cpu_max_pct,
   {fixed('list_sum(cores)/len(cores)', 2)} as cpu_avg_pct, g.proc_name as top_proc_name,
   g.status as status_text, cast(anomaly_type <> 'none' as integer) as is_anomaly
  from p where parse_status = 'parsed'))"""


LINES_SQL = "with " + LINES.format(events="events")
METRICS_SQL = "with " + METRICS.format(events="events")
ENTRIES_SQL = LINES_SQL + ",\n" + parse_of("l")

FLAT = (
    '"timestamp", "level", cpu_max_pct, cpu_avg_pct, mem_used_pct, mem_avail_mb, disk_read_mb, '
    "disk_write_mb, net_sent_mb, net_recv_mb, top_pid, top_proc_name, top_proc_cpu, status, "
    "is_anomaly, anomaly_type, line_no"
)


def rolling(key: str | None) -> str:
    """CTEs ``w`` (window) and ``d`` (checks and alerts) over ``e``."""
    part = f"partition by {key} " if key else ""
    frame = f"over ({part}order by line_no rows between 20 preceding and 1 preceding)"

    def check(m: str, v: str) -> str:
        return f"""case when history >= 5 and not {m}_s < 1e-6 then ({v} - {m}_m) / {m}_s else 0.0 end as {m}_z,
   case when history >= 5 then {m}_m else {v} end as {m}_mean,
   case when history >= 5 then {m}_s else 0.0 end as {m}_std"""

    return f"""w as (
 select *, count(*) {frame} as history,
  avg(cpu_max_pct) {frame} as cpu_m, stddev_pop(cpu_max_pct) {frame} as cpu_s,
  avg(mem_used_pct) {frame} as mem_m, stddev_pop(mem_used_pct) {frame} as mem_s
 from e),
z as (
 select *, {check('cpu', 'cpu_max_pct')},
  {check('mem', 'mem_used_pct')}
 from w),
d as (
 select *, cast(cpu_z > 2.0 or mem_z > 2.0 as integer) as smart_alert,
  cast(cpu_max_pct > 80.0 or mem_used_pct > 85.0 as integer) as static_alert
 from z)"""


GLOBAL_SQL = ENTRIES_SQL + ",\n" + rolling(None)
KEYED_SQL = ENTRIES_SQL + ",\n" + rolling("host_id")
