"""Log line -> typed entry, as Spark columns.

The line pattern runs once per line: one ``regexp_replace`` rewrites a line to
its captures, joined by a separator, and the rest is array access.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.numeric import round_exact_sql
from vigilog.schema import ENTRY_COLUMNS

# The line format. (?U) makes \w, \d and \s cover Unicode.
LINE_PATTERN = (
    r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
    r"\s+\|\s+(\w+)"
    r"\s+\|\s+CPU:\[([\d.,\s]+)\]"
    r"\s+MEM_PCT:([\d.]+)"
    r"\s+MEM_AVAIL:([\d.]+)MB"
    r"\s+DISK_R:([\d.]+)MB"
    r"\s+DISK_W:([\d.]+)MB"
    r"\s+NET_S:([\d.]+)MB"
    r"\s+NET_R:([\d.]+)MB"
    r"\s+TOP_PROC:pid=(\d+)"
    r"\s+name=(\w+)"
    r"\s+cpu=([\d.]+)%"
    r"\s+STATUS:(\S+)"
)
CAPTURES = [
    "timestamp", "level", "cpu", "mem_pct", "mem_avail", "disk_r", "disk_w",
    "net_s", "net_r", "pid", "proc_name", "proc_cpu", "status",
]
# Texts that mark a header line wherever they stand.
HEADER_TEXTS = [
    "==========", "Log generator", "Log file", "Interval", "Anomaly", "Generator stopped",
]
HEADER_PID = r"(?U)PID\s+:"
# Known anomaly types.
ANOMALY_TYPES = ["CPU_SPIKE", "MEM_SPIKE", "DISK_FLOOD", "NET_FLOOD"]
TYPE_PATTERN = "ANOMALY:(" + "|".join(ANOMALY_TYPES) + ")"

_SEP = "\x1f"
_REWRITE = "(?sU)^.*?" + LINE_PATTERN + ".*$"
_REPLACEMENT = _SEP.join(f"${i}" for i in range(1, len(CAPTURES) + 1))

PARSED, SKIPPED, ERROR = "parsed", "skipped", "error"


def _header_sql(line: str) -> str:
    texts = [f"contains({line}, '{t}')" for t in HEADER_TEXTS]
    pid = f"(contains({line}, 'PID') and {line} rlike r'{HEADER_PID}')"
    return "(" + " or ".join([*texts, pid]) + ")"


def _captures_sql(line: str) -> str:
    """The 13 captured texts as an array; null for a header, other sizes for no match.

    A line that itself holds the separator takes the slower way, one extraction
    per capture.
    """
    pattern = f"r'(?U){LINE_PATTERN}'"
    parts = f"split(regexp_replace({line}, r'{_REWRITE}', '{_REPLACEMENT}'), '{_SEP}')"
    single = ", ".join(f"regexp_extract({line}, {pattern}, {i + 1})" for i in range(len(CAPTURES)))
    return (
        f"case when {_header_sql(line)} then null when contains({line}, '{_SEP}') "
        f"then case when {line} rlike {pattern} then array({single}) end else {parts} end"
    )


def _capture(name: str) -> str:
    return f"get(_m, {CAPTURES.index(name)})"


# 12.3,8.1 -> array of doubles; blanks around a number and empty items are dropped,
# an invalid number becomes a null element.
_CPU = _capture("cpu")
_CORES = (
    f"try_cast(array_remove(split(case when {_CPU} rlike r'(?U)\\s' "
    f"then regexp_replace({_CPU}, r'(?U)^\\s+|\\s+$|\\s*(,)\\s*', '$1') else {_CPU} end, ','), '') "
    "as array<double>)"
)
_MEAN = "try_divide(aggregate(_cores, 0D, (acc, v) -> acc + v), size(_cores))"
_NUMBERS = {
    "mem_used_pct": "mem_pct", "mem_avail_mb": "mem_avail",
    "disk_read_mb": "disk_r", "disk_write_mb": "disk_w",
    "net_sent_mb": "net_s", "net_recv_mb": "net_r", "top_proc_cpu": "proc_cpu",
}
_VALID = " and ".join(
    f"{c} is not null" for c in ("_mean", "_top_pid", *[f"_{c}" for c in _NUMBERS])
)
_STATE = f"case when _m is null then '{SKIPPED}' when {_VALID} then '{PARSED}' else '{ERROR}' end"
_FIELDS = {
    "timestamp": _capture("timestamp"),
    "level": _capture("level"),
    "cpu_cores": "_cores",
    "cpu_max_pct": "array_max(_cores)",
    "cpu_avg_pct": round_exact_sql("_mean", 2),
    **{c: f"_{c}" for c in _NUMBERS},
    "top_pid": "_top_pid",
    "top_proc_name": _capture("proc_name"),
    "status": _capture("status"),
    "is_anomaly": "cast(_type <> 'none' as int)",
    "anomaly_type": "_type",
}


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"(?U)\S")


def is_header(line: str) -> Column:
    """Header pattern anywhere in the line; literal searches, a regex only where needed."""
    return F.expr(_header_sql(line))


def is_replay_noise(line: Column) -> Column:
    """Lines a log replay never sends: blank, ``===`` or the generator banner."""
    return is_blank(line) | line.contains("===") | line.contains("Log generator")


def anomaly_type_sql(status: str) -> str:
    """Known anomaly type named in the status, else ``none``."""
    return f"coalesce(nullif(regexp_extract({status}, '{TYPE_PATTERN}', 1), ''), 'none')"


def with_parse(df: DataFrame, line: str = "value", status: str = "parse_status") -> DataFrame:
    """Add the entry columns and a three-way ``parse_status`` to ``df``.

    ``parsed``: a valid entry. ``skipped``: blank, header or no match.
    ``error``: the pattern matches but a number or the CPU list is invalid.
    The other columns, the raw line among them, stay, so the rows that are not
    entries can be kept as a quarantine table.

    The final ``inline`` is a barrier: a filter on the status is not pushed
    below it, which would run the pattern a second time for every line.
    """
    keep = [F.col(c) for c in df.columns if c not in (*ENTRY_COLUMNS, status)]
    numbers = [f"try_cast({_capture(src)} as double) as _{c}" for c, src in _NUMBERS.items()]
    record = ", ".join(
        f"'{c}', case when _state = '{PARSED}' then {_FIELDS[c]} end" for c in ENTRY_COLUMNS
    )
    return (
        df.select(*keep, F.expr(f"{_captures_sql(line)} as _parts"))
        .selectExpr("*", f"case when size(_parts) = {len(CAPTURES)} then _parts end as _m")
        .selectExpr(
            "*",
            f"{_CORES} as _cores",
            f"{anomaly_type_sql(_capture('status'))} as _type",
            f"try_cast({_capture('pid')} as bigint) as _top_pid",
            *numbers,
        )
        .selectExpr("*", f"{_MEAN} as _mean")
        .selectExpr("*", f"{_STATE} as _state")
        .select(*keep, F.expr(f"inline(array(named_struct({record}, '{status}', _state)))"))
    )


def entries(parsed: DataFrame, status: str = "parse_status") -> DataFrame:
    """The valid entries of a ``with_parse`` result."""
    return parsed.where(F.col(status) == PARSED).drop(status)


def quarantine(parsed: DataFrame, line: str = "value", status: str = "parse_status") -> DataFrame:
    """Lines that gave no entry, with the reason."""
    rest = [c for c in parsed.columns if c not in (*ENTRY_COLUMNS, line, status)]
    return parsed.where(F.col(status) != PARSED).select(*rest, line, status)


def parse_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines in, valid entries out (other columns of ``df`` kept, text dropped)."""
    return entries(with_parse(df, line)).drop(line)


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``ts``; null where the text is no real date, e.g. ``2026-99-99``."""
    return df.withColumn(
        "ts", F.expr("try_cast(timestamp AS timestamp_ntz)")
    )
