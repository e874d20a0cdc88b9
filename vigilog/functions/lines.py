"""Metric record -> log line, severity and unit conversion."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.numeric import float_text_sql, round_exact


def severity(status: Column) -> Column:
    return F.when(status == "NORMAL", "INFO").otherwise("WARNING")


_NUMBERS = [
    ("] MEM_PCT:", "mem_used_pct"), (" MEM_AVAIL:", "mem_avail_mb"),
    ("MB DISK_R:", "disk_read_mb"), ("MB DISK_W:", "disk_write_mb"),
    ("MB NET_S:", "net_sent_mb"), ("MB NET_R:", "net_recv_mb"),
]


def log_line() -> Column:
    """The text that ``functions.parse`` reads back, from columns named as in an entry.

    ``top_proc`` is the text after ``TOP_PROC:``; the level follows the status.
    """
    cores = f"array_join(transform(cpu_cores, x -> {float_text_sql('x')}), ',')"
    numbers = ", ".join(f"'{label}', {float_text_sql(c)}" for label, c in _NUMBERS)
    return F.concat(
        F.col("timestamp"), F.lit(" | "), F.rpad(severity(F.col("status")), 8, " "),
        F.expr(f"concat(' | CPU:[', {cores}, {numbers}, 'MB TOP_PROC:', top_proc, ' STATUS:', status)"),
    )


def metric_lines(metrics: DataFrame) -> DataFrame:
    """Metrics table (timestamp, readings, top process, status) -> ``line_no, value``."""
    return metrics.select("line_no", log_line().alias("value"))


def with_megabytes(df: DataFrame, counters: dict[str, tuple[str, int]]) -> DataFrame:
    """Byte counters to MB: ``{output: (byte column, decimals)}``; null gives 0.0."""
    raw = {
        f"_{out}": F.coalesce(F.col(src).cast("double") / 1048576, F.lit(0.0))
        for out, (src, _) in counters.items()
    }
    return (
        df.withColumns(raw)
        .withColumns({out: round_exact(f"_{out}", d) for out, (_, d) in counters.items()})
        .drop(*raw)
    )
