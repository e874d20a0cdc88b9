"""Rolling baseline, z-score check, smart alert and static thresholds.

A reading is compared with the up to 20 readings before it in its stream. The
window is computed block by block, so one stream that holds most of the data
still spreads over all tasks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions.numeric import (
    deviation_sql, float_text_sql, mean_sql, round_exact, round_exact_sql,
)
from vigilog.functions.settle import settle
from vigilog.schema import (
    MIN_HISTORY, ROLLING_WINDOW, STATIC_CPU, STATIC_MEM, STD_FLOOR, Z_THRESHOLD,
)
from vigilog.storage import materialize

CPU, MEM = "cpu_max_pct", "mem_used_pct"
BLOCK_ROWS = 1 << 20
MAX_BROADCAST_STREAMS = 1_000_000
# Blocks whose tails are handed on together.
FAN = 1024


def with_baseline(
    df: DataFrame,
    stream_key: str | None = None,
    order_col: str = "line_no",
    carry: list[str] | None = None,
    window: int = ROLLING_WINDOW,
    block_rows: int = BLOCK_ROWS,
    dense: bool = False,
    cut: bool = True,
) -> DataFrame:
    """Mean and population deviation of the previous ``window`` readings.

    ``order_col`` is an integer, unique within its stream (or overall, without
    ``stream_key``). A stream is cut into blocks of at most ``block_rows`` rows,
    however large it is. Rows are shuffled once, by (stream, block). The last
    ``window`` rows of every block ("tail") are taken from the same shuffle
    output, handed on to the next block of the stream, across thin blocks too,
    and dropped after the window is evaluated. Only the tails are ever ordered
    per stream; they hold the order and the two readings, not what is carried.

    ``dense`` says that the order values of a stream are nearly consecutive, as
    line numbers of a file are; then every block spans ``block_rows`` of them.
    Otherwise (the default) a counting pass over key and order finds spans that
    fill the blocks, see ``block_widths``. Without ``cut`` each stream is one block,
    for tables known to hold fewer than ``block_rows`` rows, such as a micro-batch.

    Missing readings count as NaN and, as in any mean, silence the checks while
    they are in the window. Pass in ``carry`` the other columns to keep; what is
    kept travels through the shuffle, so name only what is used afterwards.
    """
    key = [stream_key] if stream_key else []
    names = [*key, order_col, CPU, MEM, *(carry or [])]
    nan = F.lit(float("nan"))
    rows = df.select(
        *[F.coalesce(F.col(c), nan).alias(c) if c in (CPU, MEM) else F.col(c) for c in names]
    )
    if not cut:
        rows = rows.withColumn("_block", F.lit(0).cast("bigint"))
    elif dense:
        rows = rows.withColumn("_block", _floor_to(order_col, F.lit(block_rows)))
    else:
        widths = block_widths(df, stream_key, order_col, block_rows)
        rows = _join_widths(rows, widths, stream_key)
        block = F.when(F.col("_width").isNull(), F.lit(0).cast("bigint"))
        rows = rows.select(
            *names, block.otherwise(_floor_to(order_col, F.col("_width"))).alias("_block")
        )
    home = [*key, "_block"]
    placed = rows.repartition(*home)

    newest = Window.partitionBy(*home).orderBy(F.desc(order_col))
    # Always true; it names every column, so that rows and tails read one and the same shuffle.
    shared = F.hash(*names) >= F.lit(-(1 << 31))
    tails = (
        placed.withColumn("_rank", F.row_number().over(newest))
        .where((F.col("_rank") <= window) & shared)
        .groupBy(*home)
        .agg(F.sort_array(F.collect_list(F.struct(order_col, CPU, MEM))).alias("_tail"))
    )
    halo = (
        _handed_on(tails, key, window, block_rows).select(*home, F.explode("_before").alias("_h"))
        .select(
            *key, *[F.col(f"_h.{c}").alias(c) for c in (order_col, CPU, MEM)], "_block",
            F.lit(True).alias("_copy"),
        )
        .repartition(*home)
    )

    over = (
        f"over (partition by {', '.join(f'`{c}`' for c in home)} order by `{order_col}` "
        f"rows between {window} preceding and 1 preceding)"
    )
    kept = [f"`{c}`" for c in names]
    figures = (
        placed.withColumn("_copy", F.lit(False))
        .unionByName(halo, allowMissingColumns=True)
        .selectExpr(
            *kept, "_copy",
            f"collect_list({CPU}) {over} as _cpu", f"collect_list({MEM}) {over} as _mem",
        )
        .where("not _copy")
        .selectExpr(
            *kept, "_cpu", "_mem", "cast(size(_cpu) as bigint) as history",
            f"{mean_sql('_cpu', window)} as cpu_mean", f"{mean_sql('_mem', window)} as mem_mean",
        )
        .selectExpr(
            *kept, "history", "cpu_mean", f"{deviation_sql('_cpu', 'cpu_mean', window)} as cpu_std",
            "mem_mean", f"{deviation_sql('_mem', 'mem_mean', window)} as mem_std",
        )
    )
    return settle(figures, "history", "cpu_mean", "cpu_std", "mem_mean", "mem_std")


def _handed_on(tails: DataFrame, key: list[str], window: int, block_rows: int) -> DataFrame:
    """``_before`` for each block: the last readings of the blocks before it.

    Every block has at least one row, so ``window`` earlier blocks are enough. They are found
    within spans of ``FAN`` blocks, and for the first ones of a span among the tails of the spans
    before it, one row for each ``FAN`` blocks; so no task orders all tails of a stream.
    """
    newest = lambda readings: F.slice(readings, F.greatest(F.size(readings) - (window - 1), F.lit(1)), F.lit(window))
    joined = lambda blocks: F.flatten(F.transform(blocks, lambda b: b["_tail"]))
    spans = tails.groupBy(*key, _floor_to("_block", F.lit(block_rows * FAN)).alias("_span")).agg(
        F.sort_array(F.collect_list(F.struct("_block", "_tail"))).alias("_blocks")
    )
    earlier = Window.partitionBy(*key).orderBy("_span").rowsBetween(-window, -1)
    placed = spans.withColumn("_end", newest(joined(F.col("_blocks")))).withColumn("_outside", F.flatten(F.collect_list("_end").over(earlier)))
    inside = lambda i: joined(F.slice("_blocks", F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window))))
    handed = F.transform(
        F.sequence(F.lit(0), F.size("_blocks") - 1),
        lambda i: F.struct(F.get("_blocks", i)["_block"].alias("_block"), newest(F.concat("_outside", inside(i))).alias("_before")),
    )
    return placed.select(*key, F.explode(handed).alias("_b")).select(*key, "_b.*")


def _floor_to(order_col: str, width: Column) -> Column:
    order = F.col(order_col).cast("bigint")
    return order - F.pmod(order, width.cast("bigint"))


def block_widths(df: DataFrame, stream_key: str | None, order_col: str, block_rows: int) -> DataFrame:
    """Span of order values per block, for the streams of more than ``block_rows`` rows.

    Slots of ``block_rows`` order values are counted; a block joins as many slots
    as hold no more than ``block_rows`` rows even where the stream is densest.
    Smaller streams have no row here, they are one block. Without this, a stream
    that owns one in a thousand of shared order values would fall into blocks of
    a few rows, and the copied tails would outnumber the rows.
    """
    key = [F.col(stream_key).alias("_stream")] if stream_key else []
    slots = df.groupBy(*key, _floor_to(order_col, F.lit(block_rows)).alias("_slot")).agg(
        F.count(F.lit(1)).alias("n")
    )
    joined = F.expr(f"greatest(1, {block_rows} div max(n))")
    sizes = slots.groupBy(*(["_stream"] if key else [])).agg(
        F.sum("n").alias("rows"), (F.lit(block_rows) * joined).alias("_width")
    )
    return sizes.where(F.col("rows") > block_rows).drop("rows")


def _join_widths(rows: DataFrame, widths: DataFrame, stream_key: str | None) -> DataFrame:
    """Add ``_width``, null for the streams that are one block.

    There is at most one large stream per ``block_rows`` rows of input. They are
    counted first: up to a million are broadcast, beyond that the join shuffles
    the rows, where adaptive execution splits the large streams.
    """
    if stream_key is None:
        found = widths.first()
        return rows.withColumn("_width", F.lit(found._width if found else None).cast("bigint"))
    widths = materialize(widths, "widths")
    streams = widths.count()
    if not streams:
        return rows.withColumn("_width", F.lit(None).cast("bigint"))
    if streams <= MAX_BROADCAST_STREAMS:
        widths = F.broadcast(widths)
    same = F.col(stream_key).eqNullSafe(F.col("_stream"))
    return rows.join(widths, same, "left").drop("_stream")


def _check(metric: str, value: str) -> dict[str, Column]:
    """z, mean and std of one reading; unrounded."""
    enough = f"history >= {MIN_HISTORY}"
    mean, std = f"{metric}_mean", f"{metric}_std"
    return {
        f"{metric}_z": F.expr(
            f"case when {enough} and not {std} < {STD_FLOOR:.9f}D "
            f"then try_divide({value} - {mean}, {std}) else 0D end"
        ),
        mean: F.expr(f"case when {enough} then {mean} else {value} end"),
        std: F.expr(f"case when {enough} then {std} else 0D end"),
    }


def with_zscores(df: DataFrame) -> DataFrame:
    """Add ``{cpu,mem}_{z,above}`` and settle mean and std to the check's outputs.

    Fewer than 5 earlier readings: no alert, mean is the value itself. Spread
    below 1e-6: no alert. Otherwise an alert if z > 2, upper tail only.
    """
    # Spark orders NaN above every number; a NaN score is no alert.
    return df.withColumns({**_check("cpu", CPU), **_check("mem", MEM)}).withColumns(
        {
            f"{m}_above": F.expr(f"{m}_z > {Z_THRESHOLD}D and not isnan({m}_z)")
            for m in ("cpu", "mem")
        }
    )


def with_rounded_check(df: DataFrame) -> DataFrame:
    """Add the displayed figures: z to 3, mean and std to 2 decimals."""
    return df.withColumns(
        {
            f"{m}_{k}_shown": round_exact(f"{m}_{k}", digits)
            for m in ("cpu", "mem")
            for k, digits in (("z", 3), ("mean", 2), ("std", 2))
        }
    )


def _reason(label: str, metric: str, value: str) -> str:
    """SQL text of one reason; lambdas keep the rarely used formatting out of the main code."""
    rounded = (
        f"concat(transform(array({metric}_z), x -> {round_exact_sql('x', 3)}), array({value}), "
        f"transform(array({metric}_mean, {metric}_std), x -> {round_exact_sql('x', 2)}))"
    )
    texts = f"transform({rounded}, x -> {float_text_sql('x')})"
    text = (
        f"concat('{label} Z=', get(t, 0), ' (now=', get(t, 1), '% vs baseline avg=', get(t, 2), "
        "'%±', get(t, 3), ')')"
    )
    return f"case when {metric}_above then get(transform(array({texts}), t -> {text}), 0) end"


def with_smart_alert(df: DataFrame, reason: bool = True) -> DataFrame:
    """Add ``smart_alert`` (CPU or memory above its baseline) and ``smart_reason``.

    The text is only put together for alerts, few of the rows.
    """
    out = df.withColumn("smart_alert", F.expr("cast(cpu_above or mem_above as int)"))
    if not reason:
        return out
    return out.withColumn(
        "smart_reason",
        F.expr(
            f"case when smart_alert = 1 then concat_ws(' | ', {_reason('CPU', 'cpu', CPU)}, "
            f"{_reason('MEM', 'mem', MEM)}) else 'normal' end"
        ),
    )


def with_static_alert(df: DataFrame, cpu: float = STATIC_CPU, mem: float = STATIC_MEM) -> DataFrame:
    """Add ``static_alert``: a reading over a fixed threshold."""
    def over(name: str, limit: float) -> str:
        return f"coalesce({name} > {float(limit)!r}D and not isnan({name}), false)"

    return df.withColumn("static_alert", F.expr(f"cast({over(CPU, cpu)} or {over(MEM, mem)} as int)"))


def smart_alerts(df: DataFrame, reason: bool = True, **baseline) -> DataFrame:
    """Entries -> baseline, z-scores, smart alert; keywords as ``with_baseline``."""
    return with_smart_alert(with_zscores(with_baseline(df, **baseline)), reason)


def detections(df: DataFrame, reason: bool = False, **baseline) -> DataFrame:
    """Smart and static alerts next to the label of every entry."""
    return with_static_alert(
        smart_alerts(df, reason=reason, **{"carry": ["is_anomaly"], **baseline})
    )
