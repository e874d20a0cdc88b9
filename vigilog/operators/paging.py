"""Pages, feeds, samples and top-k reports."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.operators.labels import hit_tag, label_filter
from vigilog.operators.quantiles import value_at_rank
from vigilog.storage import materialize, scratch

# Up to here a top-k with offset is cheaper than looking the start row up.
SHALLOW_ROWS = 100_000
# Up to here a page is a top-k, which ends in one task that reads so many rows of every partition.
WIDE_ROWS = 10_000


def page_of_records(
    df: DataFrame, page: int = 1, per_page: int = 50, which: str = "all",
    order_col: str | list[str] = "line_no", shallow_rows: int = SHALLOW_ROWS, wide_rows: int = WIDE_ROWS,
) -> DataFrame:
    """Page ``page`` (from 1) of the entries in file order.

    ``order_col`` is a column or several, such as file and line number. Ties are ordered
    by a hash of the whole row, so that every row is on exactly one page. A deep page
    first finds the order values of its first row by counting, then reads only rows from
    there on; it does not sort the rows before it. A page of more than ``wide_rows`` rows
    looks up both its ends and is a filter between them, ordered by ranges in many tasks.
    All ways give the same rows.
    """
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")
    columns = [order_col] if isinstance(order_col, str) else list(order_col)
    rows = label_filter(df, which)
    skip = (page - 1) * per_page
    if per_page > wide_rows:
        return _between_ranks(rows, columns, skip, skip + per_page)
    if skip > shallow_rows:
        found = _from_rank(rows, columns, skip, shallow_rows)
        if found is None:
            return rows.limit(0)
        rows, skip = rows.where(found[0]), found[1]
    return rows.orderBy(*columns, F.xxhash64(*df.columns)).offset(skip).limit(per_page)


def _from_rank(rows: DataFrame, columns: list[str], rank: int, enough: int) -> tuple[Column, int] | None:
    """A filter that keeps the row of 0-based ``rank`` and all after it, and how many kept rows come before it.

    Where more than ``enough`` rows tie in a column before the wanted one, the next column decides.
    """
    name, x = columns[0], F.col(columns[0])
    found = _value_at(rows, name, rank)
    if found is None:
        return None
    value, below = found
    if value is None:
        here = x.isNull()
        after = here | x.isNotNull()
    else:
        here, after = x == F.lit(value), x >= F.lit(value)
    if rank - below > enough and len(columns) > 1:
        inner = _from_rank(rows.where(here), columns[1:], rank - below, enough)
        beyond = x.isNotNull() if value is None else x > F.lit(value)
        return (here & inner[0]) | beyond, inner[1]
    return after, rank - below


def _is_whole(rows: DataFrame, name: str) -> bool:
    return dict(rows.select(name).dtypes)[name] in ("tinyint", "smallint", "int", "bigint")


def _value_at(rows: DataFrame, name: str, rank: int) -> tuple[object, int] | None:
    """The value at a 0-based rank of a column, nulls first, and how many rows lie below it; None beyond the end."""
    x = F.col(name)
    nulls = rows.where(x.isNull()).count()
    if rank < nulls:
        return None, 0
    if _is_whole(rows, name):
        value = value_at_rank(rows, name, rank - nulls)
        below = rows.where(x < value).count() if value is not None else 0
    else:
        value, below = _value_by_ranges(rows, name, rank - nulls)
    return None if value is None else (value, nulls + below)


def _between_ranks(rows: DataFrame, columns: list[str], start: int, end: int) -> DataFrame:
    """The rows of 0-based ranks ``start`` to ``end`` - 1 in the order of a page, in as many tasks as they ask for.

    Rows that tie in the whole order at an end are copies, but for equal hashes; only these are numbered,
    to leave the right number of them out.
    """
    tie, at = _unused("_tie", rows), _unused("_at", rows)
    keys, keyed = [*columns, tie], rows.withColumn(tie, F.xxhash64(*rows.columns))
    with scratch(rows.sparkSession):
        first, last = _place(keyed, keys, start) if start else ([], 0), _place(keyed, keys, end)
    if first is None:
        return rows.limit(0)
    low, skipped = first
    high, taken = last or ([], 0)
    if low and low == high:
        kept = _slice(keyed.where(_equals(keys, low)), at, skipped, taken)
    else:
        kept = keyed
        if low:
            kept = kept.where(_follows(keys, low, ties=not skipped))
        if high:
            kept = kept.where(~_follows(keys, high, ties=True))
        if skipped:
            kept = kept.unionByName(_slice(keyed.where(_equals(keys, low)), at, skipped, None))
        if taken:
            kept = kept.unionByName(_slice(keyed.where(_equals(keys, high)), at, 0, taken))
    # Copies differ in the last column, so that many of one row are no single range.
    return kept.orderBy(*keys, F.monotonically_increasing_id()).select(*rows.columns)


def _unused(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _place(rows: DataFrame, columns: list[str], rank: int) -> tuple[list, int] | None:
    """The order values of the row at a 0-based rank, and how many rows with the same values come before it; None beyond the end.

    A first column of whole numbers is settled by counting; the other columns go by ranges, and only those of
    the rows that tie in the first.
    """
    settled = []
    if len(columns) > 1 and _is_whole(rows, columns[0]):
        found = _value_at(rows, columns[0], rank)
        if found is None:
            return None
        settled, rank = [found[0]], rank - found[1]
        rows, columns = rows.where(_equals(columns, settled)), columns[1:]
    value, below = _value_by_ranges(rows.select(F.struct(*columns).alias("v")), "v", rank)
    return None if value is None else ([*settled, *value], rank - below)


def _equals(columns: list[str], values: list) -> Column:
    """Rows with these values in the first columns; null equals null."""
    same = F.lit(True)
    for c, v in zip(columns, values):
        same = same & (F.col(c).isNull() if v is None else F.coalesce(F.col(c) == F.lit(v), F.lit(False)))
    return same


def _follows(columns: list[str], values: list, ties: bool) -> Column:
    """Rows after these values, or with them too (``ties``), in the order of the columns, nulls first; never null."""
    after = F.lit(ties)
    for c, v in reversed(list(zip(columns, values))):
        beyond = F.col(c).isNotNull() if v is None else F.coalesce(F.col(c) > F.lit(v), F.lit(False))
        after = beyond | (_equals([c], [v]) & after)
    return after


def _slice(tied: DataFrame, at: str, start: int, end: int | None) -> DataFrame:
    """Rows ``start`` to ``end`` - 1 of some in the order they lie in, counted and not gathered."""
    stored = materialize(tied.withColumn(at, F.monotonically_increasing_id()), "ties")
    kept = stored.where(F.col(at) >= value_at_rank(stored, at, start))
    if end is not None:
        kept = kept.where(F.col(at) < value_at_rank(stored, at, end))
    return kept.drop(at)


def _value_by_ranges(rows: DataFrame, name: str, rank: int) -> tuple[object, int]:
    """The value at a 0-based rank of a column of any order, nulls left out, and how many rows lie below it.

    Values are counted and dealt to ranges in their order; a count of each range tells which one holds
    the rank, and only that range is ordered.
    """
    counted = rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "ranges")
    below = 0
    for part, n in ranged.groupBy("part").agg(F.sum("n")).orderBy("part").collect():
        if rank < below + n:
            upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
            found = ranged.where(F.col("part") == part).withColumn("upto", upto).where(F.col("upto") > rank - below).orderBy("v").first()
            return found["v"], below + found["upto"] - found["n"]
        below += n
    return None, 0


def page_after(df: DataFrame, last: int, per_page: int = 50, order_col: str = "line_no") -> DataFrame:
    """The next rows after order value ``last``, which must be unique; the filter reaches the scan."""
    return df.where(F.col(order_col) > last).orderBy(order_col).limit(per_page)


def page_counts(df: DataFrame, per_page: int = 50, which: str = "all") -> DataFrame:
    """Matching rows and number of pages, at least one."""
    if per_page < 1:
        raise ValueError("per_page starts at 1")
    return (
        label_filter(df, which)
        .agg(F.count(F.lit(1)).alias("total"))
        .withColumn("pages", F.greatest(F.lit(1), F.ceil(F.col("total") / per_page)).cast("bigint"))
    )


def first_alerts(detected: DataFrame, n: int = 5, order_col: str = "line_no") -> DataFrame:
    """The first ``n`` smart alerts in file order, tagged TP or FP."""
    return (
        detected.where(F.col("smart_alert") == 1)
        .withColumn("tag", hit_tag(F.col("is_anomaly")))
        .orderBy(order_col)
        .limit(n)
    )


def newest(df: DataFrame, n: int = 100, order_col: str = "line_no") -> DataFrame:
    """The feed: last ``n`` entries, newest first."""
    return df.orderBy(F.desc(order_col)).limit(n)


def last_per_stream(df: DataFrame, stream_key: str, n: int = 60, order_col: str = "line_no") -> DataFrame:
    """The last ``n`` readings of every stream.

    Each task keeps ``n`` rows per stream before the shuffle, so a large stream
    sends no more than that.
    """
    recent = Window.partitionBy(stream_key).orderBy(F.desc(order_col))
    return df.withColumn("_n", F.row_number().over(recent)).where(F.col("_n") <= n).drop("_n")


def first_record(df: DataFrame, order_col: str = "line_no") -> DataFrame:
    """The first entry by file order."""
    return df.agg(F.min_by(F.struct(*df.columns), F.col(order_col)).alias("r")).where(
        F.col("r").isNotNull()
    ).select("r.*")


def top_process(snapshots: DataFrame, by: list[str]) -> DataFrame:
    """Process with the highest CPU per group; null counts as 0, ties to the lowest pid, then the first name."""
    load = F.coalesce(F.col("cpu_percent"), F.lit(0.0))
    best = snapshots.groupBy(*by).agg(
        F.min_by(F.struct("pid", "name", "cpu_percent"), F.struct(-load, "pid", "name")).alias("p")
    )
    text = F.concat(
        F.lit("pid="), F.col("p.pid").cast("string"), F.lit(" name="), F.col("p.name"),
        F.lit(" cpu="), F.coalesce(F.col("p.cpu_percent").cast("string"), F.lit("None")), F.lit("%"),
    )
    return best.select(
        *by, F.col("p.pid").alias("pid"), F.col("p.name").alias("name"),
        F.col("p.cpu_percent").alias("cpu_percent"),
        F.coalesce(text, F.lit("unavailable")).alias("top_proc"),
    )
