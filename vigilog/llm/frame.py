"""Helpers shared by the operators: clashing names, distributed positions, row keys."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def pack(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that an operator's own names cannot clash."""
    return F.struct(*[col(c) for c in df.columns]).alias("_row")


def unpack(df: DataFrame, names: list[str], results: dict[str, Column]) -> DataFrame:
    """The packed columns and then the results; a result replaces an input column of its name."""
    taken = {r.lower() for r in results}
    kept = [F.col("_row").getField(c).alias(c) for c in names if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def flat(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by number, so that those not asked for later are never read back."""
    return [col(c).alias(f"_c{i}") for i, c in enumerate(df.columns)]


def unflat(df: DataFrame, names: list[str], results: dict[str, Column]) -> DataFrame:
    """As ``unpack``, for columns by number."""
    taken = {r.lower() for r in results}
    kept = [F.col(f"_c{i}").alias(c) for i, c in enumerate(names) if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long rows: a Python worker gets at most ``rows`` of them at a time.

    A session setting, since Spark has no other place for it; a smaller one is left as it is.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def salts(rows: int, least: int = 16, rows_per_salt: int = 1 << 22) -> int:
    """Number of parts in which hot groups of a table of ``rows`` rows are split."""
    return least + rows // rows_per_salt


def with_positions(
    df: DataFrame, keys: list[str], cell: str, order: list[Column],
    sums: dict[str, Column] | None = None, firsts: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds ``_index`` (from 0 within ``keys``) and, for each sum, what stands before the row.

    Rows are ordered by ``cell`` and then ``order``. Only a cell's rows meet in one
    task: cells are counted first, and one row for each cell carries the offsets.
    ``firsts`` adds a value of the first row of each key. Keys and cells must not be null.
    """
    sums, firsts = sums or {}, firsts or {}
    cells = df.groupBy(*keys, cell).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.min_by(F.struct(c.alias("v")), F.struct(*order)).alias(f"_first_{n}") for n, c in firsts.items()],
    )
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(c, F.lit(0))
    cells = cells.select(
        *keys, cell, zero(F.sum("_n").over(before)).alias("_rows_before"),
        *[zero(F.sum(f"_sum_{n}").over(before)).alias(f"_before_{n}") for n in sums],
        *[F.first(f"_first_{n}").over(upto).getField("v").alias(n) for n in firsts],
    )
    inside = Window.partitionBy(*keys, cell).orderBy(*order)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(cells, [*keys, cell])
    return joined.select(
        *[c for c in joined.columns if not c.startswith("_before_") and c != "_rows_before"],
        (F.col("_rows_before") + F.row_number().over(inside) - 1).alias("_index"),
        *[(F.col(f"_before_{n}") + zero(F.sum(c).over(ahead))).alias(n) for n, c in sums.items()],
    )
