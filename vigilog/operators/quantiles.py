"""Exact order statistics without sorting the table or gathering it anywhere.

Each round counts the rows in at most ``BUCKETS`` slices of the value range that still
holds the wanted rank, and continues inside one slice. A round is one scan with partial
aggregation; three rounds cover 10^10 distinct values.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _slot(x: Column, lo, hi) -> Column:
    """The slice of a value in [lo, hi]; never falls as the value rises, and lo and hi differ in it.

    A range of both signs is first split by sign, with infinities apart; one of very
    different sizes is sliced by logarithm, any other evenly. So the range shrinks by a
    large factor however the values are spread, and no difference overflows.
    """
    if isinstance(lo, float) and (math.isinf(lo) or math.isinf(hi) or lo <= 0 <= hi):
        infinite = F.abs(x) == float("inf")
        return F.signum(x) * F.when(infinite, 2).otherwise(1)
    if isinstance(lo, float) and max(abs(lo), abs(hi)) / BUCKETS > min(abs(lo), abs(hi)):
        # Both ends have one sign here.
        low, high = math.log(abs(lo)), math.log(abs(hi))
        share = (F.ln(F.abs(x)) - F.lit(low)) / F.lit(high - low)
    else:
        share = (x - F.lit(lo)).cast("double") / F.lit(float(hi - lo))
    return F.greatest(F.lit(0), F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)))


def _narrow(df: DataFrame, column: str, lo, hi) -> list:
    """Per-slice (count, min, max) of the values in [lo, hi]; at most BUCKETS rows."""
    x = F.col(column)
    return (
        df.where(x.between(lo, hi))
        .groupBy(_slot(x, lo, hi).alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        .orderBy("lo")
        .collect()
    )


def _search(df: DataFrame, column: str, rank: int, lo, hi, below: int):
    """Values at ``rank`` and ``rank + 1``, 0-based, given the range around them."""
    while lo < hi:
        slots = _narrow(df, column, lo, hi)
        for i, s in enumerate(slots):
            if rank < below + s.n:
                break
            below += s.n
        if rank == below + s.n - 1:
            # Last of its slice: the next value opens the following slice.
            return s.hi, slots[i + 1].lo if i + 1 < len(slots) else None
        if (s.lo, s.hi) == (lo, hi):
            raise RuntimeError(f"no slice between {lo} and {hi} separates the values of {column}")
        lo, hi = s.lo, s.hi
    return lo, lo


def _numbers(df: DataFrame, column: str) -> DataFrame:
    """Without nulls and NaN, which have no rank."""
    x = F.col(column)
    kind = dict(df.select(column).dtypes)[column]
    return df.where(x.isNotNull() & ~F.isnan(x)) if kind in ("double", "float") else df.where(x.isNotNull())


def _ends(df: DataFrame, column: str):
    x = F.col(column)
    return df.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()


def value_at_rank(df: DataFrame, column: str, rank: int):
    """The value at 0-based ``rank`` in ascending order, or None beyond the end.

    Nulls and NaN have no rank; infinities do.
    """
    df = _numbers(df, column)
    ends = _ends(df, column)
    if rank < 0 or rank >= ends.n:
        return None
    return _search(df, column, rank, ends.lo, ends.hi, 0)[0]


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    """Linearly interpolated quantile of a numeric column, nulls and NaN left out.

    Between a finite value and an infinite one it is the infinite one. ``df`` is scanned
    several times: pass a stored table.
    """
    df = _numbers(df, column)
    ends = _ends(df, column)
    if not ends.n:
        return None
    rank, part = place_of(ends.n, p)
    return interpolated(*_search(df, column, rank, ends.lo, ends.hi, 0), part)


def place_of(n: int, p: float) -> tuple[int, float]:
    """The 0-based rank at or below the ``p`` quantile of ``n`` values, and the part of the step to the next."""
    place = (n - 1) * p
    return math.floor(place), place - math.floor(place)


def interpolated(a, b, part: float) -> float:
    if part == 0 or a == b or b is None:
        return float(a)
    if math.isinf(a) or math.isinf(b):
        return float(a + b)
    step = b - a
    if math.isinf(step):
        return float(a * (1 - part) + b * part)
    return float(a + step * part if part < 0.5 else b - step * (1 - part))
