"""Number helpers that agree with IEEE round-half-even on the stored double."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2**27 + 1


def round_exact(name: str, digits: int, ties: str = "even") -> Column:
    """Round the exact binary value of a column; ties to even or ``"away"`` from zero.

    Spark's ``round`` works on the shortest decimal text, so 2.675 becomes
    2.68; the stored double lies below the tie and has to give 2.67. Only a
    product x * 10**digits that ends in .5 leaves the side open; there the
    part lost in the product is recovered by splitting x into two halves.
    """
    return F.expr(round_exact_sql(name, digits, ties))


def round_exact_sql(x: str, digits: int, ties: str = "even") -> str:
    """SQL text of ``round_exact``; ``x`` is a column name, it occurs many times."""
    scale = f"{10**digits}D"
    a = f"abs({x})"
    p = f"{a} * {scale}"
    t = f"{a} * {_SPLITTER}D"
    hi = f"({t} - ({t} - {a}))"
    lost = f"({hi} * {scale} - {p}) + ({a} - {hi}) * {scale}"
    least = "0D" if ties == "away" else f"case when floor({p}) % 2 = 1 then 0D else 4.9E-324D end"
    tie = f"floor({p}) + case when {lost} >= {least} then 1 else 0 end"
    return (
        f"case when {a} >= 1e14D then {x} when {p} - floor({p}) <> 0.5D then rint({x} * {scale}) / {scale} "
        f"else sign({x}) * ({tie}) / {scale} end"
    )


def float_text_sql(x: str) -> str:
    """Decimal text of a double: all its digits, plainly, from 0.0001 up to 10^16.

    That is where Python prints plain digits, and only such text is a number to the
    line parser. Spark's own text holds the digits; it goes through a decimal, which
    takes 16 digits before the point and 20 after it.
    """
    plain = rf"regexp_replace(cast(cast(cast({x} as string) as decimal(38,20)) as string), r'(\.\d+?)0+$', '$1')"
    return f"case when abs({x}) >= 1e-4D and abs({x}) < 1e16D then {plain} else cast({x} as string) end"


def float_text(name: str) -> Column:
    return F.expr(float_text_sql(name))


def mean_sql(items: str, usual: int) -> str:
    """SQL text: mean of the array ``items`` (no nulls), summed in ``sum_sql`` order."""
    return f"try_divide({sum_sql(items, usual)}, size({items}))"


def deviation_sql(items: str, mean: str, usual: int) -> str:
    """SQL text: population deviation of ``items`` around the column ``mean``."""
    squares = sum_sql(items, usual, "({0} - " + mean + ") * ({0} - " + mean + ")")
    return f"sqrt(try_divide({squares}, size({items})))"


def sum_sql(items: str, usual: int, term: str = "{0}") -> str:
    """SQL text: sum of ``term`` over an array, in the order numpy adds.

    Running-variance formulas leave errors of some 1e-16 that decide readings
    lying exactly on the threshold, so the order of additions is fixed here:
    eight interleaved partial sums, joined in pairs, then the rest one by one.
    Arrays of the ``usual`` length are spelled out, which stays in generated
    code; the shorter ones at the start of a stream go through lambdas.
    """
    if not 1 <= usual <= 128:
        raise ValueError("windows of 1 to 128 readings are supported")

    def joined(parts: list[str]) -> str:
        return "((({0} + {1}) + ({2} + {3})) + (({4} + {5}) + ({6} + {7})))".format(*parts)

    at = [f"({term.format(f'get({items}, {i})')})" for i in range(usual)]
    even = usual // 8 * 8
    if even:
        total = joined(["(" + " + ".join(at[j:even:8]) + ")" for j in range(8)])
        total = " + ".join([total, *at[even:]])
    else:
        total = " + ".join(at)
    body = "(size(t) div 8 * 8)"
    lanes = [
        f"aggregate(filter(t, (x, i) -> i % 8 = {j} and i < {body}), 0D, (a, x) -> a + x)"
        for j in range(8)
    ]
    start = f"case when size(t) < 8 then 0D else {joined(lanes)} end"
    rest = f"aggregate(filter(t, (x, i) -> i >= {body}), {start}, (a, x) -> a + x)"
    terms = f"transform({items}, y -> {term.format('y')})"
    # ``transform`` over a single-item array names the array of terms ``t``.
    short = f"get(transform(array({terms}), t -> {rest}), 0)"
    return f"(case when size({items}) = {usual} then {total} else {short} end)"
