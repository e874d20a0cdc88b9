"""Keep costly columns from being computed again inside later filters."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns passed through a one-row ``inline``.

    A filter on a computed column is pushed below its projection with the whole
    expression copied in, and through several projections it multiplies. It is
    not pushed below a generator, so the columns are computed once.
    """
    record = ", ".join(f"'{c}', `{c}`" for c in names)
    rest = [F.col(c) for c in df.columns if c not in names]
    return df.select(*rest, F.expr(f"inline(array(named_struct({record})))"))
