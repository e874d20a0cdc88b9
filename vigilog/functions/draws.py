"""Repeatable random draws: a hash of the row's key, not of its position."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(keys: list[Column], seed: int) -> Column:
    """A number in [0, 1) fixed by the key values and the seed.

    Unlike ``rand`` it does not change with the partitioning or on a retry.
    """
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 11) / F.lit(float(1 << 53))
