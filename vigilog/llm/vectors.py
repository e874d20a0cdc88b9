"""Vectors as rows of numpy matrices, shared by the vector operators."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import col


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty and without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def doubles(df: DataFrame, vector: str) -> Column:
    return col(vector).cast("array<double>")


def packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, "<f8").tobytes()


def matrix(blobs: pd.Series) -> np.ndarray:
    """Rows of equal length from their bytes."""
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)
