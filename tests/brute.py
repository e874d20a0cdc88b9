"""Plain-Python restatements of the semantics, for small fixtures."""

import math

import numpy as np


def rolling(values, window=20):
    """history, mean, std, z and above for each reading of one stream."""
    out = []
    for i, v in enumerate(values):
        past = np.array(values[max(0, i - window):i], float)
        if len(past) < 5:
            out.append((len(past), v, 0.0, 0.0, False))
            continue
        mean, std = past.mean(), past.std()
        if std < 1e-6:
            out.append((len(past), mean, std, 0.0, False))
            continue
        z = (v - mean) / std
        out.append((len(past), mean, std, z, bool(z > 2.0)))
    return out


def same(a, b, tol=1e-9):
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
