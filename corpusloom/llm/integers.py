"""Vectors as exact whole numbers."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LONG = (-(2**63), 2**63 - 1)
_EXACT = 2.0**53


def usable(vector: Column) -> Column:
    """True for vectors with at least one entry, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def floored(left: pd.Series, right: pd.Series, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of both sides: doubles if they hold every inner product exactly, else Python integers."""
    a, b = (np.stack(x.to_numpy()).astype(np.float64) for x in (left, right))
    largest = max(float(np.abs(a).max()), float(np.abs(b).max()))
    if float(np.abs(a).max()) * float(np.abs(b).max()) < _EXACT / (a.shape[1] * (scale + 1) ** 2) and largest < _EXACT / (scale + 1):
        wide = a.shape[1] * (scale * float(np.abs(a).max()) + 1) * (scale * float(np.abs(b).max()) + 1)
        if wide < _EXACT:
            return np.floor(scale * a), np.floor(scale * b)
    whole = np.frompyfunc(lambda x: math.floor(scale * Fraction(x)), 1, 1)
    return whole(a), whole(b)


def as_long(score) -> int:
    """A whole number held at the ends of a long."""
    return min(max(int(score), LONG[0]), LONG[1])
