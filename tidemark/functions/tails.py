"""Tail probabilities, which Spark SQL lacks. Applied to result rows only.

The functions are self-contained, so workers can run them without this package.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Probability that a standard normal is at least ``|z|`` away from 0."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)), na_action="ignore")


@F.pandas_udf(T.DoubleType())
def chi_square_tail(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution with whole degrees of freedom."""

    def tail(x: float, k: int) -> float | None:
        if x is None or math.isnan(x) or k < 1:
            return None
        half, odd = x / 2, k % 2 / 2
        if half <= 0:
            return 1.0
        # the terms half^m * exp(-half) / gamma(m + 1), in logarithms so that none overflows
        powers = (j + odd for j in range(int(k) // 2))
        terms = (math.exp(m * math.log(half) - half - math.lgamma(m + 1)) for m in powers)
        return min(1.0, math.fsum(terms) + (math.erfc(math.sqrt(half)) if odd else 0.0))

    return pd.Series([tail(x, k) for x, k in zip(stat, dof)], dtype="float64")
