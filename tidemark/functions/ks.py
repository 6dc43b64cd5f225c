"""Exact p-value of the two-sample Kolmogorov-Smirnov test."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Ship this module's functions with the tasks, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def share_at_least(statistic: float, m: int, n: int) -> float:
    """P(D >= statistic) for samples of m and n rows from one continuous distribution.

    Merging the samples is a random walk from (0, 0) to (m, n). The probability
    of having stayed inside the band |i/m - j/n| < statistic is carried along
    the diagonals i + j = s; inside the band it is a weighted mean of the two
    places the walk can come from.
    """
    reach = round(statistic * m * n)
    if reach <= 0:
        return 1.0
    inside = np.zeros(m + 2)
    inside[1] = 1.0
    first = 0
    for s in range(1, m + n + 1):
        low = max(0, s - n, (s * m - reach) // (m + n) + 1)
        high = min(m, s, -((-s * m - reach) // (m + n)) - 1)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        # Entry i is stored at i + 1, so that i - 1 always exists.
        step = (inside[low : high + 1] * i + inside[low + 1 : high + 2] * (s - i)) / s
        inside[first + 1 : low + 1] = 0.0
        inside[low + 1 : high + 2] = step
        first = low
    return float(min(1.0, max(0.0, 1.0 - inside[m + 1])))


@F.pandas_udf(T.DoubleType())
def exact_ks_pvalue(statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    """One value per drift-table row, whatever the sample sizes; the cost grows with their product."""
    fits = statistic.notna() & (n_ref > 0) & (n_cur > 0)
    return pd.Series([
        share_at_least(d, int(m), int(n)) if ok else None for ok, d, m, n in zip(fits, statistic, n_ref, n_cur)
    ], dtype="float64")
