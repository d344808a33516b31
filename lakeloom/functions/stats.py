"""p-values for the few rows a drift test ends with."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _upper_gamma(a: float, x: float) -> float:
    """Regularized upper incomplete gamma function: series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for k in range(1, 500):
            term *= x / (a + k)
            total += term
            if term < total * 1e-15:
                break
        return 1 - total * scale
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for k in range(1, 500):
        an = -k * (k - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


@F.pandas_udf(T.DoubleType())
def chi2_sf(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """P(X > statistic) for a chi-square variable."""
    return pd.Series([_upper_gamma(k / 2, s / 2) for s, k in zip(statistic, df)], dtype=np.float64)


def kolmogorov_sf(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value of a largest distribution distance."""
    lam2 = d * d * (n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(lam2 * k.cast("double") * k.cast("double") * -2.0))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when(lam2 < 0.04, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))
