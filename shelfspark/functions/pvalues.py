"""Student-t tail probabilities for test statistics.

Applied only to aggregated rows (one row per column or column pair), never to table rows.

With ``t = sqrt(df) * tan(phi)`` the density of Student's t becomes ``cos(phi) ** (df - 1)`` up to a constant, so the
two-sided tail is a ratio of two integrals of the same function::

    P(|T| > t) = integral from phi to pi/2 / integral from 0 to pi/2

Both are taken by Gauss-Legendre rules over the range where the function has not yet fallen by ``exp(-DROP)``.  No gamma
functions are subtracted, so the result is as good at a df of 1e12 as at 10; nothing is iterated.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

DROP = 45.0
PANELS = 6
NODES, WEIGHTS = np.polynomial.legendre.leggauss(48)


def _panels(start: float, end: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights over [start, end]."""
    edges = np.linspace(start, end, PANELS + 1)
    half = np.diff(edges)[:, None] / 2
    return edges[:-1, None] + half * (1 + NODES), half * WEIGHTS


def _log_tail(t: float, df: float) -> float:
    """log of the integral of cos(x) ** (df - 1) from atan(t / sqrt(df)) to pi/2."""
    power = df - 1
    if t * t <= df:  # near the middle: from phi on, down to DROP
        phi = np.arctan2(t, np.sqrt(df))
        sin2, end = np.sin(phi) ** 2, np.pi / 2
        if power > 0:
            far = sin2 - (1 - sin2) * np.expm1(-2 * DROP / power)
            end = float(np.arcsin(np.sqrt(min(far, 1.0))))
        x, w = _panels(phi, end)
        top = np.log1p(-sin2)
        with np.errstate(divide="ignore"):
            return float(np.log((w * np.exp(power / 2 * (np.log1p(-np.minimum(np.sin(x) ** 2, 1.0)) - top))).sum()) + power / 2 * top)
    reach = np.arctan2(np.sqrt(df), t)  # far out: the same in pi/2 - x, where the function is sin ** (df - 1)
    start = float(np.arcsin(np.sin(reach) * np.exp(-DROP / power))) if power > 0 else 0.0
    x, w = _panels(start, reach)
    top = np.log(np.sin(reach))
    return float(np.log((w * np.exp(power * (np.log(np.sin(x)) - top))).sum()) + power * top)


def t_two_sided_p(t: float | None, df: float | None) -> float | None:
    """P(|T| > |t|) for Student's t with ``df`` (1 or more) degrees of freedom."""
    if t is None or df is None or np.isnan(t) or np.isnan(df) or df < 1:
        return None
    if np.isinf(t):
        return 0.0
    return float(min(1.0, np.exp(_log_tail(abs(t), df) - _log_tail(0.0, df))))


def r_two_sided_p(r: float | None, n: float | None) -> float | None:
    """P-value of a Pearson r on n pairs (t = r·sqrt((n−2)/(1−r²)))."""
    if r is None or n is None or n < 3 or np.isnan(r):
        return None
    if abs(r) >= 1.0:
        return 0.0
    return t_two_sided_p(r * np.sqrt((n - 2) / (1.0 - r * r)), n - 2)


def _each(p, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([p(None if pd.isna(x) else float(x), None if pd.isna(y) else float(y)) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    """Arrow-batched p-values for a column of t statistics (aggregated rows only)."""
    return _each(t_two_sided_p, t, df)


@F.pandas_udf(T.DoubleType())
def r_pvalue_udf(r: pd.Series, n: pd.Series) -> pd.Series:
    return _each(r_two_sided_p, r, n)
