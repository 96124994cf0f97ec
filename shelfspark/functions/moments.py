"""Moment statistics as aggregate expressions.

Spark's ``skewness``/``kurtosis`` are population values g1, g2 (mergeable
central-moment aggregates).  The reference reports pandas' bias-corrected
sample values:

    G1 = g1 · sqrt(n(n−1)) / (n−2)                       (n ≥ 3)
    G2 = (n−1) / ((n−2)(n−3)) · ((n+1)·g2 + 6)           (n ≥ 4)

A zero-variance column gives 0 (pandas), not NULL/NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sample_skew(col: str | Column) -> Column:
    """Bias-corrected skewness aggregate (pandas ``Series.skew``)."""
    c = _c(col)
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.var_pop(c) == 0, F.lit(0.0))
        .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))
    )


def sample_excess_kurtosis(col: str | Column) -> Column:
    """Bias-corrected excess kurtosis aggregate (pandas ``Series.kurt``)."""
    c = _c(col)
    n = F.count(c).cast("double")
    g2 = F.kurtosis(c)
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(F.var_pop(c) == 0, F.lit(0.0))
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def shape_label(skew: str | Column) -> Column:
    """D3: >2 heavily right, >1 right, <−1 left, else approximately symmetric."""
    s = _c(skew)
    return (
        F.when(s > 2, "heavily_right_skewed")
        .when(s > 1, "right_skewed")
        .when(s < -1, "left_skewed")
        .otherwise("approximately_symmetric")
    )


def sql_sample_skew(col: str) -> str:
    """The same statistic for the DuckDB oracle (DuckDB's ``skewness`` is already corrected)."""
    return f"CASE WHEN count({col}) < 3 THEN NULL WHEN var_pop({col}) = 0 THEN 0 ELSE skewness({col}) END"


def sql_sample_kurtosis(col: str) -> str:
    return f"CASE WHEN count({col}) < 4 THEN NULL WHEN var_pop({col}) = 0 THEN 0 ELSE kurtosis({col}) END"
