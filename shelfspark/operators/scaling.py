"""Train-fitted scaling and feature metadata.

A fitted scaler is a small parameter table (column, center, scale) — one row
per column — computed on the training rows only and applied to any frame
with a broadcast one-row join, so train and test use identical parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import config as C
from shelfspark.operators.common import NUMERIC_TYPES, one_row_concat
from shelfspark.operators.ranks import quantiles_wide, unpivot_numeric


def scale_columns(df: DataFrame, no_scale: Sequence[str] = C.NO_SCALE_COLUMNS) -> list[str]:
    """numeric columns minus the no-scale list (ids, flags, ordinals, target)."""
    skip = set(no_scale)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def fit_robust(train: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    """center = median, scale = IQR (q75 − q25; 0 → 1) per column, exact linear quantiles."""
    q = quantiles_wide(train, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, method=method)
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", F.col("median").alias("center"), F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale"))


def fit_standard(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """center = mean, scale = population std (0 → 1)."""
    long = unpivot_numeric(train, columns)
    agg = long.groupBy("column").agg(F.avg("value").alias("center"), F.stddev_pop("value").alias("scale"))
    return agg.select("column", "center", F.when((F.col("scale") == 0) | F.col("scale").isNull(), F.lit(1.0)).otherwise(F.col("scale")).alias("scale"))


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Apply a fitted (column, center, scale) table: (x − center) / scale."""
    cols = [c for c in columns if c in df.columns]
    row = params.agg(
        *[x for c in cols for x in (
            F.max(F.when(F.col("column") == c, F.col("center"))).alias(f"_c_{c}"),
            F.max(F.when(F.col("column") == c, F.col("scale"))).alias(f"_s_{c}"),
        )]
    )
    j = one_row_concat(df, F.broadcast(row))
    return j.select(
        *[((F.col(c) - F.col(f"_c_{c}")) / F.col(f"_s_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def post_scale_checks(df: DataFrame, name: str) -> DataFrame:
    """Q28: NULL cells and infinite numeric cells of a scaled frame."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    infs = sum((F.count_if(F.abs(F.col(c)) == float("inf")) for c in nums), F.lit(0))
    return df.agg(nulls.alias("null_cells"), infs.alias("inf_cells")).select(F.lit(name).alias("frame"), "null_cells", "inf_cells")


def feature_metadata(train: DataFrame, scaled: Sequence[str], target: str = C.TARGET) -> DataFrame:
    """per feature: type, binary vs continuous (values ⊆ {0, 1}), scaled flag."""
    feats = [c for c in train.columns if c != target]
    nums = [c for c in feats if isinstance(train.schema[c].dataType, NUMERIC_TYPES)]
    w = train.agg(*[F.coalesce(F.bool_and(F.col(c).isNotNull() & F.col(c).isin(0, 1)), F.lit(True)).alias(c) for c in nums]) if nums else None
    binary = w.first().asDict() if w is not None else {}
    rows = [
        (c, train.schema[c].dataType.simpleString(), "binary" if binary.get(c) else ("continuous" if c in nums else "other"), c in set(scaled))
        for c in feats
    ]
    return train.sparkSession.createDataFrame(rows, "feature string, type string, kind string, scaled boolean")
