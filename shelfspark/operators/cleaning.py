"""Cleaning and projection operators.

Order of the reference's cleaning stage: fill → flag → clip
(null flags + 0-fill, return flag, percentile clip); the target was computed
before, on unclipped sales.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import config as C
from shelfspark.functions.moments import sample_skew
from shelfspark.operators.common import fixed_round, numeric_columns, one_row_concat, pct, present
from shelfspark.operators.ranks import column_quantiles
from shelfspark.session import cut_lineage


# --- P2 / P3 -----------------------------------------------------------------
def add_missing_flags(df: DataFrame, columns: Sequence[str] = C.MARKDOWN_COLUMNS, prefix: str = "has_") -> DataFrame:
    """``has_<c> = c IS NOT NULL`` (0/1) for each present column."""
    cols = present(df, columns)
    return df.withColumns({f"{prefix}{c}": F.col(c).isNotNull().cast("int") for c in cols})


def fill_constant(df: DataFrame, columns: Sequence[str] = C.MARKDOWN_COLUMNS, value: float = 0.0) -> DataFrame:
    """NULL → constant for the listed columns (after P2)."""
    cols = present(df, columns)
    return df.na.fill(value, subset=cols) if cols else df


def flag_and_fill(df: DataFrame, columns: Sequence[str] = C.MARKDOWN_COLUMNS) -> DataFrame:
    return fill_constant(add_missing_flags(df, columns), columns)


# --- P4 ------------------------------------------------------------------------
def add_sign_flag(df: DataFrame, column: str = "Weekly_Sales", out: str = "is_return") -> DataFrame:
    """``out = column < 0`` as 0/1 (NULL → 0); values are kept."""
    if column not in df.columns:
        return df
    return df.withColumn(out, F.coalesce(F.col(column) < 0, F.lit(False)).cast("int"))


# --- P5 ------------------------------------------------------------------------
def clip_bounds(df: DataFrame, columns: Sequence[str] = C.CLIP_COLUMNS, lower: float = C.CLIP_LOWER, upper: float = C.CLIP_UPPER, method: str = "exact") -> DataFrame:
    """Per-column clip bounds over the non-null values of the whole table: (column, lower, upper).

    All columns in one quantile pass; an all-NULL column yields no row (skipped)."""
    cols = present(df, columns)
    q = column_quantiles(df, cols, [lower, upper], method=method)
    return q.groupBy("column").agg(
        F.max(F.when(F.col("p") == lower, F.col("q"))).alias("lower"),
        F.max(F.when(F.col("p") == upper, F.col("q"))).alias("upper"),
    )


def _bounds_row(bounds: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The (column, lower, upper) table as one row ``_lo_<c>, _hi_<c>`` (≤ 2·#columns cells)."""
    aggs = []
    for c in cols:
        aggs.append(F.max(F.when(F.col("column") == c, F.col("lower"))).alias(f"_lo_{c}"))
        aggs.append(F.max(F.when(F.col("column") == c, F.col("upper"))).alias(f"_hi_{c}"))
    return bounds.agg(*aggs)


def apply_clip(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clip each column to its bounds; NULL stays NULL; a column without bounds is untouched."""
    cols = present(df, columns)
    row = _bounds_row(bounds, cols)
    joined = one_row_concat(df, F.broadcast(row))
    out = []
    for c in df.columns:
        if c in cols:
            lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
            e = F.when(F.col(c).isNull() | lo.isNull(), F.col(c)).when(F.col(c) < lo, lo).when(F.col(c) > hi, hi).otherwise(F.col(c))
            out.append(e.cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def percentile_clip(
    df: DataFrame,
    columns: Sequence[str] = C.CLIP_COLUMNS,
    lower: float = C.CLIP_LOWER,
    upper: float = C.CLIP_UPPER,
    method: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """P5: clip to the [lower, upper] percentiles; returns (clipped, bounds).  The bounds are written, so what reads the clipped
    rows doesn't look for them again."""
    bounds = cut_lineage(clip_bounds(df, columns, lower, upper, method), "clip-bounds")
    return apply_clip(df, bounds, columns), bounds


# --- D15 -----------------------------------------------------------------------
def clip_report(before: DataFrame, after: DataFrame, bounds: DataFrame, columns: Sequence[str] = C.CLIP_COLUMNS) -> DataFrame:
    """Per column: bounds, clipped low/high counts and pct, min/max/std/skew before and after.

    One aggregate over ``before`` (with the bounds row attached) and one over ``after``."""
    cols = present(before, columns)
    row = _bounds_row(bounds, cols)
    b = one_row_concat(before, F.broadcast(row))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [
            F.count_if(F.col(c) < F.col(f"_lo_{c}")).alias(f"{c}__low"),
            F.count_if(F.col(c) > F.col(f"_hi_{c}")).alias(f"{c}__high"),
            F.min(c).alias(f"{c}__min_b"),
            F.max(c).alias(f"{c}__max_b"),
            F.stddev_samp(c).alias(f"{c}__std_b"),
            sample_skew(c).alias(f"{c}__skew_b"),
            F.max(f"_lo_{c}").alias(f"{c}__lo"),
            F.max(f"_hi_{c}").alias(f"{c}__hi"),
        ]
    bagg = b.agg(*aggs)
    aagg = after.agg(
        *[
            x
            for c in cols
            for x in (
                F.min(c).alias(f"{c}__min_a"),
                F.max(c).alias(f"{c}__max_a"),
                F.stddev_samp(c).alias(f"{c}__std_a"),
                sample_skew(c).alias(f"{c}__skew_a"),
            )
        ]
    )
    wide = one_row_concat(bagg, aagg)
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            fixed_round(F.col(f"{c}__lo"), 4).alias("lower_bound"),
            fixed_round(F.col(f"{c}__hi"), 4).alias("upper_bound"),
            F.col(f"{c}__low").alias("clipped_low"),
            F.col(f"{c}__high").alias("clipped_high"),
            (F.col(f"{c}__low") + F.col(f"{c}__high")).alias("total_clipped"),
            pct(F.col(f"{c}__low") + F.col(f"{c}__high"), F.col("_n")).alias("total_clipped_pct"),
            fixed_round(F.col(f"{c}__min_b"), 4).alias("min_before"),
            fixed_round(F.col(f"{c}__max_b"), 4).alias("max_before"),
            fixed_round(F.col(f"{c}__std_b"), 4).alias("std_before"),
            fixed_round(F.col(f"{c}__skew_b"), 4).alias("skew_before"),
            fixed_round(F.col(f"{c}__min_a"), 4).alias("min_after"),
            fixed_round(F.col(f"{c}__max_a"), 4).alias("max_after"),
            fixed_round(F.col(f"{c}__std_a"), 4).alias("std_after"),
            fixed_round(F.col(f"{c}__skew_a"), 4).alias("skew_after"),
            fixed_round(fixed_round(F.col(f"{c}__skew_b"), 4) - fixed_round(F.col(f"{c}__skew_a"), 4), 4).alias("skew_reduction"),
        )
        for c in cols
    ]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*").where(F.col("lower_bound").isNotNull())


# --- cleaning stage --------------------------------------------------------------
def clean(df: DataFrame, method: str = "exact") -> tuple[DataFrame, DataFrame]:
    """The cleaning stage: flags + 0-fill (P2, P3) → return flag (P4) → clip (P5).

    Returns (cleaned, clip bounds)."""
    filled = flag_and_fill(df)
    flagged = add_sign_flag(filled)
    return percentile_clip(flagged, C.CLIP_COLUMNS, C.CLIP_LOWER, C.CLIP_UPPER, method)


# --- P6 / P7 / P8 --------------------------------------------------------------
def bool_to_int(df: DataFrame, columns: Sequence[str] = ("IsHoliday",)) -> DataFrame:
    """P6."""
    cols = present(df, columns)
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def drop_encoded_categoricals(df: DataFrame, categoricals: Sequence[str] = ("Type",), encoded_suffix: str = "Encoded") -> DataFrame:
    """Drop a categorical column once its ordinal version exists."""
    drop = [c for c in categoricals if c in df.columns and f"{c}{encoded_suffix}" in df.columns]
    return df.drop(*drop)


def drop_leakage(df: DataFrame, columns: Sequence[str] = C.LEAKAGE_COLUMNS) -> DataFrame:
    """Drop leakage columns and every remaining string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    drop = sorted(set(present(df, columns)) | set(strings))
    return df.drop(*drop)


# --- P10 / P11 -------------------------------------------------------------------
def dashboard_predicate(
    date_range: tuple[dt.date | str, dt.date | str] | None = None,
    types: Sequence[str] = (),
    stores: Sequence[int] = (),
    holiday: str = "all",
) -> Column:
    """P10: inclusive date range, Type IN, Store IN (empty = all), holiday tri-state
    (``all`` / ``holiday`` / ``non_holiday``).  Plain comparisons, so the predicate
    reaches the Parquet scan as pushed filters."""
    cond = F.lit(True)
    if date_range is not None:
        lo, hi = date_range
        cond = cond & (F.col("Date") >= F.lit(lo).cast("date")) & (F.col("Date") <= F.lit(hi).cast("date"))
    if types:
        cond = cond & F.col("Type").isin(list(types))
    if stores:
        cond = cond & F.col("Store").isin(list(stores))
    if holiday == "holiday":
        cond = cond & F.col("IsHoliday").cast("boolean")
    elif holiday == "non_holiday":
        cond = cond & ~F.col("IsHoliday").cast("boolean")
    return cond


def filter_rows(df: DataFrame, **kwargs) -> DataFrame:
    return df.where(dashboard_predicate(**kwargs))


def filter_share(df: DataFrame, predicate: Column) -> DataFrame:
    """Kept rows, total rows, kept pct — one aggregate."""
    return df.agg(F.count_if(predicate).alias("kept"), F.count(F.lit(1)).alias("total")).select(
        "kept", "total", pct(F.col("kept"), F.col("total"), 1).alias("pct")
    )


# --- P12 / P13 / P14 -------------------------------------------------------------
def select_features(df: DataFrame, features: Sequence[str] = C.SELECTED_FEATURES, target: str = C.TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """The selected feature columns plus target (and e.g. the holiday flag)."""
    missing = [c for c in [*features, target] if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*features, target, *[c for c in extra if c not in features and c != target])


def numeric_column_names(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema type (booleans are not numeric)."""
    return numeric_columns(df, exclude)


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with no NULL in ``columns``."""
    return df.na.drop(how="any", subset=list(present(df, columns)))
