"""Feature engineering (F1–F20, W2, A20/J8, P9) and the EDA helper columns.

Each group is one ``withColumns`` projection of built-in expressions; only
the store/department group needs data-dependent values (distinct counts per
key, size quartile edges), which are small per-key / one-row tables joined
back with a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.functions import calendar as cal
from shelfspark.functions import exprs as X
from shelfspark.operators.common import NUMERIC_TYPES, one_row_concat
from shelfspark.operators.ranks import group_quantiles
from shelfspark.session import cut_lineage


def add_temporal(df: DataFrame, date: str = "Date") -> DataFrame:
    """Group 1 (12 columns): Year … YearProgress."""
    return df.withColumns(cal.temporal_columns(date))


def add_holiday(df: DataFrame, windows=C.HOLIDAY_WINDOWS) -> DataFrame:
    """Group 2 (6 columns): HolidayType, pre/post flags, proximity, peak, back-to-school."""
    return df.withColumns(cal.holiday_columns("Week", "Month", windows))


def add_promotion(df: DataFrame) -> DataFrame:
    """Group 3 (5 columns): markdown totals, counts, average, max, any-flag."""
    return df.withColumns(X.markdown_columns())


def quartile_edges(df: DataFrame, column: str = "Size", method: str = "exact") -> DataFrame:
    """One row of edges q0..q4 (linear quantiles over rows, as ``pd.qcut``)."""
    q = group_quantiles(df, column, [0.0, 0.25, 0.5, 0.75, 1.0], method=method)
    return q.agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(f"_q{i}") for i, p in enumerate([0.0, 0.25, 0.5, 0.75, 1.0])])


def add_quartile(df: DataFrame, column: str = "Size", out: str = "SizeQuartile", method: str = "exact") -> DataFrame:
    """Quartile label 1..4 with right-closed bins, lowest edge included.

    Not ``ntile`` (which splits ties); equal edges raise like ``pd.qcut``."""
    edges = cut_lineage(quartile_edges(df, column, method), "quartile-edges").groupBy().agg(*[F.max(f"_q{i}").alias(f"_q{i}") for i in range(5)])
    joined = one_row_concat(df, F.broadcast(edges))
    x = F.col(column)
    unique = (F.col("_q0") < F.col("_q1")) & (F.col("_q1") < F.col("_q2")) & (F.col("_q2") < F.col("_q3")) & (F.col("_q3") < F.col("_q4"))
    label = F.when(x <= F.col("_q1"), 1).when(x <= F.col("_q2"), 2).when(x <= F.col("_q3"), 3).when(x.isNotNull(), 4)
    guarded = F.when(unique, label).otherwise(F.raise_error(F.lit(f"quartile edges of {column} are not unique")).cast("int"))
    return joined.withColumn(out, guarded).drop("_q0", "_q1", "_q2", "_q3", "_q4")


def add_store_dept(df: DataFrame, method: str = "exact") -> DataFrame:
    """Group 4 (5 columns): TypeEncoded, SizePerType, StoreDeptCount, DeptFrequency, SizeQuartile.

    The two distinct-count tables (A20) have one row per store / department; they are counted on the distinct pairs,
    written, and joined back (J8): the planner sees their bytes and doesn't shuffle the rows for a small one."""
    out = df.withColumn("TypeEncoded", X.type_code("Type"))
    out = out.withColumn("SizePerType", F.col("Size") / (F.col("TypeEncoded") + 1))
    pairs = cut_lineage(df.select("Store", "Dept").distinct(), "store-depts")
    per_store = cut_lineage(pairs.where(F.col("Store").isNotNull()).groupBy("Store").agg(F.count("Dept").alias("StoreDeptCount")), "store-dept-counts")
    per_dept = cut_lineage(pairs.where(F.col("Dept").isNotNull()).groupBy("Dept").agg(F.count("Store").alias("DeptFrequency")), "dept-store-counts")
    out = out.join(per_store, "Store", "left").join(per_dept, "Dept", "left")
    out = add_quartile(out, "Size", "SizeQuartile", method)
    return out.select(*df.columns, "TypeEncoded", "SizePerType", "StoreDeptCount", "DeptFrequency", "SizeQuartile")


def add_economic(df: DataFrame) -> DataFrame:
    """Group 5 (1 column): ConsumerConfRatio (the min-max columns are temporary in the reference)."""
    return df.withColumn("ConsumerConfRatio", X.consumer_confidence_ratio())


def min_max_normalise(df: DataFrame, columns: Sequence[str] = C.SERIES_COLUMNS, suffix: str = "_norm") -> DataFrame:
    """F16: ``(x − min)/(max − min)`` per column from one min/max aggregate; range 0 → 0.0."""
    cols = [c for c in columns if c in df.columns]
    mm = df.agg(*[x for c in cols for x in (F.min(c).alias(f"_mn_{c}"), F.max(c).alias(f"_mx_{c}"))])
    joined = one_row_concat(df, F.broadcast(mm))
    new = {}
    for c in cols:
        rng = F.col(f"_mx_{c}") - F.col(f"_mn_{c}")
        new[f"{c}{suffix}"] = F.when(rng > 0, (F.col(c) - F.col(f"_mn_{c}")) / rng).otherwise(F.lit(0.0))
    return joined.withColumns(new).select(*df.columns, *new.keys())


def add_interactions(df: DataFrame) -> DataFrame:
    """Group 7 (5 columns)."""
    return df.withColumns(X.interaction_columns())


def add_cyclical(df: DataFrame) -> DataFrame:
    """Group 8 (4 columns)."""
    return df.withColumns(X.cyclical_columns())


#: Rows among which a column is first looked at for two different values.
WITNESS_ROWS = 1_000


def zero_variance_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns whose sample std is exactly 0, that is two or more non-nulls and all of them equal (one aggregate
    of minima, maxima and counts; a column with fewer non-nulls has no std and is kept, like pandas' NaN).

    Two different values anywhere prove that a column is not constant, so those that differ within the first rows are settled
    there; only the others are looked at over the whole table."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)]
    if cols:
        row = df.select(*cols).limit(WITNESS_ROWS).agg(*[F.min(c) != F.max(c) for c in cols]).first()
        cols = [c for c, differs in zip(cols, row) if not differs]
    if not cols:
        return []
    row = df.agg(*[(F.count(c) > 1) & (F.min(c) == F.max(c)) for c in cols]).first()
    return [c for c, constant in zip(cols, row) if constant]


def drop_zero_variance(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Drop zero-variance numeric columns; returns (frame, dropped names)."""
    const = zero_variance_columns(df)
    return (df.drop(*const) if const else df), const


def engineer(df: DataFrame, method: str = "exact", drop_constant: bool = True) -> DataFrame:
    """The feature stage in the reference's group order (38 columns), then P9."""
    out = add_temporal(df)
    out = add_holiday(out)
    out = add_promotion(out)
    out = add_store_dept(out, method)
    out = add_economic(out)
    out = add_interactions(out)
    out = add_cyclical(out)
    if drop_constant:
        out, _ = drop_zero_variance(out)
    return out


def add_eda_helpers(df: DataFrame) -> DataFrame:
    """Preprocessing step 1: YearMonth, YearWeek, Sales_Label, StoreTypeLabel, SalesBucket, HolidayName."""
    cols = {"YearMonth": cal.year_month("Date"), "YearWeek": cal.year_week("Date")}
    cols.update(X.label_columns())
    return df.withColumns(cols)
