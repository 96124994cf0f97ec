"""Group-by aggregates of the EDA / dashboard stage.

Every operator is one ``groupBy().agg()`` (partial aggregation on the map
side, one shuffle on the group key) unless noted.  pandas drops NULL group
keys, so group operators filter ``key IS NOT NULL``.  ``digits`` rounds the
outputs half-up like the reference's ``.round(n)``; ``None`` keeps full
precision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators.common import fixed_round, one_row_concat, safe_div
from shelfspark.operators.ranks import group_quantiles
from shelfspark.session import cut_lineage

SALES = "Weekly_Sales"
TARGET = C.TARGET


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else fixed_round(c, digits)


def _nonnull(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def group_medians(df: DataFrame, value: str, groups: Sequence[str], name: str = "median") -> DataFrame:
    """Exact median of ``value`` per group (rank-table quantile, skew-safe)."""
    return group_quantiles(df, value, [0.5], groups).select(*groups, F.col("q").alias(name))


# --- A1 / W1 -----------------------------------------------------------------
def add_store_median_target(
    df: DataFrame,
    value: str = SALES,
    group: str = "Store",
    out: str = TARGET,
    median_source: DataFrame | None = None,
) -> DataFrame:
    """A1: ``out = value > median(value) over its group`` as 0/1 (ties and NULL → 0).

    The per-group medians (one row per group) are written and joined back: the planner sees their bytes.
    ``median_source`` may be an upstream (persisted) frame with the same rows of
    ``group`` and ``value``, so the medians do not re-run the plan of ``df``."""
    src = df if median_source is None else median_source
    med = cut_lineage(group_medians(src.where(F.col(group).isNotNull()), value, [group], "_median"), "medians")
    joined = df.join(med, group, "left")
    flag = F.coalesce(F.col(value) > F.col("_median"), F.lit(False)).cast("int")
    return joined.withColumn(out, flag).drop("_median").select(*df.columns, out)


# --- A2 ----------------------------------------------------------------------
def class_distribution(df: DataFrame, target: str = TARGET, digits: int = 2) -> DataFrame:
    """A2: class, count, pct of all labelled rows, imbalance ratio (max/min count).  A NULL target is no class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_sum"), F.max("count").alias("_max"), F.min("count").alias("_min"))
    return one_row_concat(counts, F.broadcast(total)).select(
        F.col(target).alias("class"),
        "count",
        _r(F.col("count") * 100.0 / F.col("_sum"), digits).alias("pct"),
        _r(F.col("_max") / F.col("_min"), 3).alias("imbalance_ratio"),
    )


# --- A3 ----------------------------------------------------------------------
def class_summary(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int | None = 4) -> DataFrame:
    """A3: mean / median / std / count / min / max of ``value`` per class."""
    base = _nonnull(df, [target])
    agg = base.groupBy(target).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.count(value).alias("count"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    med = group_medians(base, value, [target])
    out = agg.join(med, target, "left")
    return out.select(
        target,
        _r(F.col("mean"), digits).alias("mean"),
        _r(F.col("median"), digits).alias("median"),
        _r(F.col("std"), digits).alias("std"),
        "count",
        _r(F.col("min"), digits).alias("min"),
        _r(F.col("max"), digits).alias("max"),
    )


# --- A4 ----------------------------------------------------------------------
def weekly_series(df: DataFrame, date: str = "Date", value: str = SALES, target: str = TARGET, digits: int | None = None) -> DataFrame:
    """A4: per date: avg_sales, total_sales, high_pct (share of class 1), count."""
    return _nonnull(df, [date]).groupBy(date).agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        _r(F.sum(value), digits).alias("total_sales"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.count(value).alias("count"),
    )


# --- A5 ----------------------------------------------------------------------
def monthly_summary(df: DataFrame, month: str = "Month", value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """A5: per month: mean and median sales, high share, mean temperature and unemployment."""
    base = _nonnull(df, [month])
    agg = base.groupBy(month).agg(
        F.avg(value).alias("avg_sales"),
        F.avg(target).alias("high_pct"),
        F.avg("Temperature").alias("avg_temp"),
        F.avg("Unemployment").alias("avg_unemployment"),
    )
    med = group_medians(base, value, [month], "median_sales")
    out = agg.join(med, month, "left")
    return out.select(month, *[_r(F.col(c), digits).alias(c) for c in ["avg_sales", "median_sales", "high_pct", "avg_temp", "avg_unemployment"]])


# --- A6 ----------------------------------------------------------------------
def holiday_summary(df: DataFrame, name: str = "HolidayName", value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """Per holiday name: avg sales, high share, count (order by avg desc at presentation)."""
    return _nonnull(df, [name]).groupBy(name).agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.count(value).alias("count"),
    )


# --- A7 ----------------------------------------------------------------------
def holiday_phase_means(df: DataFrame, value: str = SALES, digits: int | None = 2) -> DataFrame:
    """Mean sales in Pre-Holiday / Holiday / Post-Holiday / Non-Holiday weeks and
    "Regular" (none of the three) — one pass, unpivoted, empty phases dropped."""
    hol = F.coalesce(F.col("IsHoliday").cast("int"), F.lit(0))
    pre = F.col("IsPreHoliday")
    post = F.col("IsPostHoliday")
    phases = [
        ("Pre-Holiday", pre == 1),
        ("Holiday", hol == 1),
        ("Post-Holiday", post == 1),
        ("Non-Holiday", hol == 0),
        ("Regular", (hol == 0) & (pre == 0) & (post == 0)),
    ]
    wide = df.agg(*[F.avg(F.when(cond, F.col(value))).alias(f"p{i}") for i, (_, cond) in enumerate(phases)])
    stack = ", ".join(f"'{n}', p{i}" for i, (n, _) in enumerate(phases))
    long = wide.selectExpr(f"stack({len(phases)}, {stack}) AS (period, avg_sales)")
    return long.where(F.col("avg_sales").isNotNull()).select("period", _r(F.col("avg_sales"), digits).alias("avg_sales"))


# --- A8 ----------------------------------------------------------------------
def year_over_year(df: DataFrame, period: str = "Week", value: str = SALES, digits: int | None = 2) -> DataFrame:
    """Mean sales by (Year, Week) or (Year, Month)."""
    return _nonnull(df, ["Year", period]).groupBy("Year", period).agg(_r(F.avg(value), digits).alias("avg_sales"))


# --- A9 ----------------------------------------------------------------------
def store_summary(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """Per (Store, Type): avg sales, size (constant per store → min), high share, distinct depts."""
    return _nonnull(df, ["Store", "Type"]).groupBy("Store", "Type").agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        F.min("Size").alias("size"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.countDistinct("Dept").alias("dept_count"),
    )


# --- A10 ---------------------------------------------------------------------
def dept_summary(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """A10: per Dept: avg sales, high share, distinct stores."""
    return _nonnull(df, ["Dept"]).groupBy("Dept").agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.countDistinct("Store").alias("store_count"),
    )


# --- A11 ---------------------------------------------------------------------
def store_type_breakdown(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """Per Type: distinct stores, mean and median sales, mean size, high share."""
    base = _nonnull(df, ["Type"])
    agg = base.groupBy("Type").agg(
        F.countDistinct("Store").alias("store_count"),
        F.avg(value).alias("avg_sales"),
        F.avg("Size").alias("avg_size"),
        F.avg(target).alias("high_pct"),
    )
    out = agg.join(group_medians(base, value, ["Type"], "median_sales"), "Type", "left")
    return out.select("Type", "store_count", *[_r(F.col(c), digits).alias(c) for c in ["avg_sales", "median_sales", "avg_size", "high_pct"]])


# --- A12 ---------------------------------------------------------------------
def year_summary(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """Per Year: avg and total sales, high share, distinct weeks (dates)."""
    return _nonnull(df, ["Year"]).groupBy("Year").agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        _r(F.sum(value), digits).alias("total_sales"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.countDistinct("Date").alias("weeks"),
    )


# --- A13 ---------------------------------------------------------------------
def promotion_summary(df: DataFrame, key: str = "HasAnyMarkDown", value: str = SALES, target: str = TARGET, digits: int | None = 2) -> DataFrame:
    """Per promotion flag (or ``ActiveMarkDownCount``): avg sales, high share, count."""
    return _nonnull(df, [key]).groupBy(key).agg(
        _r(F.avg(value), digits).alias("avg_sales"),
        _r(F.avg(target), digits).alias("high_pct"),
        F.count(value).alias("count"),
    )


# --- A14 ---------------------------------------------------------------------
def markdown_active_means(df: DataFrame, columns: Sequence[str] = C.MARKDOWN_COLUMNS, digits: int | None = 2) -> DataFrame:
    """Per markdown column, the mean over rows where it is > 0 (0 if none) — one pass."""
    cols = [c for c in columns if c in df.columns]
    wide = df.agg(*[F.coalesce(F.avg(F.when(F.col(c) > 0, F.col(c))), F.lit(0.0)).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "active_mean")
    return long.select("column", _r(F.col("active_mean"), digits).alias("active_mean"))


# --- A15 ---------------------------------------------------------------------
ECON_COLUMNS = ["UMCSENT", "RSXFS", "PCE", "Unemployment", "CPI", "Fuel_Price"]


def economic_series(df: DataFrame, date: str = "Date", columns: Sequence[str] = ECON_COLUMNS, digits: int | None = 4) -> DataFrame:
    """Mean of each economic column per date."""
    cols = [c for c in columns if c in df.columns]
    return _nonnull(df, [date]).groupBy(date).agg(*[_r(F.avg(c), digits).alias(c) for c in cols])


# --- A16 ---------------------------------------------------------------------
def kpi_metrics(df: DataFrame, value: str = SALES, target: str = TARGET, digits: int = 2) -> DataFrame:
    """One KPI row; the median comes from the exact rank-table quantile."""
    promo = F.avg("HasAnyMarkDown") * 100 if "HasAnyMarkDown" in df.columns else F.lit(0.0)
    agg = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("Store").alias("total_stores"),
        F.countDistinct("Dept").alias("total_departments"),
        fixed_round(F.avg(value), digits).alias("avg_weekly_sales"),
        fixed_round(F.avg(target) * 100, digits).alias("high_sales_pct"),
        F.min("Date").alias("date_start"),
        F.max("Date").alias("date_end"),
        fixed_round(F.avg("Temperature"), digits).alias("avg_temperature"),
        fixed_round(F.avg("Unemployment"), digits).alias("avg_unemployment"),
        fixed_round(F.avg("Fuel_Price"), digits).alias("avg_fuel_price"),
        fixed_round(promo, digits).alias("promo_pct"),
    )
    med = group_quantiles(df, value, [0.5]).agg(fixed_round(F.max("q"), digits).alias("median_weekly_sales"))
    return one_row_concat(agg, med)


# --- A17 ---------------------------------------------------------------------
def lifts(df: DataFrame, value: str = SALES, digits: int | None = 4) -> DataFrame:
    """Holiday lift and promotion lift in % (mean/mean − 1), Type A / Type C sales ratio."""
    v = F.col(value)
    hol = F.col("IsHoliday").cast("boolean")
    agg = df.agg(
        F.avg(F.when(hol, v)).alias("_h"),
        F.avg(F.when(~hol, v)).alias("_nh"),
        F.avg(F.when(F.col("HasAnyMarkDown") == 1, v)).alias("_p"),
        F.avg(F.when(F.col("HasAnyMarkDown") == 0, v)).alias("_np"),
        F.avg(F.when(F.col("Type") == "A", v)).alias("_a"),
        F.avg(F.when(F.col("Type") == "C", v)).alias("_c"),
    )
    return agg.select(
        _r((safe_div(F.col("_h"), F.col("_nh")) - 1) * 100, digits).alias("holiday_lift_pct"),
        _r((safe_div(F.col("_p"), F.col("_np")) - 1) * 100, digits).alias("promo_lift_pct"),
        _r(safe_div(F.col("_a"), F.col("_c")), digits).alias("type_a_c_ratio"),
    )


# --- A18 / A19 -----------------------------------------------------------------
def pivot_mean(
    df: DataFrame,
    row: str,
    col: str,
    values: Sequence,
    value: str = SALES,
    scale: float = 1.0,
    digits: int | None = 2,
) -> DataFrame:
    """``pivot_table(values=value, index=row, columns=col, aggfunc='mean')``.

    Explicit pivot values avoid the extra distinct job; columns are named ``<col>_<v>``."""
    base = _nonnull(df, [row, col])
    p = base.groupBy(row).pivot(col, list(values)).agg(F.avg(value) * scale)
    return p.select(row, *[_r(F.col(str(v)), digits).alias(f"{col}_{v}") for v in values])


def segment_long(df: DataFrame, a: str, b: str, value: str, scale: float = 1.0, digits: int | None = 2) -> DataFrame:
    """Long form of a two-way segment: (a, b, mean(value)*scale)."""
    return _nonnull(df, [a, b]).groupBy(a, b).agg(_r(F.avg(value) * scale, digits).alias("value"))


# --- A20 ---------------------------------------------------------------------
def distinct_per_group(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Exact distinct count of ``counted`` per ``key``."""
    return _nonnull(df, [key]).groupBy(key).agg(F.countDistinct(counted).alias(name))


# --- A21 ---------------------------------------------------------------------
def holiday_dates(df: DataFrame, date: str = "Date", flag: str = "IsHoliday") -> DataFrame:
    """Distinct dates flagged as holiday."""
    return df.where(F.col(flag).cast("boolean")).select(date).distinct()


# --- W5 ----------------------------------------------------------------------
def top_groups(
    df: DataFrame,
    key: str,
    n: int,
    value: str = SALES,
    ascending: bool = False,
    digits: int | None = 2,
    flag_above_mean: bool = False,
) -> DataFrame:
    """Top-N (or bottom-N) groups by mean ``value``; ties broken by key.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (per-partition top-N)."""
    agg = _nonnull(df, [key]).groupBy(key).agg(F.avg(value).alias("avg_sales"))
    order = F.col("avg_sales").asc() if ascending else F.col("avg_sales").desc()
    top = agg.orderBy(order, F.col(key).asc()).limit(n)
    out = top.select(key, _r(F.col("avg_sales"), digits).alias("avg_sales"))
    if flag_above_mean:
        overall = df.agg(F.avg(value).alias("_overall"))
        out = one_row_concat(top, overall).select(
            key, _r(F.col("avg_sales"), digits).alias("avg_sales"), (F.col("avg_sales") > F.col("_overall")).alias("above_overall_mean")
        )
    return out


# --- W6 ----------------------------------------------------------------------
def best_by(df: DataFrame, metric: str, key: str = "model") -> DataFrame:
    """The row with the highest ``metric`` (ties by key)."""
    return df.orderBy(F.col(metric).desc(), F.col(key).asc()).limit(1)
