"""Queries of the acquire stage: sources, joins, audits, target (S, J, A1, A2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import aggregates as A
from shelfspark.operators import joins as J
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.sources import files
from shelfspark.sources import retail_view as rv

FACT_COLS = ["Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"]


@register(
    "flagship_weekly_sales",
    stage_sql(
        "SELECT Date, avg(Weekly_Sales) AS avg_sales, sum(Weekly_Sales) AS total_sales, "
        "avg(Sales_Class) AS high_pct, count(Weekly_Sales) AS count FROM merged GROUP BY Date"
    ),
    round_cols=["avg_sales", ("total_sales", 5), "high_pct"],
    digits=6,
)
def flagship_weekly_sales(spark, sf_dir):
    """Minimum slice: facts ⟕ stores → as-of series → store-median target → weekly series."""
    return A.weekly_series(rv.merged(spark, sf_dir))


@register(
    "s6_nan_to_null_facts",
    stage_sql("SELECT * FROM facts"),
    round_cols=["Weekly_Sales", "MarkDown1", "MarkDown2", "MarkDown4", "CPI", "Fuel_Price", "Unemployment"],
)
def s6_facts(spark, sf_dir):
    return files.nan_to_null(rv.facts(spark, sf_dir))


@register("j1_store_join", stage_sql("SELECT f.*, s.Type, s.Size FROM facts f LEFT JOIN stores s ON f.Store = s.Store"),
          round_cols=["Weekly_Sales", "MarkDown1", "MarkDown2", "MarkDown4", "CPI", "Fuel_Price", "Unemployment"])
def j1_store_join(spark, sf_dir):
    return J.left_join_dim(rv.facts(spark, sf_dir), rv.stores(spark, sf_dir), ["Store"])


_CONTEXT_SQL = """
ctx AS (
  SELECT Store, Date, avg(Temperature) AS Temperature, avg(Fuel_Price) AS Fuel_Price,
         avg(MarkDown1) AS MarkDown1, avg(MarkDown2) AS MarkDown2, avg(MarkDown3) AS MarkDown3,
         avg(MarkDown4) AS MarkDown4, avg(MarkDown5) AS MarkDown5, avg(CPI) AS CPI,
         avg(Unemployment) AS Unemployment, bool_or(IsHoliday) AS IsHoliday
  FROM facts GROUP BY Store, Date
),
fx AS (SELECT Store, Dept, Date, Weekly_Sales, IsHoliday FROM facts)
"""
_CTX_MEASURES = ["Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5", "CPI", "Unemployment"]


@register(
    "j2_context_join",
    stage_sql(
        "SELECT fx.*, " + ", ".join(f"c.{m}" for m in _CTX_MEASURES) + " FROM fx LEFT JOIN ctx c ON fx.Store = c.Store AND fx.Date = c.Date",
        _CONTEXT_SQL,
    ),
    round_cols=["Weekly_Sales", *_CTX_MEASURES],
)
def j2_context_join(spark, sf_dir):
    """J2 + P1: composite-key join; the colliding IsHoliday of the context is dropped."""
    f = rv.facts(spark, sf_dir).select(*FACT_COLS)
    return J.left_join_suffixed(f, rv.store_week_context(spark, sf_dir), ["Store", "Date"])


@register("j3_series_outer_join", stage_sql("SELECT * FROM series"), round_cols=["PCE"])
def j3_series(spark, sf_dir):
    return rv.monthly_series(spark, sf_dir)


@register(
    "j4_asof_join",
    stage_sql(
        "SELECT f.Store, f.Dept, f.Date, f.Weekly_Sales, m.UMCSENT, m.RSXFS, m.PCE "
        "FROM facts f ASOF LEFT JOIN series m ON f.Date >= m.Date"
    ),
    round_cols=["Weekly_Sales", "PCE"],
)
def j4_asof(spark, sf_dir):
    f = rv.facts(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales")
    return J.asof_join(f, rv.monthly_series(spark, sf_dir), on="Date")


@register(
    "j4_asof_join_by_store",
    stage_sql(
        "SELECT f.Store, f.Date, f.Weekly_Sales, m.prev_sales, m.prev_date "
        "FROM facts f ASOF LEFT JOIN (SELECT Store, Date, Date AS prev_date, sum(Weekly_Sales) AS prev_sales FROM facts "
        "WHERE IsHoliday GROUP BY Store, Date) m ON f.Store = m.Store AND f.Date >= m.Date"
    ),
    round_cols=["Weekly_Sales", "prev_sales"],
)
def j4_asof_by(spark, sf_dir):
    """J4 with a ``by`` key: latest holiday (Store, Date) total at or before each fact."""
    f = rv.facts(spark, sf_dir)
    right = (
        f.where(F.col("IsHoliday"))
        .groupBy("Store", "Date")
        .agg(F.sum("Weekly_Sales").alias("prev_sales"))
        .withColumn("prev_date", F.col("Date"))
    )
    return J.asof_join(f.select("Store", "Date", "Weekly_Sales"), right, on="Date", by=["Store"])


@register(
    "j5_join_audit",
    stage_sql(
        "SELECT 'context' AS step, (SELECT count(*) FROM fx) AS left_rows, (SELECT count(*) FROM ctx) AS right_rows, "
        "count(*) AS output_rows, count_if(c.Store IS NULL) AS unmatched_left_rows, "
        "count_if(" + " OR ".join(f"c.{m} IS NULL" for m in _CTX_MEASURES) + ") AS rows_with_any_new_nulls, "
        + ", ".join(f"count_if(c.{m} IS NULL) AS nulls_{m}" for m in _CTX_MEASURES)
        + " FROM fx LEFT JOIN ctx c ON fx.Store = c.Store AND fx.Date = c.Date",
        _CONTEXT_SQL,
    ),
)
def j5_join_audit(spark, sf_dir):
    f = rv.facts(spark, sf_dir).select(*FACT_COLS)
    _, audit = J.join_audit(f, rv.store_week_context(spark, sf_dir), ["Store", "Date"], step="context")
    return audit


@register(
    "j6_asof_audit",
    stage_sql(
        "SELECT 'asof' AS step, (SELECT count(*) FROM facts) AS left_rows, (SELECT count(*) FROM series) AS right_rows, "
        "count(*) AS output_rows, count_if(UMCSENT IS NULL AND RSXFS IS NULL AND PCE IS NULL) AS unmatched_left_rows, "
        "count_if(UMCSENT IS NULL OR RSXFS IS NULL OR PCE IS NULL) AS rows_with_any_new_nulls, "
        "count_if(UMCSENT IS NULL) AS nulls_UMCSENT, count_if(RSXFS IS NULL) AS nulls_RSXFS, count_if(PCE IS NULL) AS nulls_PCE "
        "FROM merged"
    ),
)
def j6_asof_audit(spark, sf_dir):
    m = stages.merged(spark, sf_dir)
    return J.asof_audit(m, rv.facts(spark, sf_dir), rv.monthly_series(spark, sf_dir), on="Date")


@register(
    "j8_map_group_stat",
    stage_sql(
        "SELECT f.Store, f.Dept, f.Date, d.n AS StoreDeptCount FROM facts f "
        "LEFT JOIN (SELECT Store, count(DISTINCT Dept) AS n FROM facts GROUP BY Store) d ON f.Store = d.Store"
    ),
)
def j8_map_stat(spark, sf_dir):
    f = rv.facts(spark, sf_dir).select("Store", "Dept", "Date")
    return J.map_group_stat(f, "Store", F.countDistinct("Dept"), "StoreDeptCount")


@register(
    "a1_store_median_target",
    stage_sql("SELECT Store, Dept, Date, Weekly_Sales, Sales_Class FROM merged"),
    round_cols=["Weekly_Sales"],
)
def a1_target(spark, sf_dir):
    return stages.merged(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales", "Sales_Class")


@register(
    "a1_merged_table",
    stage_sql("SELECT * FROM merged"),
    round_cols=["Weekly_Sales", "MarkDown1", "MarkDown2", "MarkDown4", "CPI", "Fuel_Price", "Unemployment", "PCE"],
)
def a1_merged(spark, sf_dir):
    return stages.merged(spark, sf_dir)


@register(
    "a2_class_distribution",
    stage_sql(
        "SELECT Sales_Class AS class, count(*) AS count, "
        "CAST(ROUND(CAST(count(*) * 100e0 / sum(count(*)) OVER () AS DECIMAL(38,12)), 2) AS DOUBLE) AS pct, "
        "CAST(ROUND(CAST(max(count(*)) OVER () / min(count(*)) OVER () AS DECIMAL(38,12)), 3) AS DOUBLE) AS imbalance_ratio "
        "FROM merged GROUP BY Sales_Class"
    ),
)
def a2_class_distribution(spark, sf_dir):
    return A.class_distribution(stages.merged(spark, sf_dir))
