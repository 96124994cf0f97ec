"""Queries of the EDA / dashboard aggregates (A3–A21, W5, W6) on the EDA table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import aggregates as A
from shelfspark.operators import density as D
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql


def _eda(spark, sf_dir):
    return stages.eda(spark, sf_dir)


@register(
    "a3_class_sales_summary",
    stage_sql(
        "SELECT Sales_Class, avg(Weekly_Sales) AS mean, quantile_cont(Weekly_Sales, 0.5) AS median, stddev_samp(Weekly_Sales) AS std, "
        "count(Weekly_Sales) AS count, min(Weekly_Sales) AS min, max(Weekly_Sales) AS max FROM eda GROUP BY Sales_Class"
    ),
    round_cols=["mean", "median", "std", "min", "max"],
)
def a3(spark, sf_dir):
    return A.class_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a4_weekly_sales_ts",
    stage_sql(
        "SELECT Date, avg(Weekly_Sales) AS avg_sales, sum(Weekly_Sales) AS total_sales, avg(Sales_Class) AS high_pct, "
        "count(Weekly_Sales) AS count FROM eda GROUP BY Date"
    ),
    round_cols=["avg_sales", ("total_sales", 5), "high_pct"],
)
def a4(spark, sf_dir):
    return A.weekly_series(_eda(spark, sf_dir))


@register(
    "a5_monthly_summary",
    stage_sql(
        "SELECT Month, avg(Weekly_Sales) AS avg_sales, quantile_cont(Weekly_Sales, 0.5) AS median_sales, avg(Sales_Class) AS high_pct, "
        "avg(Temperature) AS avg_temp, avg(Unemployment) AS avg_unemployment FROM eda GROUP BY Month"
    ),
    round_cols=["avg_sales", "median_sales", "high_pct", "avg_temp", "avg_unemployment"],
)
def a5(spark, sf_dir):
    return A.monthly_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a6_holiday_summary",
    stage_sql(
        "SELECT HolidayName, avg(Weekly_Sales) AS avg_sales, avg(Sales_Class) AS high_pct, count(Weekly_Sales) AS count "
        "FROM eda GROUP BY HolidayName"
    ),
    round_cols=["avg_sales", "high_pct"],
)
def a6(spark, sf_dir):
    return A.holiday_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a7_holiday_phase_means",
    stage_sql(
        "SELECT * FROM (VALUES ('Pre-Holiday', (SELECT avg(Weekly_Sales) FROM eda WHERE IsPreHoliday = 1)), "
        "('Holiday', (SELECT avg(Weekly_Sales) FROM eda WHERE IsHoliday)), "
        "('Post-Holiday', (SELECT avg(Weekly_Sales) FROM eda WHERE IsPostHoliday = 1)), "
        "('Non-Holiday', (SELECT avg(Weekly_Sales) FROM eda WHERE NOT IsHoliday)), "
        "('Regular', (SELECT avg(Weekly_Sales) FROM eda WHERE NOT IsHoliday AND IsPreHoliday = 0 AND IsPostHoliday = 0))) "
        "AS t(period, avg_sales) WHERE avg_sales IS NOT NULL"
    ),
    round_cols=["avg_sales"],
)
def a7(spark, sf_dir):
    return A.holiday_phase_means(_eda(spark, sf_dir), digits=None)


@register(
    "a8_yoy_week",
    stage_sql("SELECT Year, Week, avg(Weekly_Sales) AS avg_sales FROM eda GROUP BY Year, Week"),
    round_cols=["avg_sales"],
)
def a8w(spark, sf_dir):
    return A.year_over_year(_eda(spark, sf_dir), "Week", digits=None)


@register(
    "a8_yoy_month",
    stage_sql("SELECT Year, Month, avg(Weekly_Sales) AS avg_sales FROM eda GROUP BY Year, Month"),
    round_cols=["avg_sales"],
)
def a8m(spark, sf_dir):
    return A.year_over_year(_eda(spark, sf_dir), "Month", digits=None)


@register(
    "a9_store_summary",
    stage_sql(
        "SELECT Store, Type, avg(Weekly_Sales) AS avg_sales, min(Size) AS size, avg(Sales_Class) AS high_pct, "
        "count(DISTINCT Dept) AS dept_count FROM eda GROUP BY Store, Type"
    ),
    round_cols=["avg_sales", "high_pct"],
)
def a9(spark, sf_dir):
    return A.store_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a10_dept_summary",
    stage_sql(
        "SELECT Dept, avg(Weekly_Sales) AS avg_sales, avg(Sales_Class) AS high_pct, count(DISTINCT Store) AS store_count "
        "FROM eda GROUP BY Dept"
    ),
    round_cols=["avg_sales", "high_pct"],
)
def a10(spark, sf_dir):
    return A.dept_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a11_store_type_breakdown",
    stage_sql(
        "SELECT Type, count(DISTINCT Store) AS store_count, avg(Weekly_Sales) AS avg_sales, "
        "quantile_cont(Weekly_Sales, 0.5) AS median_sales, avg(Size) AS avg_size, avg(Sales_Class) AS high_pct FROM eda GROUP BY Type"
    ),
    round_cols=["avg_sales", "median_sales", "avg_size", "high_pct"],
)
def a11(spark, sf_dir):
    return A.store_type_breakdown(_eda(spark, sf_dir), digits=None)


@register(
    "a12_year_summary",
    stage_sql(
        "SELECT Year, avg(Weekly_Sales) AS avg_sales, sum(Weekly_Sales) AS total_sales, avg(Sales_Class) AS high_pct, "
        "count(DISTINCT Date) AS weeks FROM eda GROUP BY Year"
    ),
    round_cols=["avg_sales", ("total_sales", 5), "high_pct"],
)
def a12(spark, sf_dir):
    return A.year_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a13_promotion_summary",
    stage_sql(
        "SELECT HasAnyMarkDown, avg(Weekly_Sales) AS avg_sales, avg(Sales_Class) AS high_pct, count(Weekly_Sales) AS count "
        "FROM eda GROUP BY HasAnyMarkDown"
    ),
    round_cols=["avg_sales", "high_pct"],
)
def a13(spark, sf_dir):
    return A.promotion_summary(_eda(spark, sf_dir), digits=None)


@register(
    "a13_active_markdown_count",
    stage_sql(
        "SELECT ActiveMarkDownCount, avg(Weekly_Sales) AS avg_sales, avg(Sales_Class) AS high_pct, count(Weekly_Sales) AS count "
        "FROM eda GROUP BY ActiveMarkDownCount"
    ),
    round_cols=["avg_sales", "high_pct"],
)
def a13b(spark, sf_dir):
    return A.promotion_summary(_eda(spark, sf_dir), key="ActiveMarkDownCount", digits=None)


@register(
    "a14_markdown_active_means",
    stage_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column, COALESCE(avg(CASE WHEN {c} > 0 THEN {c} END), 0e0) AS active_mean FROM eda"
            for c in C.MARKDOWN_COLUMNS
        )
    ),
    round_cols=["active_mean"],
)
def a14(spark, sf_dir):
    return A.markdown_active_means(_eda(spark, sf_dir), digits=None)


@register(
    "a15_economic_series",
    stage_sql(
        "SELECT Date, " + ", ".join(f"avg({c}) AS {c}" for c in A.ECON_COLUMNS) + " FROM eda GROUP BY Date"
    ),
    round_cols=list(A.ECON_COLUMNS),
)
def a15(spark, sf_dir):
    return A.economic_series(_eda(spark, sf_dir), digits=None)


@register(
    "a16_kpi_metrics",
    stage_sql(
        "SELECT count(*) AS total_records, count(DISTINCT Store) AS total_stores, count(DISTINCT Dept) AS total_departments, "
        "{r2avg} AS avg_weekly_sales, {r2high} AS high_sales_pct, min(Date) AS date_start, max(Date) AS date_end, "
        "{r2t} AS avg_temperature, {r2u} AS avg_unemployment, {r2f} AS avg_fuel_price, {r2p} AS promo_pct, "
        "{r2m} AS median_weekly_sales FROM eda".format(
            r2avg="CAST(ROUND(CAST(avg(Weekly_Sales) AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2high="CAST(ROUND(CAST(avg(Sales_Class) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2t="CAST(ROUND(CAST(avg(Temperature) AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2u="CAST(ROUND(CAST(avg(Unemployment) AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2f="CAST(ROUND(CAST(avg(Fuel_Price) AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2p="CAST(ROUND(CAST(avg(HasAnyMarkDown) * 100 AS DECIMAL(38,12)), 2) AS DOUBLE)",
            r2m="CAST(ROUND(CAST(quantile_cont(Weekly_Sales, 0.5) AS DECIMAL(38,12)), 2) AS DOUBLE)",
        )
    ),
)
def a16(spark, sf_dir):
    return A.kpi_metrics(_eda(spark, sf_dir))


@register(
    "a17_lifts",
    stage_sql(
        "SELECT (avg(CASE WHEN IsHoliday THEN Weekly_Sales END) / avg(CASE WHEN NOT IsHoliday THEN Weekly_Sales END) - 1) * 100 AS holiday_lift_pct, "
        "(avg(CASE WHEN HasAnyMarkDown = 1 THEN Weekly_Sales END) / avg(CASE WHEN HasAnyMarkDown = 0 THEN Weekly_Sales END) - 1) * 100 AS promo_lift_pct, "
        "avg(CASE WHEN Type = 'A' THEN Weekly_Sales END) / avg(CASE WHEN Type = 'C' THEN Weekly_Sales END) AS type_a_c_ratio FROM eda"
    ),
    round_cols=["holiday_lift_pct", "promo_lift_pct", "type_a_c_ratio"],
)
def a17(spark, sf_dir):
    return A.lifts(_eda(spark, sf_dir), digits=None)


_MONTHS = list(range(1, 13))


@register(
    "a18_store_month_pivot",
    stage_sql(
        "SELECT Store, " + ", ".join(f"avg(CASE WHEN Month = {m} THEN Weekly_Sales END) AS Month_{m}" for m in _MONTHS)
        + " FROM eda GROUP BY Store"
    ),
    round_cols=[f"Month_{m}" for m in _MONTHS],
)
def a18(spark, sf_dir):
    return A.pivot_mean(_eda(spark, sf_dir), "Store", "Month", _MONTHS, digits=None)


_WEEKS = list(range(1, 54))


@register(
    "a18_store_week_pivot",
    stage_sql(
        "SELECT Store, " + ", ".join(f"avg(CASE WHEN Week = {w} THEN Weekly_Sales END) AS Week_{w}" for w in _WEEKS)
        + " FROM eda GROUP BY Store"
    ),
    round_cols=[f"Week_{w}" for w in _WEEKS],
)
def a18c(spark, sf_dir):
    """Mean sales by store and ISO week."""
    return A.pivot_mean(_eda(spark, sf_dir), "Store", "Week", _WEEKS, digits=None)


@register(
    "a18_type_size_quartile_pivot",
    stage_sql(
        "SELECT Type, " + ", ".join(f"avg(CASE WHEN SizeQuartile = {q} THEN Weekly_Sales END) AS SizeQuartile_{q}" for q in range(1, 5))
        + " FROM eda GROUP BY Type"
    ),
    round_cols=[f"SizeQuartile_{q}" for q in range(1, 5)],
)
def a18b(spark, sf_dir):
    return A.pivot_mean(_eda(spark, sf_dir), "Type", "SizeQuartile", [1, 2, 3, 4], digits=None)


@register(
    "a19_type_holiday_high_pct",
    stage_sql(
        "SELECT Type, avg(CASE WHEN NOT IsHoliday THEN Sales_Class END) * 100 AS IsHoliday_false, "
        "avg(CASE WHEN IsHoliday THEN Sales_Class END) * 100 AS IsHoliday_true FROM eda GROUP BY Type"
    ),
    round_cols=["IsHoliday_false", "IsHoliday_true"],
)
def a19(spark, sf_dir):
    df = _eda(spark, sf_dir).withColumn("IsHoliday", F.col("IsHoliday").cast("string"))
    return A.pivot_mean(df, "Type", "IsHoliday", ["false", "true"], value="Sales_Class", scale=100.0, digits=None)


@register(
    "a19_size_quarter_segment",
    stage_sql("SELECT SizeQuartile, Quarter, avg(Sales_Class) * 100 AS value FROM eda GROUP BY SizeQuartile, Quarter"),
    round_cols=["value"],
)
def a19b(spark, sf_dir):
    return A.segment_long(_eda(spark, sf_dir), "SizeQuartile", "Quarter", "Sales_Class", scale=100.0, digits=None)


@register(
    "a19_promo_holiday_segment",
    stage_sql("SELECT HasAnyMarkDown, IsHoliday, avg(Weekly_Sales) AS value FROM eda GROUP BY HasAnyMarkDown, IsHoliday"),
    round_cols=["value"],
)
def a19c(spark, sf_dir):
    return A.segment_long(_eda(spark, sf_dir), "HasAnyMarkDown", "IsHoliday", "Weekly_Sales", digits=None)


@register(
    "a19_type_promo_segment",
    stage_sql("SELECT Type, HasAnyMarkDown, avg(Weekly_Sales) AS value FROM eda GROUP BY Type, HasAnyMarkDown"),
    round_cols=["value"],
)
def a19d(spark, sf_dir):
    return A.segment_long(_eda(spark, sf_dir), "Type", "HasAnyMarkDown", "Weekly_Sales", digits=None)


@register(
    "a20_depts_per_store",
    stage_sql("SELECT Store, count(DISTINCT Dept) AS dept_count FROM eda GROUP BY Store"),
)
def a20(spark, sf_dir):
    return A.distinct_per_group(_eda(spark, sf_dir), "Store", "Dept", "dept_count")


@register(
    "a20_stores_per_dept",
    stage_sql("SELECT Dept, count(DISTINCT Store) AS store_count FROM eda GROUP BY Dept"),
)
def a20b(spark, sf_dir):
    return A.distinct_per_group(_eda(spark, sf_dir), "Dept", "Store", "store_count")


@register("a21_holiday_dates", stage_sql("SELECT DISTINCT Date FROM eda WHERE IsHoliday"))
def a21(spark, sf_dir):
    return A.holiday_dates(_eda(spark, sf_dir))


@register(
    "w5_top10_stores",
    stage_sql("SELECT Store, avg(Weekly_Sales) AS avg_sales FROM eda GROUP BY Store ORDER BY avg_sales DESC, Store LIMIT 10"),
    round_cols=["avg_sales"],
)
def w5a(spark, sf_dir):
    return A.top_groups(_eda(spark, sf_dir), "Store", 10, digits=None)


@register(
    "w5_bottom5_stores",
    stage_sql("SELECT Store, avg(Weekly_Sales) AS avg_sales FROM eda GROUP BY Store ORDER BY avg_sales ASC, Store LIMIT 5"),
    round_cols=["avg_sales"],
)
def w5b(spark, sf_dir):
    return A.top_groups(_eda(spark, sf_dir), "Store", 5, ascending=True, digits=None)


@register(
    "w5_top20_depts",
    stage_sql(
        "SELECT Dept, avg_sales, avg_sales > (SELECT avg(Weekly_Sales) FROM eda) AS above_overall_mean FROM "
        "(SELECT Dept, avg(Weekly_Sales) AS avg_sales FROM eda GROUP BY Dept ORDER BY avg_sales DESC, Dept LIMIT 20)"
    ),
    round_cols=["avg_sales"],
)
def w5c(spark, sf_dir):
    return A.top_groups(_eda(spark, sf_dir), "Dept", 20, digits=None, flag_above_mean=True)


# Comparison tolerance per query: averages over thousands of rows carry ~1e-9 of
# summation-order noise, so they are compared at 4 decimals; small groups at 6.
def _set_digits() -> None:
    from shelfspark.plans.catalog import REGISTRY

    for name, d in {
        "a3_class_sales_summary": 4, "a4_weekly_sales_ts": 6, "a5_monthly_summary": 4, "a6_holiday_summary": 4,
        "a7_holiday_phase_means": 4, "a8_yoy_week": 5, "a8_yoy_month": 4, "a9_store_summary": 4,
        "a10_dept_summary": 4, "a11_store_type_breakdown": 4, "a12_year_summary": 4, "a13_promotion_summary": 4,
        "a13_active_markdown_count": 4, "a14_markdown_active_means": 4, "a15_economic_series": 6, "a17_lifts": 6,
        "a18_store_month_pivot": 5, "a18_type_size_quartile_pivot": 4, "a19_type_holiday_high_pct": 6,
        "a19_size_quarter_segment": 6, "a19_promo_holiday_segment": 4, "a19_type_promo_segment": 4,
        "w5_top10_stores": 4, "w5_bottom5_stores": 4, "w5_top20_depts": 4,
    }.items():
        REGISTRY[name].digits = d


_set_digits()


#: Columns of the density plots.
DENSITY_COLUMNS = ["Weekly_Sales", "Temperature", "Unemployment", "TotalMarkDown"]
DENSITY_POINTS = 200


def _density_sql() -> str:
    """The direct sum over all rows at every point."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(Sales_Class AS VARCHAR) AS own, CAST({c} AS DOUBLE) AS v FROM eda WHERE {c} IS NOT NULL" for c in DENSITY_COLUMNS)
    extra = f"""long AS MATERIALIZED ({long}),
grouped AS MATERIALIZED (SELECT "column", own AS grp, v FROM long WHERE own IS NOT NULL UNION ALL SELECT "column", 'all', v FROM long),
stats AS MATERIALIZED (SELECT "column", grp, count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM grouped GROUP BY ALL),
axis AS (SELECT "column", lo - 3 * h AS start, (hi - lo + 6 * h) / {DENSITY_POINTS - 1} AS gap, sd AS whole_sd FROM stats WHERE grp = 'all' AND h > 0),
places AS (SELECT s."column", s.grp, n, h, start, gap, whole_sd, point, start + point * gap AS x FROM stats s JOIN axis a ON s."column" = a."column", range({DENSITY_POINTS}) r(point) WHERE h > 0),
freq AS MATERIALIZED (SELECT "column", grp, v, count(*) AS times FROM grouped GROUP BY ALL)"""
    return stage_sql(
        """SELECT p."column", p.grp AS "group", CAST(p.point AS INTEGER) AS point, any_value(p.x) AS x,
    sum(times * exp(-0.5 * ((p.x - f.v) / h) * ((p.x - f.v) / h))) / any_value(n * h * sqrt(2 * pi())) * any_value(whole_sd) AS scaled
FROM places p JOIN freq f ON f."column" = p."column" AND f.grp = p.grp GROUP BY p."column", p.grp, p.point""",
        extra,
    )


@register("d19_density_curves", _density_sql(), round_cols=[("x", 6), ("scaled", 4)])
def d19(spark, sf_dir):
    """Density curves of sales and of the features of the pair plot, whole and by class."""
    out = D.density_curves(_eda(spark, sf_dir), DENSITY_COLUMNS, by="Sales_Class", points=DENSITY_POINTS)
    return out.select("column", "group", "point", "x", "scaled")
