"""Queries of the cleaning, feature and preprocessing stages (P, F, W2, W3, D15, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import cleaning as P
from shelfspark.operators import features as FE
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.plans.oracle_sql import r

MERGED_DOUBLES = ["Weekly_Sales", "Temperature", "Fuel_Price", *C.MARKDOWN_COLUMNS, "CPI", "Unemployment", "UMCSENT", "RSXFS", "PCE"]
FEATURE_DOUBLES = [
    "YearProgress", "TotalMarkDown", "AvgMarkDownAmount", "MaxMarkDown", "SizePerType", "ConsumerConfRatio",
    "Temp_Season", "MarkDown_Intensity", "Month_sin", "Month_cos", "Week_sin", "Week_cos",
]


@register("p2_p4_flags_fill_returns", stage_sql("SELECT * FROM flagged"), round_cols=MERGED_DOUBLES)
def p2_p4(spark, sf_dir):
    """P2 missing flags, P3 zero fill, P4 return flag."""
    return P.add_sign_flag(P.flag_and_fill(stages.merged(spark, sf_dir)))


@register(
    "p5_clip_bounds",
    stage_sql(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column, lo_{c} AS lower, hi_{c} AS upper FROM bounds" for c in C.CLIP_COLUMNS
        ) + ")"
    ),
    round_cols=["lower", "upper"],
)
def p5_bounds(spark, sf_dir):
    """1st and 99th percentile (linear interpolation) of each clip column."""
    flagged = P.add_sign_flag(P.flag_and_fill(stages.merged(spark, sf_dir)))
    return P.clip_bounds(flagged)


@register("p5_cleaned_table", stage_sql("SELECT * FROM cleaned"), round_cols=MERGED_DOUBLES)
def p5_cleaned(spark, sf_dir):
    """The cleaning stage: flags, fill, return flag, percentile clip."""
    return P.clean(stages.merged(spark, sf_dir))[0]


def _clip_report_sql() -> str:
    def sk(c: str) -> str:
        return f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE skewness({c}) END"

    parts = []
    for c in C.CLIP_COLUMNS:
        low, high = f"count_if(f.{c} < b.lo_{c})", f"count_if(f.{c} > b.hi_{c})"
        parts.append(
            f"SELECT '{c}' AS column, {r(f'max(b.lo_{c})', 4)} AS lower_bound, {r(f'max(b.hi_{c})', 4)} AS upper_bound, "
            f"{low} AS clipped_low, {high} AS clipped_high, {low} + {high} AS total_clipped, "
            f"{r(f'({low} + {high}) * 100e0 / count(*)', 3)} AS total_clipped_pct, "
            f"{r(f'min(f.{c})', 4)} AS min_before, {r(f'max(f.{c})', 4)} AS max_before, "
            f"{r(f'stddev_samp(f.{c})', 4)} AS std_before, {r(sk(f'f.{c}'), 4)} AS skew_before, "
            f"(SELECT {r(f'min({c})', 4)} FROM cleaned) AS min_after, (SELECT {r(f'max({c})', 4)} FROM cleaned) AS max_after, "
            f"(SELECT {r(f'stddev_samp({c})', 4)} FROM cleaned) AS std_after, "
            f"(SELECT {r(sk(c), 4)} FROM cleaned) AS skew_after "
            f"FROM flagged f CROSS JOIN bounds b"
        )
    return f"SELECT *, {r('skew_before - skew_after', 4)} AS skew_reduction FROM (" + " UNION ALL ".join(parts) + ")"


@register("d15_clip_report", stage_sql(_clip_report_sql()), round_cols=["skew_before", "skew_after", "skew_reduction"], digits=3)
def d15_clip_report(spark, sf_dir):
    """Per-column clip report (bounds, clipped counts, before/after min, max, std, skew)."""
    flagged = P.add_sign_flag(P.flag_and_fill(stages.merged(spark, sf_dir)))
    clipped, bounds = P.percentile_clip(flagged)
    return P.clip_report(flagged, clipped, bounds)


@register("f_featured_table", stage_sql("SELECT * FROM featured"), round_cols=MERGED_DOUBLES + FEATURE_DOUBLES)
def f_featured(spark, sf_dir):
    """The feature stage (F1–F18, W2, A20/J8): 38 engineered columns."""
    return FE.engineer(stages.cleaned(spark, sf_dir))


@register("f19_f20_eda_table", stage_sql("SELECT * FROM eda"), round_cols=MERGED_DOUBLES + FEATURE_DOUBLES)
def f_eda(spark, sf_dir):
    """EDA table: features + YearMonth, YearWeek, Sales_Label, StoreTypeLabel, SalesBucket, HolidayName."""
    return FE.add_eda_helpers(stages.featured(spark, sf_dir))


@register(
    "w2_size_quartile_edges",
    stage_sql("SELECT quantile_cont(Size, 0.0) AS _q0, q1 AS _q1, q2 AS _q2, q3 AS _q3, quantile_cont(Size, 1.0) AS _q4 FROM cleaned CROSS JOIN qedges GROUP BY q1, q2, q3"),
    round_cols=["_q0", "_q1", "_q2", "_q3", "_q4"],
)
def w2_edges(spark, sf_dir):
    """Quartile edges of Size over rows (qcut)."""
    return FE.quartile_edges(stages.cleaned(spark, sf_dir))


@register(
    "w2_size_quartile_counts",
    stage_sql("SELECT SizeQuartile, count(*) AS rows, count(DISTINCT Store) AS stores FROM featured GROUP BY SizeQuartile"),
)
def w2_counts(spark, sf_dir):
    f = stages.featured(spark, sf_dir)
    return f.groupBy("SizeQuartile").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("Store").alias("stores"))


@register(
    "w3_sales_bucket_counts",
    stage_sql("SELECT SalesBucket, count(*) AS rows FROM eda GROUP BY SalesBucket"),
)
def w3_buckets(spark, sf_dir):
    """Right-closed fixed-bin labels of sales."""
    return stages.eda(spark, sf_dir).groupBy("SalesBucket").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "f16_min_max_normalise",
    stage_sql(
        "SELECT Date, "
        + ", ".join(
            f"CASE WHEN max({c}) OVER () - min({c}) OVER () > 0 THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0e0 END AS {c}_norm"
            for c in C.SERIES_COLUMNS
        )
        + " FROM merged"
    ),
    round_cols=[f"{c}_norm" for c in C.SERIES_COLUMNS],
)
def f16_norm(spark, sf_dir):
    """F16: min-max normalisation of the macro series (range 0 → 0.0)."""
    m = stages.merged(spark, sf_dir).select("Date", *C.SERIES_COLUMNS)
    return FE.min_max_normalise(m).select("Date", *[f"{c}_norm" for c in C.SERIES_COLUMNS])


@register(
    "p6_p8_model_frame",
    stage_sql("SELECT * EXCLUDE (Date, Weekly_Sales, Type) REPLACE (CAST(IsHoliday AS INTEGER) AS IsHoliday) FROM featured"),
    round_cols=[c for c in MERGED_DOUBLES + FEATURE_DOUBLES if c != "Weekly_Sales"],
)
def p6_p8(spark, sf_dir):
    """P6 bool→int, P7 drop encoded categorical, P8 drop leakage and string columns."""
    f = stages.featured(spark, sf_dir)
    return P.drop_leakage(P.drop_encoded_categoricals(P.bool_to_int(f)))


@register(
    "p12_selected_features",
    stage_sql("SELECT " + ", ".join(C.SELECTED_FEATURES) + ", Sales_Class FROM featured"),
    round_cols=["CPI", "Fuel_Price", "ConsumerConfRatio", "AvgMarkDownAmount", "Week_sin", "Week_cos"],
)
def p12_select(spark, sf_dir):
    """The 11 selected model features + target."""
    return P.select_features(stages.featured(spark, sf_dir))


@register(
    "p14_complete_cases",
    stage_sql("SELECT count(*) AS rows FROM merged WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in C.NUMERIC_COLUMNS)),
)
def p14_complete(spark, sf_dir):
    """Rows with every numeric column present."""
    return P.complete_cases(stages.merged(spark, sf_dir), C.NUMERIC_COLUMNS).agg(F.count(F.lit(1)).alias("rows"))


@register(
    "p10_p11_dashboard_filter",
    stage_sql(
        "SELECT count_if(Date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND Type IN ('A', 'B') AND IsHoliday) AS kept, "
        "count(*) AS total, "
        "CAST(ROUND(CAST(count_if(Date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND Type IN ('A', 'B') AND IsHoliday) * 100e0 / count(*) AS DECIMAL(38,12)), 1) AS DOUBLE) AS pct "
        "FROM eda"
    ),
)
def p10_p11(spark, sf_dir):
    """P10 dashboard predicate + P11 filtered share."""
    pred = P.dashboard_predicate(date_range=("1996-01-01", "1998-12-31"), types=["A", "B"], holiday="holiday")
    return P.filter_share(stages.eda(spark, sf_dir), pred)


@register(
    "p10_filtered_type_summary",
    stage_sql(
        "SELECT Type, count(DISTINCT Store) AS store_count, avg(Weekly_Sales) AS avg_sales, avg(Size) AS avg_size, "
        "avg(Sales_Class) AS high_pct, quantile_cont(Weekly_Sales, 0.5) AS median_sales FROM eda "
        "WHERE Date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND Store IN (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43) "
        "AND NOT IsHoliday GROUP BY Type"
    ),
    round_cols=["avg_sales", "avg_size", "high_pct", "median_sales"],
    digits=6,
)
def p10_filtered(spark, sf_dir):
    """P10 filter feeding an A11 breakdown (the dashboard's filtered view)."""
    from shelfspark.operators import aggregates as A

    df = P.filter_rows(
        stages.eda(spark, sf_dir),
        date_range=("1996-01-01", "1998-12-31"),
        stores=[2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43],
        holiday="non_holiday",
    )
    return A.store_type_breakdown(df, digits=None)
