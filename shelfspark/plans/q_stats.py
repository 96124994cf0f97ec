"""Queries of column profiles (D) and correlation / significance (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import correlation as CR
from shelfspark.operators import profile as D
from shelfspark.operators import quality as Q
from shelfspark.operators.common import numeric_columns
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.plans.oracle_sql import r
from shelfspark.session import cut_lineage

NUM = C.NUMERIC_COLUMNS


def _pct(cnt: str, tot: str, d: int = 3) -> str:
    return f"CASE WHEN {tot} > 0 THEN {r(f'({cnt}) * 100e0 / ({tot})', d)} ELSE 0e0 END"


def _skew(c: str) -> str:
    return f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE skewness({c}) END"


def _kurt(c: str) -> str:
    return f"CASE WHEN count({c}) < 4 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE kurtosis({c}) END"


def _profile_sql(table: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, {_pct(f'count(*) - count({c})', 'count(*)')} AS null_pct, "
            f"avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
            f"quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, {_skew(c)} AS skewness, {_kurt(c)} AS kurtosis, "
            f"CASE WHEN {_skew(c)} > 2 THEN 'heavily_right_skewed' WHEN {_skew(c)} > 1 THEN 'right_skewed' WHEN {_skew(c)} < -1 THEN 'left_skewed' "
            f"ELSE 'approximately_symmetric' END AS distribution_shape, "
            f"(SELECT count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) FROM {table} CROSS JOIN "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {table})) AS iqr_outlier_count "
            f"FROM {table} HAVING count({c}) > 0"
        )
    body = " UNION ALL ".join(parts)
    return f"SELECT *, {_pct('iqr_outlier_count', 'count')} AS iqr_outlier_pct FROM ({body})"


def eda_numeric(eda) -> list[str]:
    """The numeric columns of the EDA table by its schema, without target and ids; the oracle SQL spells them out."""
    cols = numeric_columns(eda, exclude=["Sales_Class", "Store", "Dept"])
    if sorted(cols) != sorted(C.EDA_NUMERIC_COLUMNS):
        raise AssertionError(f"numeric columns changed: {sorted(set(cols) ^ set(C.EDA_NUMERIC_COLUMNS))}")
    return cols


_PROFILE_DOUBLES = ["mean", "median", "std", "min", "max", "q1", "q3", "skewness", "kurtosis"]


@register("d1_d3_numeric_profile", stage_sql(_profile_sql("merged", NUM)), round_cols=_PROFILE_DOUBLES, digits=4)
def d1(spark, sf_dir):
    """D1 numeric profile with D2 corrected moments, D3 shape label, D5 exact quartiles."""
    return D.numeric_profile(stages.merged(spark, sf_dir), NUM)


@register(
    "d1_feature_statistics",
    stage_sql(_profile_sql("eda", C.EDA_NUMERIC_COLUMNS)),
    round_cols=_PROFILE_DOUBLES,
    digits=4,
)
def d1b(spark, sf_dir):
    """D1 on every numeric column of the EDA table (the dashboard's feature_statistics)."""
    eda = stages.eda(spark, sf_dir)
    columns = eda_numeric(eda)
    return D.numeric_profile(cut_lineage(eda.select(*columns), "eda-numeric"), columns)  # the profile reads them four times


def _cat_sql(col: str) -> str:
    return (
        "SELECT '" + col + "' AS \"column\", value, count, rank, unique_values, dominant_value_pct, "
        "CASE WHEN dominant_value_pct > 70 THEN 'highly_imbalanced' WHEN dominant_value_pct > 50 THEN 'imbalanced' ELSE 'balanced' END AS balance_flag "
        "FROM (SELECT value, count, row_number() OVER (ORDER BY count DESC, value ASC NULLS FIRST) AS rank, "
        "count(value) OVER () AS unique_values, "
        + _pct("max(count) OVER ()", "sum(count) OVER ()")
        + f" AS dominant_value_pct FROM (SELECT CAST({col} AS VARCHAR) AS value, count(*) AS count FROM eda GROUP BY 1)) WHERE rank <= 10"
    )


@register("d4_categorical_profile_type", stage_sql(_cat_sql("Type")))
def d4(spark, sf_dir):
    """Top values, distinct count, dominant pct, balance flag of Type."""
    return D.categorical_profile(stages.eda(spark, sf_dir), "Type")


@register("d4_categorical_profile_holiday_name", stage_sql(_cat_sql("HolidayName")))
def d4b(spark, sf_dir):
    return D.categorical_profile(stages.eda(spark, sf_dir), "HolidayName")


def _hist_sql(col: str, bins: int, by: str | None) -> str:
    keys = f"{by}, " if by else ""
    return (
        f"SELECT {keys}bin, lo + (bin - 1) * (hi - lo) / {bins} AS bin_start, lo + bin * (hi - lo) / {bins} AS bin_end, count(*) AS count FROM ("
        f"SELECT {keys}lo, hi, CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor(({col} - lo) / ((hi - lo) / {bins})) AS INTEGER) + 1, {bins}) END AS bin "
        f"FROM eda CROSS JOIN (SELECT min({col}) AS lo, max({col}) AS hi FROM eda) WHERE {col} IS NOT NULL) GROUP BY {keys}bin, lo, hi"
    )


@register("d6_sales_histogram_by_class", stage_sql(_hist_sql("Weekly_Sales", 30, "Sales_Class")), round_cols=["bin_start", "bin_end"], digits=4)
def d6(spark, sf_dir):
    """30 equal-width bins of sales per class (last bin closed)."""
    return D.histogram(stages.eda(spark, sf_dir), "Weekly_Sales", 30, by="Sales_Class")


@register(
    "d7_box_summary_by_type",
    stage_sql(
        "SELECT q.Type, q1, median, q3, min(CASE WHEN inside THEN Weekly_Sales END) AS whisker_low, "
        "max(CASE WHEN inside THEN Weekly_Sales END) AS whisker_high, count_if(NOT inside) AS outliers FROM "
        "(SELECT Type, quantile_cont(Weekly_Sales, 0.25) AS q1, quantile_cont(Weekly_Sales, 0.5) AS median, "
        "quantile_cont(Weekly_Sales, 0.75) AS q3 FROM eda WHERE Type IS NOT NULL GROUP BY Type) q "
        "JOIN (SELECT e.Type, e.Weekly_Sales, e.Weekly_Sales BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1) AS inside "
        "FROM eda e JOIN (SELECT Type, quantile_cont(Weekly_Sales, 0.25) AS q1, quantile_cont(Weekly_Sales, 0.75) AS q3 FROM eda GROUP BY Type) b "
        "ON e.Type = b.Type WHERE e.Weekly_Sales IS NOT NULL) x ON q.Type = x.Type GROUP BY q.Type, q1, median, q3"
    ),
    round_cols=["q1", "median", "q3", "whisker_low", "whisker_high"],
    digits=4,
)
def d7(spark, sf_dir):
    """Box-plot summary of sales per store type."""
    return D.box_summary(stages.eda(spark, sf_dir), "Weekly_Sales", "Type")


@register("d8_qq_points", None)
def d8(spark, sf_dir):
    """Normal Q–Q points of sales with the least-squares line (rows-only)."""
    return D.qq_points(stages.merged(spark, sf_dir), "Weekly_Sales")


@register(
    "d9_missing_summary",
    stage_sql(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS missing_count, "
            f"round(count_if({c} IS NULL) * 100e0 / count(*), 2) AS missing_pct FROM merged" for c in C.REQUIRED_COLUMNS
        ) + ") WHERE missing_count > 0"
    ),
    round_cols=["missing_pct"],
    digits=2,
)
def d9(spark, sf_dir):
    """NULL count and pct of every column with any NULL."""
    return D.missing_summary(stages.merged(spark, sf_dir))


@register(
    "d11_dataset_summary",
    stage_sql(
        "SELECT count(*) AS rows, 20 AS columns, min(Date) AS date_start, max(Date) AS date_end, count_if(Sales_Class = 1) AS high_count, "
        "count_if(Sales_Class = 0) AS low_count, round(greatest(count_if(Sales_Class = 1), count_if(Sales_Class = 0)) / "
        "least(count_if(Sales_Class = 1), count_if(Sales_Class = 0)), 4) AS balance_ratio FROM merged"
    ),
    round_cols=["balance_ratio"],
    digits=4,
)
def d11(spark, sf_dir):
    """Rows, columns, date range, class counts, balance ratio."""
    return D.dataset_summary(stages.merged(spark, sf_dir)).withColumn("columns", F.col("columns").cast("int"))


@register(
    "d12_head_rows",
    stage_sql("SELECT * FROM merged ORDER BY Store, Dept, Date, Weekly_Sales, Temperature, CPI LIMIT 5"),
    round_cols=["Weekly_Sales", "Temperature", "Fuel_Price", *C.MARKDOWN_COLUMNS, "CPI", "Unemployment", "UMCSENT", "RSXFS", "PCE"],
)
def d12(spark, sf_dir):
    """First 5 rows by an explicit key order."""
    return D.head(stages.merged(spark, sf_dir), ["Store", "Dept", "Date", "Weekly_Sales", "Temperature", "CPI"])


@register(
    "d13_mode_and_medians",
    stage_sql(
        "SELECT (SELECT Type FROM merged WHERE Type IS NOT NULL GROUP BY Type ORDER BY count(*) DESC, Type LIMIT 1) AS mode_type, "
        "(SELECT Dept FROM merged GROUP BY Dept ORDER BY count(*) DESC, Dept LIMIT 1) AS mode_dept, "
        "quantile_cont(CASE WHEN Sales_Class = 1 THEN Weekly_Sales END, 0.5) AS median_high, "
        "quantile_cont(CASE WHEN Sales_Class = 0 THEN Weekly_Sales END, 0.5) AS median_low FROM merged"
    ),
    round_cols=["median_high", "median_low"],
    digits=4,
)
def d13(spark, sf_dir):
    """Mode with smallest-value tie-break and class-conditional medians."""
    from shelfspark.operators.aggregates import group_medians
    from shelfspark.operators.common import one_row_concat

    m = stages.merged(spark, sf_dir)
    med = group_medians(m, "Weekly_Sales", ["Sales_Class"]).agg(
        F.max(F.when(F.col("Sales_Class") == 1, F.col("median"))).alias("median_high"),
        F.max(F.when(F.col("Sales_Class") == 0, F.col("median"))).alias("median_low"),
    )
    mt = Q.mode_value(m, "Type").withColumnRenamed("mode", "mode_type")
    md = Q.mode_value(m, "Dept").select(F.col("mode").cast("int").alias("mode_dept"))
    return one_row_concat(mt, md, med)


@register(
    "d14_completeness_before_after",
    stage_sql(
        "SELECT 'merged' AS stage, count(*) AS rows, 20 AS columns, "
        + " + ".join(f"count_if({c} IS NULL)" for c in C.REQUIRED_COLUMNS)
        + " AS null_cells FROM merged UNION ALL SELECT 'cleaned', count(*), 26, "
        + " + ".join(f"count_if({c} IS NULL)" for c in C.REQUIRED_COLUMNS)
        + " FROM cleaned"
    ),
)
def d14(spark, sf_dir):
    """Null cells before and after cleaning."""
    from shelfspark.operators import cleaning as P

    m = stages.merged(spark, sf_dir)
    before = D.completeness_summary(m).select(F.lit("merged").alias("stage"), "rows", F.col("columns").cast("int"), "null_cells")
    after = D.completeness_summary(P.clean(m)[0]).select(F.lit("cleaned").alias("stage"), "rows", F.col("columns").cast("int"), "null_cells")
    return before.unionByName(after)


_D16 = ["Store", "Dept", "Sales_Class", *C.EDA_NUMERIC_COLUMNS]


@register(
    "d16_binary_columns",
    stage_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", COALESCE(bool_and({c} IS NOT NULL AND {c} IN (0, 1)), TRUE) AS is_binary FROM featured" for c in _D16
        )
    ),
)
def d16(spark, sf_dir):
    """Binary (values ⊆ {0, 1}) vs continuous classification of every numeric feature."""
    return D.binary_columns(stages.featured(spark, sf_dir))


@register(
    "d17_tail_ratio",
    stage_sql(
        "SELECT \"column\", CASE WHEN q3 <> 0 THEN max / q3 END AS tail_ratio, (CASE WHEN q3 <> 0 THEN max / q3 END) > 10 AS heavy_tail FROM ("
        + _profile_sql("merged", NUM)
        + ")"
    ),
    round_cols=["tail_ratio"],
    digits=4,
)
def d17(spark, sf_dir):
    """Max / q75 tail ratio, flagged above 10."""
    return D.tail_ratio(D.numeric_profile(stages.merged(spark, sf_dir), NUM))


@register(
    "d18_scaled_statistics",
    stage_sql(
        "SELECT \"column\", "
        + ", ".join(f"CASE WHEN max - min <> 0 THEN ({s} - min) / (max - min) ELSE 0e0 END AS {s}" for s in ["min", "q1", "median", "mean", "q3", "max"])
        + " FROM (" + _profile_sql("merged", NUM) + ")"
    ),
    round_cols=["min", "q1", "median", "mean", "q3", "max"],
    digits=4,
)
def d18(spark, sf_dir):
    """Statistics matrix scaled 0–1 within each column."""
    return D.scaled_statistics(D.numeric_profile(stages.merged(spark, sf_dir), NUM))


# --- correlation -------------------------------------------------------------------------------
_CORR_COLS = NUM


@register(
    "c1_c3_correlation_matrix",
    stage_sql(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM merged" for a in _CORR_COLS for b in _CORR_COLS)),
    round_cols=["r"],
    digits=6,
)
def c3(spark, sf_dir):
    """Pearson matrix with pairwise deletion, all pairs in one aggregate."""
    return CR.correlation_matrix(stages.merged(spark, sf_dir), _CORR_COLS)


@register(
    "c3_correlation_matrix_complete_cases",
    stage_sql(
        " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM cc" for a in _CORR_COLS for b in _CORR_COLS),
        "cc AS (SELECT * FROM merged WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _CORR_COLS) + ")",
    ),
    round_cols=["r"],
    digits=6,
)
def c3b(spark, sf_dir):
    """Pearson matrix on complete cases (the validation variant)."""
    return CR.correlation_matrix(stages.merged(spark, sf_dir), _CORR_COLS, complete_cases=True)


_EDA_NUM = C.EDA_NUMERIC_COLUMNS
_TARGET_CORR = "SELECT feature, r FROM (UNPIVOT (SELECT " + ", ".join(f"corr({c}, Sales_Class) AS {c}" for c in _EDA_NUM) + " FROM eda) ON COLUMNS(*) INTO NAME feature VALUE r)"


@register(
    "c4_target_correlations",
    stage_sql(_TARGET_CORR),
    round_cols=["r"],
    digits=6,
)
def c4(spark, sf_dir):
    """C4: correlation of each feature with the target."""
    eda = stages.eda(spark, sf_dir)
    return CR.target_correlations(eda, eda_numeric(eda))


@register(
    "c4_top5_by_sign",
    stage_sql(
        "SELECT * FROM (SELECT feature, r, 'positive' AS side FROM t WHERE r > 0 ORDER BY r DESC, feature LIMIT 5) "
        "UNION ALL SELECT * FROM (SELECT feature, r, 'negative' AS side FROM t WHERE r < 0 ORDER BY r ASC, feature LIMIT 5)",
        f"t AS ({_TARGET_CORR})",
    ),
    round_cols=["r"],
    digits=6,
)
def c4b(spark, sf_dir):
    """C4: top-5 positive and negative target correlations."""
    eda = stages.eda(spark, sf_dir)
    return CR.top_by_sign(CR.target_correlations(eda, eda_numeric(eda)), 5)


_PAIRS = [(a, b) if a < b else (b, a) for i, a in enumerate(_EDA_NUM) for b in _EDA_NUM[i + 1 :]]


@register(
    "c6_top_collinear_pairs",
    stage_sql(
        "SELECT split_part(pair, '|', 1) AS a, split_part(pair, '|', 2) AS b, r FROM (UNPIVOT (SELECT "
        + ", ".join(f'corr({a}, {b}) AS "{a}|{b}"' for a, b in _PAIRS)
        + " FROM eda) ON COLUMNS(*) INTO NAME pair VALUE r) WHERE NOT isnan(r) AND abs(r) > 0.7 ORDER BY round(abs(r), 9) DESC, a, b LIMIT 15"
    ),
    round_cols=["r"],
    digits=6,
)
def c6(spark, sf_dir):
    """Top-15 pairs with |r| > 0.7 (upper triangle) over every numeric column."""
    eda = stages.eda(spark, sf_dir)
    return CR.top_collinear_pairs(CR.correlation_matrix(eda, eda_numeric(eda)))


@register(
    "c7_point_biserial",
    stage_sql(
        "SELECT feature, n, abs(r) AS correlation, CASE WHEN r > 0 THEN '+' ELSE '-' END AS direction, r FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count_if({c} IS NOT NULL AND Sales_Class IS NOT NULL) AS n, corr(Sales_Class, {c}) AS r FROM eda" for c in _EDA_NUM
        )
        + ") WHERE n >= 100"
    ),
    round_cols=["correlation", "r"],
    digits=6,
)
def c7(spark, sf_dir):
    """Point-biserial r per feature (n ≥ 100), |r| and direction (p-values: c5 query)."""
    eda = stages.eda(spark, sf_dir)
    return CR.point_biserial(eda, eda_numeric(eda), top=None).drop("p_value")


@register("c5_c7_point_biserial_pvalues", None)
def c5(spark, sf_dir):
    """Two-sided p-values of the point-biserial r (Student t on aggregated rows; values in unit tests)."""
    eda = stages.eda(spark, sf_dir)
    return CR.point_biserial(eda, eda_numeric(eda), top=25)


def _moments_sql(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(CASE WHEN Sales_Class = 0 THEN {c} END) AS n0, avg(CASE WHEN Sales_Class = 0 THEN {c} END) AS m0, "
        f"var_samp(CASE WHEN Sales_Class = 0 THEN {c} END) AS v0, count(CASE WHEN Sales_Class = 1 THEN {c} END) AS n1, "
        f"avg(CASE WHEN Sales_Class = 1 THEN {c} END) AS m1, var_samp(CASE WHEN Sales_Class = 1 THEN {c} END) AS v1 FROM eda"
        for c in cols
    )


_TT = _EDA_NUM


@register(
    "c8_welch_t_statistics",
    stage_sql(
        "SELECT feature, CASE WHEN se2 > 0 THEN (m0 - m1) / sqrt(se2) END AS t_stat, "
        "CASE WHEN se2 > 0 THEN se2 * se2 / (pow(v0 / n0, 2) / (n0 - 1) + pow(v1 / n1, 2) / (n1 - 1)) END AS dof FROM "
        "(SELECT *, v0 / n0 + v1 / n1 AS se2 FROM (" + _moments_sql(_TT) + ")) WHERE n0 >= 30 AND n1 >= 30"
    ),
    round_cols=["t_stat", "dof"],
    digits=4,
)
def c8(spark, sf_dir):
    """Welch t statistic and Welch–Satterthwaite df per feature (p-values: c10 query)."""
    eda = stages.eda(spark, sf_dir)
    return CR.welch_t_test(eda, eda_numeric(eda), top=None).select("feature", "t_stat", "dof")


@register(
    "c9_cohens_d",
    stage_sql(
        "SELECT feature, cohens_d FROM (SELECT feature, abs((m1 - m0) / sqrt((v0 + v1) / 2)) AS cohens_d, sqrt((v0 + v1) / 2) AS pooled FROM ("
        + _moments_sql(_TT) + ") WHERE n0 >= 30 AND n1 >= 30) WHERE pooled > 0 ORDER BY cohens_d DESC, feature LIMIT 25"
    ),
    round_cols=["cohens_d"],
    digits=6,
)
def c9(spark, sf_dir):
    """Top-25 |Cohen's d| (pooled std of the two class variances)."""
    eda = stages.eda(spark, sf_dir)
    return CR.cohens_d(eda, eda_numeric(eda))


@register("c10_significance_summary", None)
def c10(spark, sf_dir):
    """Welch p-values, significant count and tested count (rows-only)."""
    eda = stages.eda(spark, sf_dir)
    return CR.significance_summary(eda, eda_numeric(eda))


@register("c8_welch_pvalues_top25", None)
def c8b(spark, sf_dir):
    eda = stages.eda(spark, sf_dir)
    return CR.welch_t_test(eda, eda_numeric(eda), top=25)


_SPEAR = [("Size", "Weekly_Sales"), ("Temperature", "Weekly_Sales"), ("Fuel_Price", "CPI"), ("MarkDown1", "MarkDown3")]


def _spearman_sql() -> str:
    parts = []
    for a, b in _SPEAR:
        def rk(c):
            return f"((rank() OVER (ORDER BY {c})) + (count(*) OVER () - rank() OVER (ORDER BY {c} DESC) + 1)) / 2e0"
        parts.append(
            f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, corr(x, y) AS pearson_r, corr(rx, ry) AS spearman_r FROM "
            f"(SELECT {a} AS x, {b} AS y, {rk(a)} AS rx, {rk(b)} AS ry FROM merged WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        )
    return stage_sql(" UNION ALL ".join(parts))


@register("c2_spearman_pairs", _spearman_sql(), round_cols=["pearson_r", "spearman_r"], digits=6)
def c2(spark, sf_dir):
    """Spearman ρ (average ranks for ties) with Pearson r per pair, pairwise complete rows."""
    m = stages.merged(spark, sf_dir)
    out = None
    for a, b in _SPEAR:
        part = CR.pair_correlations(m.select(a, b).na.drop(how="any"), [(a, b)], spearman=True)
        out = part if out is None else out.unionByName(part)
    return out

