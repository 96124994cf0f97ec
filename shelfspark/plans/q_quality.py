"""Queries of the validation stage (Q1–Q29) with DuckDB oracles generated check by check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import quality as Q
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.plans.oracle_sql import r


def _pct(cnt: str, tot: str, d: int = 3) -> str:
    return f"CASE WHEN {tot} > 0 THEN {r(f'({cnt}) * 100e0 / ({tot})', d)} ELSE 0e0 END"


def _pf(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'PASS' ELSE 'FAIL' END"


def _row(dim: str, check: str, column: str | None, status: str, metric: str, value: str | None = None, text: str | None = None, src: str = "w") -> str:
    col = f"'{column}'" if column is not None else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{dim}' AS dimension, '{check}' AS \"check\", {col} AS \"column\", {status} AS status, '{metric}' AS metric, "
        f"CAST({value if value is not None else 'NULL'} AS DOUBLE) AS value, CAST({text if text is not None else 'NULL'} AS VARCHAR) AS text FROM {src}"
    )


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


def _sorted_set(expr: str, cond: str, limit: int | None = None) -> str:
    lst = f"list_sort(list_distinct(list({expr}) FILTER (WHERE {cond})))"
    if limit:
        lst = f"list_slice({lst}, 1, {limit})"
    return f"COALESCE(array_to_string({lst}, ','), '')"


# --- accuracy ---------------------------------------------------------------------------
def _accuracy_sql() -> str:
    D = "Accuracy"
    aggs = ["count(*) AS _n"]
    for c, (lo, hi) in C.VALUE_RANGES.items():
        aggs += [f"count({c}) AS {c}__nn", f"count_if({c} < {lo} OR {c} > {hi}) AS {c}__viol"]
    bad = "trim(Type) IS NOT NULL AND trim(Type) NOT IN ('A', 'B', 'C')"
    aggs += [f"count_if({bad}) AS Type__viol", f"{_sorted_set('trim(Type)', bad, 10)} AS Type__sample"]
    lo, hi = C.DATE_RANGE
    aggs += [
        f"count_if(Date < DATE '{lo}' OR Date > DATE '{hi}') AS Date__out",
        "count_if(Date > current_date) AS Date__future",
        "CAST(min(Date) AS VARCHAR) AS Date__min",
        "CAST(max(Date) AS VARCHAR) AS Date__max",
        "count_if(Sales_Class IS NULL) AS T__nulls",
        f"{_sorted_set('CAST(Sales_Class AS VARCHAR)', 'Sales_Class NOT IN (0, 1)')} AS T__invalid",
        "count_if(Weekly_Sales < 0) AS WS__neg",
        "min(Weekly_Sales) AS WS__min",
    ]
    rows = []
    for c, (lo_, hi_) in C.VALUE_RANGES.items():
        name = f"{c} in [{lo_}, {hi_}]"
        p = _pct(f"{c}__viol", f"{c}__nn")
        st = _pf(f"{p} <= 1.0")
        rows += [_row(D, name, c, st, "violations", f"{c}__viol"), _row(D, name, c, st, "violation_pct", p)]
    rows.append(_row(D, "Type in {A, B, C}", "Type", _pf("Type__viol = 0"), "violations", "Type__viol", "Type__sample"))
    rows.append(_row(D, "IsHoliday in {True, False}", "IsHoliday", "'PASS'", "violations", "0"))
    name = f"Date within [{lo}, {hi}]"
    st = _pf("Date__out = 0 AND Date__future = 0")
    rows += [_row(D, name, "Date", st, "out_of_range_rows", "Date__out", "Date__min"), _row(D, name, "Date", st, "future_date_rows", "Date__future", "Date__max")]
    rows.append(_row(D, "Sales_Class values in {0, 1}", "Sales_Class", _pf("T__nulls = 0 AND T__invalid = ''"), "null_count", "T__nulls", "T__invalid"))
    st = "CASE WHEN WS__neg > 0 THEN 'WARN' ELSE 'PASS' END"
    name = "Negative Weekly_Sales inspection"
    rows += [
        _row(D, name, "Weekly_Sales", st, "negative_rows", "WS__neg"),
        _row(D, name, "Weekly_Sales", st, "pct_negative", _pct("WS__neg", "_n")),
        _row(D, name, "Weekly_Sales", st, "min_value", "WS__min"),
    ]
    return stage_sql(_union(rows), f"w AS (SELECT {', '.join(aggs)} FROM merged)")


def _today() -> dt.date:
    return dt.date.today()


@register("q1_q6_accuracy_checks", _accuracy_sql(), round_cols=["value"], digits=6)
def q_accuracy(spark, sf_dir):
    """Q1 ranges, Q2 set membership, Q3 boolean domain, Q4 date range, Q5 target, Q6 negatives."""
    return Q.check_accuracy(stages.merged(spark, sf_dir), today=_today())


# --- completeness --------------------------------------------------------------------------
def _completeness_sql() -> str:
    D = "Completeness"
    cols = C.REQUIRED_COLUMNS
    miss = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
    aggs = [
        "count(*) AS _n",
        "count_if(_miss > 0) AS _rows_any",
        "max(_miss) AS _max_miss",
        f"count_if(_miss * 100e0 / {len(cols)} >= {C.SEVERE_ROW_MISSING_PCT}) AS _severe_rows",
        "quantile_cont(_miss, 0.95) AS p95",
    ] + [f"count_if({c} IS NULL) AS {c}__nulls" for c in cols]
    for c in C.SERIES_COLUMNS:
        aggs += [f"min({c}) AS {c}__min", f"max({c}) AS {c}__max"]
    rows = [
        _row(D, f"Minimum row count >= {C.MIN_ROWS}", None, _pf(f"_n >= {C.MIN_ROWS}"), "actual_rows", "_n"),
        _row(D, "All required columns present", None, "'PASS'", "missing_columns", "0", "''"),
        _row(D, "All required columns present", None, "'PASS'", "extra_columns", "0", "''"),
    ]
    for c in cols:
        mx = float(C.NULL_THRESHOLDS_PCT.get(c, C.DEFAULT_NULL_THRESHOLD_PCT))
        crit = "critical" if mx == 0.0 else "high" if mx <= 5.0 else "medium"
        p = _pct(f"{c}__nulls", "_n")
        st = _pf(f"{p} <= {mx}")
        name = f"{c} null <= {mx}%"
        rows += [_row(D, name, c, st, "null_count", f"{c}__nulls", f"'{crit}'"), _row(D, name, c, st, "null_pct", p, f"'{crit}'")]
    st = "CASE WHEN _rows_any > 0 THEN 'WARN' ELSE 'PASS' END"
    name = "Row-level missingness profile"
    nulls = " + ".join(f"{c}__nulls" for c in cols)
    rows += [
        _row(D, name, None, st, "rows_with_missing", "_rows_any"),
        _row(D, name, None, st, "rows_with_missing_pct", _pct("_rows_any", "_n")),
        _row(D, name, None, st, "max_missing_cells_in_row", "_max_miss"),
        _row(D, name, None, st, "p95_missing_cells_in_row", "p95"),
        _row(D, name, None, st, "overall_completeness_pct", f"CASE WHEN _n > 0 THEN {r(f'100 * (1 - ({nulls}) / (_n * {len(cols)}e0))', 2)} ELSE 100e0 END"),
    ]
    colpct = {c: f"CASE WHEN _n > 0 THEN {r(f'{c}__nulls * 100e0 / _n', 2)} ELSE 0e0 END" for c in cols}
    sev_n = " + ".join(f"CAST({colpct[c]} >= {C.SEVERE_COLUMN_MISSING_PCT} AS INTEGER)" for c in cols)
    sev_names = "concat_ws(',', " + ", ".join(f"CASE WHEN {colpct[c]} >= {C.SEVERE_COLUMN_MISSING_PCT} THEN '{c}' END" for c in cols) + ")"
    st = f"CASE WHEN ({sev_n}) = 0 AND _severe_rows = 0 THEN 'PASS' ELSE 'WARN' END"
    name = f"No columns >= {C.SEVERE_COLUMN_MISSING_PCT}% missing & no rows >= {C.SEVERE_ROW_MISSING_PCT}% missing"
    rows += [_row(D, name, None, st, "severe_columns", sev_n, sev_names), _row(D, name, None, st, "severe_row_count", "_severe_rows"), _row(D, name, None, st, "severe_row_pct", _pct("_severe_rows", "_n"))]
    ok = " AND ".join(f"{colpct[c]} < 5" for c in C.SERIES_COLUMNS)
    for c in C.SERIES_COLUMNS:
        for metric, v in (("null_pct", colpct[c]), ("min", f"{c}__min"), ("max", f"{c}__max")):
            rows.append(_row(D, "Macro series fully populated", c, _pf(ok), metric, v))
    return stage_sql(_union(rows), f"w AS (SELECT {', '.join(aggs)} FROM (SELECT *, {miss} AS _miss FROM merged))")


@register("q7_q12_completeness_checks", _completeness_sql(), round_cols=["value"], digits=6)
def q_completeness(spark, sf_dir):
    """Q7 row count, Q8 schema, Q9 null thresholds, Q10 row missingness, Q11 severe, Q12 series."""
    return Q.check_completeness(stages.merged(spark, sf_dir))


# --- consistency --------------------------------------------------------------------------
_MERGED_TYPES = {
    "Store": "int", "Dept": "int", "Date": "date", "Weekly_Sales": "double", "IsHoliday": "boolean", "Type": "string",
    "Size": "int", "Temperature": "double", "Fuel_Price": "double", "MarkDown1": "double", "MarkDown2": "double",
    "MarkDown3": "double", "MarkDown4": "double", "MarkDown5": "double", "CPI": "double", "Unemployment": "double",
    "UMCSENT": "double", "RSXFS": "double", "PCE": "double", "Sales_Class": "int",
}


def _consistency_sql() -> str:
    D = "Consistency"
    slo, shi = C.STORE_ID_RANGE
    dlo, dhi = C.DEPT_ID_RANGE
    sbad = f"Store IS NOT NULL AND NOT (Store BETWEEN {slo} AND {shi})"
    dbad = f"Dept IS NOT NULL AND NOT (Dept BETWEEN {dlo} AND {dhi})"
    sub = "Weekly_Sales IS NOT NULL AND Size IS NOT NULL AND Size > 0"
    aggs = [
        "count(DISTINCT Store) AS S__uniq",
        f"count(DISTINCT CASE WHEN {sbad} THEN Store END) AS S__bad",
        f"{_sorted_set('CAST(Store AS BIGINT)', sbad, 20)} AS S__sample",
        "count(DISTINCT Dept) AS D__uniq",
        f"count(DISTINCT CASE WHEN {dbad} THEN Dept END) AS D__bad",
        f"count_if({sub}) AS R__n",
        f"count_if({sub} AND abs(Weekly_Sales / Size) > {C.SALES_PER_SIZE_LIMIT}) AS R__viol",
        f"count_if(month(Date) IN (6, 7, 8) AND Temperature < 0) AS T__viol",
    ]
    fam_ok = {"integer": ("int",), "numeric": ("int", "double"), "datetime": ("date",), "bool": ("boolean",), "string": ("string",)}
    rows = []
    for c, fam in C.DTYPE_EXPECTATIONS.items():
        t = _MERGED_TYPES[c]
        st = "'PASS'" if t in fam_ok[fam] else "'FAIL'"
        rows.append(_row(D, f"{c} dtype is {fam}", c, st, "dtype", None, f"'{t}'"))
    name = f"Store IDs in [{slo}, {shi}]"
    rows += [_row(D, name, "Store", _pf("S__bad = 0"), "unique_stores", "S__uniq", "S__sample"), _row(D, name, "Store", _pf("S__bad = 0"), "invalid_count", "S__bad")]
    name = f"Dept IDs in [{dlo}, {dhi}]"
    rows += [_row(D, name, "Dept", _pf("D__bad = 0"), "unique_depts", "D__uniq"), _row(D, name, "Dept", _pf("D__bad = 0"), "invalid_dept_count", "D__bad")]
    p = _pct("R__viol", "R__n")
    name = f"|Weekly_Sales / Size| <= {C.SALES_PER_SIZE_LIMIT}"
    rows += [_row(D, name, None, _pf(f"{p} <= {C.SALES_PER_SIZE_MAX_PCT}"), "violations", "R__viol"), _row(D, name, None, _pf(f"{p} <= {C.SALES_PER_SIZE_MAX_PCT}"), "violation_pct", p)]
    rows.append(_row(D, "No sub-zero temperatures in Jun-Aug", "Temperature", _pf("T__viol = 0"), "violations", "T__viol"))
    rows.append(_row(D, "IsHoliday contains only boolean values", "IsHoliday", "'PASS'", "violations", "0"))
    return stage_sql(_union(rows), f"w AS (SELECT {', '.join(aggs)} FROM merged)")


@register("q13_q17_consistency_checks", _consistency_sql(), round_cols=["value"], digits=6)
def q_consistency(spark, sf_dir):
    """Q13 dtype families, Q14 id domains, Q15 sales per size, Q16 summer temperature, Q17 flag domain."""
    return Q.check_consistency(stages.merged(spark, sf_dir))


# --- uniqueness ----------------------------------------------------------------------------
def _uniqueness_sql() -> str:
    D = "Uniqueness"
    allc = ", ".join(C.REQUIRED_COLUMNS)
    ctes = (
        "w AS (SELECT (SELECT count(*) FROM merged) AS _n, "
        f"(SELECT COALESCE(sum(cnt - 1), 0) FROM (SELECT {allc}, count(*) AS cnt FROM merged GROUP BY ALL)) AS _full, "
        "(SELECT COALESCE(sum(cnt - 1), 0) FROM (SELECT Store, Dept, Date, count(*) AS cnt FROM merged GROUP BY ALL)) AS _key, "
        "(SELECT COALESCE(sum(cnt - 1), 0) FROM (SELECT Store, Dept, Date, Weekly_Sales, count(*) AS cnt FROM merged GROUP BY ALL)) AS _fp)"
    )
    rows = [
        _row(D, "No exact full-row duplicates", None, _pf("_full = 0"), "duplicate_count", "_full"),
        _row(D, "No exact full-row duplicates", None, _pf("_full = 0"), "duplicate_pct", _pct("_full", "_n")),
    ]
    name = "Unique business key (Store + Dept + Date)"
    rows += [_row(D, name, None, _pf("_key = 0"), "duplicate_count", "_key"), _row(D, name, None, _pf("_key = 0"), "duplicate_pct", _pct("_key", "_n"))]
    p = _pct("_fp", "_n")
    name = "Unique fingerprint (Store + Dept + Date + Weekly_Sales)"
    rows += [_row(D, name, None, _pf(f"{p} <= {C.FINGERPRINT_MAX_PCT}"), "duplicate_count", "_fp"), _row(D, name, None, _pf(f"{p} <= {C.FINGERPRINT_MAX_PCT}"), "duplicate_pct", p)]
    return stage_sql(_union(rows), ctes)


@register("q18_q20_uniqueness_checks", _uniqueness_sql(), round_cols=["value"], digits=6)
def q_uniqueness(spark, sf_dir):
    """Q18 full-row, Q19 business-key and Q20 fingerprint duplicates."""
    return Q.check_uniqueness(stages.merged(spark, sf_dir))


# --- outliers ---------------------------------------------------------------------------------
def _skew(c: str) -> str:
    return f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) = 0 THEN 0 ELSE skewness({c}) END"


def _outlier_sql() -> str:
    D = "Outlier Detection"
    parts = []
    for c in C.OUTLIER_COLUMNS:
        k = C.IQR_MULTIPLIER
        st = (
            f"CASE WHEN (CASE WHEN abs(sk) > 1 THEN (ip <= {C.OUTLIER_THRESHOLD_PCT} OR zp <= {C.OUTLIER_THRESHOLD_PCT}) "
            f"ELSE (ip <= {C.OUTLIER_THRESHOLD_PCT} AND zp <= {C.OUTLIER_THRESHOLD_PCT}) END) THEN 'PASS' ELSE 'FAIL' END"
        )
        inner = (
            f"SELECT n, sk, lb, ub, ic, zc, {_pct('ic', 'n')} AS ip, {_pct('zc', 'n')} AS zp FROM ("
            f"SELECT count({c}) AS n, {_skew(c)} AS sk, max(lb) AS lb, max(ub) AS ub, "
            f"count_if({c} < lb OR {c} > ub) AS ic, "
            f"count_if(sd > 0 AND abs({c} - mu) / sd > {C.ZSCORE_THRESHOLD}) AS zc FROM merged CROSS JOIN ("
            f"SELECT q1 - {k} * (q3 - q1) AS lb, q3 + {k} * (q3 - q1) AS ub, mu, sd FROM ("
            f"SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS mu, stddev_pop({c}) AS sd FROM merged)))"
        )
        for metric, v in (("iqr_count", "ic"), ("iqr_pct", "ip"), ("z_count", "zc"), ("z_pct", "zp"), ("skewness", "sk"), ("lower_fence", "lb"), ("upper_fence", "ub")):
            method = {"iqr_count": "ip", "z_count": "zp"}.get(metric)
            text = f"CASE WHEN {method} <= {C.OUTLIER_THRESHOLD_PCT} THEN 'PASS' ELSE 'FAIL' END" if method else None
            parts.append(_row(D, f"Outliers in {c}", c, st, metric, v, text, src=f"({inner}) WHERE n > 0"))
    return stage_sql(_union(parts))


@register("q21_q23_outlier_checks", _outlier_sql(), round_cols=["value"], digits=6)
def q_outliers(spark, sf_dir):
    """Q21 IQR fences, Q22 z-scores (population std), Q23 skew-aware verdict."""
    return Q.check_outliers(stages.merged(spark, sf_dir))


# --- distribution sanity ------------------------------------------------------------------------
def _distribution_sql() -> str:
    D = "Distribution Profile"
    ctes = (
        "w AS (SELECT quantile_cont(Weekly_Sales, 0.5) AS ws, quantile_cont(Temperature, 0.5) AS te, quantile_cont(Unemployment, 0.5) AS un, "
        "(SELECT count(*) FROM (SELECT DISTINCT Sales_Class FROM merged)) AS _classes, "
        "(SELECT max(c) FROM (SELECT count(*) AS c FROM merged GROUP BY Sales_Class)) AS _cmax, "
        "(SELECT min(c) FROM (SELECT count(*) AS c FROM merged GROUP BY Sales_Class)) AS _cmin, "
        "(SELECT Type FROM merged WHERE Type IS NOT NULL GROUP BY Type ORDER BY count(*) DESC, Type LIMIT 1) AS mode FROM merged)"
    )
    rows = []
    for v, c, (lo, hi), label in (
        ("ws", "Weekly_Sales", C.SALES_MEDIAN_RANGE, "Median Weekly_Sales in"),
        ("te", "Temperature", C.TEMPERATURE_MEDIAN_RANGE, "Median Temperature in"),
        ("un", "Unemployment", C.UNEMPLOYMENT_MEDIAN_RANGE, "Median Unemployment in"),
    ):
        rows.append(_row(D, f"{label} [{lo}, {hi}]", c, _pf(f"{v} >= {lo} AND {v} <= {hi}"), "median", r(v, 2)))
    ratio = r("_cmax / _cmin", 3)
    rows.append(_row(D, "Class imbalance ratio < 2.0", "Sales_Class", _pf(f"{ratio} < {C.MAX_IMBALANCE}"), "imbalance_ratio", ratio, None, src="w WHERE _classes >= 2"))
    rows.append(_row(D, "Most common store Type is A", "Type", _pf("mode = 'A'"), "mode", None, "mode"))
    return stage_sql(_union(rows), ctes)


@register("q24_distribution_checks", _distribution_sql(), round_cols=["value"], digits=6)
def q_distribution(spark, sf_dir):
    """Q24: median ranges, class imbalance, most common store type (D13 mode)."""
    return Q.check_distribution(stages.merged(spark, sf_dir))


# --- relationships -------------------------------------------------------------------------------
def _avg_rank(c: str) -> str:
    return f"((rank() OVER (ORDER BY {c})) + (count(*) OVER () - rank() OVER (ORDER BY {c} DESC) + 1)) / 2e0"


def _relationships_sql() -> str:
    D = "Relationships"
    cols = C.NUMERIC_COLUMNS
    cc = "cc AS (SELECT " + ", ".join(cols) + " FROM merged WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")"
    used = sorted({c for p in C.EXPECTED_POSITIVE + C.EXPECTED_NEGATIVE for c in p})
    rk = "rk AS (SELECT *, " + ", ".join(f"{_avg_rank(c)} AS rk_{c}" for c in used) + " FROM cc)"
    rows = []
    for (a, b), exp in [(p, "positive") for p in C.EXPECTED_POSITIVE] + [(p, "negative") for p in C.EXPECTED_NEGATIVE]:
        cond = "pr > 0" if exp == "positive" else "pr < 0"
        st = f"CASE WHEN n = 0 THEN 'SKIP' WHEN {cond} THEN 'PASS' ELSE 'FAIL' END"
        strength = "CASE WHEN abs(pr) > 0.6 THEN 'strong' WHEN abs(pr) > 0.3 THEN 'moderate' ELSE 'weak' END"
        src = f"(SELECT count(*) AS n, corr({a}, {b}) AS pr, corr(rk_{a}, rk_{b}) AS sr FROM rk)"
        name = f"{a} vs {b} ({exp})"
        rows += [
            _row(D, name, f"{a},{b}", st, "pearson_r", "pr", strength, src=src),
            _row(D, name, f"{a},{b}", st, "spearman_r", "sr", None, src=src),
            _row(D, name, f"{a},{b}", st, "n", "n", None, src=src),
        ]
    return stage_sql(_union(rows), cc + ",\n" + rk)


@register("q25_relationship_checks", _relationships_sql(), round_cols=["value"], digits=6)
def q_relationships(spark, sf_dir):
    """Q25: expected correlation signs on complete cases (Pearson and Spearman; their p-values: the next query)."""
    return Q.check_relationships(stages.merged(spark, sf_dir)).where(~F.col("metric").endswith("_p"))


@register("q25_relationship_pvalues", None)
def q_relationship_p(spark, sf_dir):
    """Q25: p-values and significance of the expected pairs (Student t on aggregated rows; values in unit tests)."""
    return Q.check_relationships(stages.merged(spark, sf_dir)).where(F.col("metric").endswith("_p"))


def _sales_corr_sql() -> str:
    cols = C.NUMERIC_COLUMNS
    cc = "cc AS (SELECT " + ", ".join(cols) + " FROM merged WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")"
    strength = "CASE WHEN abs(r) > 0.6 THEN 'strong' WHEN abs(r) > 0.3 THEN 'moderate' ELSE 'weak' END"
    body = " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n, corr({c}, Weekly_Sales) AS r FROM cc" for c in cols if c != "Weekly_Sales")
    return stage_sql(f"SELECT feature, n, r, {strength} AS strength FROM ({body})", cc)


@register("q25_sales_correlations", _sales_corr_sql(), round_cols=["r"], digits=6)
def q_sales_corr(spark, sf_dir):
    """Q25: r of every numeric column with the sales on complete cases."""
    return Q.sales_correlations(stages.merged(spark, sf_dir)).select("feature", "n", "r", "strength")


# --- stage checks ----------------------------------------------------------------------------------
def _stage_rows(D: str, nulls_name: str) -> list[str]:
    null = "CASE WHEN nulls = 0 THEN 'PASS' ELSE 'WARN' END"
    return [
        _row(D, nulls_name, None, null, "null_cells", "nulls"),
        _row(D, nulls_name, None, null, "columns_with_nulls", "null_columns"),
        _row(D, "No infinite values", None, "'PASS'", "infinite_cells", "0"),
        _row(D, "Row count preserved", None, _pf("n = n_before"), "rows", "n"),
    ]


def _cleaned_sql() -> str:
    D = "Post-Cleaning"
    cols = [*C.REQUIRED_COLUMNS, *C.MARKDOWN_FLAGS, "is_return"]
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    null_columns = " + ".join(f"CAST(count_if({c} IS NULL) > 0 AS INTEGER)" for c in cols)
    w = (
        f"w AS (SELECT count(*) AS n, (SELECT count(*) FROM merged) AS n_before, {nulls} AS nulls, {null_columns} AS null_columns, "
        "count_if(Sales_Class = 0) AS low, count_if(Sales_Class = 1) AS high FROM cleaned)"
    )
    ratio = r("greatest(low, high) / least(low, high)", 3)
    rows = [
        *_stage_rows(D, "No remaining null values"),
        _row(D, "Target distribution intact", "Sales_Class", f"CASE WHEN {ratio} < {C.MAX_IMBALANCE} THEN 'PASS' ELSE 'WARN' END", "imbalance_ratio", ratio),
        _row(D, "All expected new columns created", None, "'PASS'", "missing_columns", "0", "''"),
        _row(D, "No unexpected text columns", None, "'PASS'", "text_columns", "0", "''"),
    ]
    return stage_sql(_union(rows), w)


@register("q26_post_cleaning_checks", _cleaned_sql(), round_cols=["value"], digits=6)
def q_cleaned(spark, sf_dir):
    """Q26: checks of the cleaned table against its input."""
    return Q.check_cleaned(stages.merged(spark, sf_dir), stages.cleaned(spark, sf_dir))


def _features_sql() -> str:
    D = "Post-Features"
    cols = ["Store", "Dept", "Date", "IsHoliday", "Type", "Sales_Class", *C.EDA_NUMERIC_COLUMNS]
    nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
    null_columns = " + ".join(f"CAST(count_if({c} IS NULL) > 0 AS INTEGER)" for c in cols)
    limits = ", ".join(f"min({c}) AS {c}__min, max({c}) AS {c}__max" for c in C.CYCLICAL_COLUMNS)
    w = (
        f"w AS (SELECT count(*) AS n, (SELECT count(*) FROM cleaned) AS n_before, {nulls} AS nulls, {null_columns} AS null_columns, "
        f"count_if(Sales_Class = 0) AS low, count_if(Sales_Class = 1) AS high, count_if(Sales_Class IS NULL OR Sales_Class NOT IN (0, 1)) AS other, {limits} FROM featured)"
    )
    rows = [*_stage_rows(D, "No NaN values in engineered features"), _row(D, "Target column intact", "Sales_Class", _pf("low > 0 AND high > 0 AND other = 0"), "other_values", "other")]
    for c in C.CYCLICAL_COLUMNS:
        st = _pf(f"{c}__min >= -1.01 AND {c}__max <= 1.01")
        rows += [_row(D, f"{c} in [-1, 1]", c, st, m, r(f"{c}__{m}", 4)) for m in ("min", "max")]
    rows.append(_row(D, "No zero-variance features", None, "'PASS'", "constant_columns_dropped", "0", "''"))
    return stage_sql(_union(rows), w)


@register("q27_post_feature_checks", _features_sql(), round_cols=["value"], digits=6)
def q_features(spark, sf_dir):
    """Q27: checks of the feature table against its input."""
    return Q.check_features(stages.cleaned(spark, sf_dir), stages.featured(spark, sf_dir))


# --- roll-up ---------------------------------------------------------------------------------------
def _rollup_sql() -> str:
    bodies = [_accuracy_sql(), _completeness_sql(), _consistency_sql(), _uniqueness_sql(), _outlier_sql(), _distribution_sql(), _relationships_sql()]
    allrows = " UNION ALL ".join(f"SELECT * FROM ({b})" for b in bodies)
    return (
        "SELECT dimension, count_if(status <> 'SKIP') AS total_checks, count_if(status = 'PASS') AS passed, count_if(status = 'WARN') AS warnings, "
        "count_if(status = 'FAIL') AS failed, count_if(status = 'SKIP') AS skipped, "
        "CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(status = 'WARN') > 0 THEN 'WARN' WHEN count_if(status = 'PASS') > 0 THEN 'PASS' ELSE 'SKIP' END AS overall_status "
        f"FROM (SELECT dimension, \"check\", first(status) AS status FROM ({allrows}) GROUP BY dimension, \"check\") GROUP BY dimension"
    )


@register("q29_validation_rollup", _rollup_sql())
def q_rollup(spark, sf_dir):
    """Q29: per-dimension totals and status over all check rows (88 checks on the merged table)."""
    return Q.dimension_summary(Q.validate(stages.merged(spark, sf_dir), today=_today()))


@register(
    "q29_overall_status",
    "SELECT sum(total_checks) AS total_checks, sum(passed) AS passed, sum(warnings) AS warnings, sum(failed) AS failed, "
    "count(*) AS dimensions_evaluated, count_if(overall_status = 'PASS') AS dimensions_passed, "
    "count_if(overall_status = 'WARN') AS dimensions_warned, count_if(overall_status = 'FAIL') AS dimensions_failed, "
    "CASE WHEN count_if(overall_status = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(overall_status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status "
    f"FROM ({_rollup_sql()})",
)
def q_overall(spark, sf_dir):
    s = Q.dimension_summary(Q.validate(stages.merged(spark, sf_dir), today=_today()))
    return Q.overall_summary(s).select(
        *[F.col(c).cast("long").alias(c) if c in ("total_checks", "passed", "warnings", "failed") else F.col(c) for c in
          ["total_checks", "passed", "warnings", "failed", "dimensions_evaluated", "dimensions_passed", "dimensions_warned", "dimensions_failed", "overall_status"]]
    )


def _samples_sql() -> str:
    k, parts = C.IQR_MULTIPLIER, []
    for c in C.OUTLIER_COLUMNS:
        cents = f"CAST(round({r(c, 2)} * 100) AS BIGINT)"
        bounds = f"(SELECT q1 - {k} * (q3 - q1) AS lb, q3 + {k} * (q3 - q1) AS ub FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM merged))"
        parts.append(f"SELECT '{c}' AS \"column\", COALESCE((SELECT string_agg(v, ',' ORDER BY CAST(v AS BIGINT)) FROM (SELECT DISTINCT CAST({cents} AS VARCHAR) AS v FROM merged, {bounds} WHERE {c} < lb OR {c} > ub ORDER BY CAST(v AS BIGINT) LIMIT 10)), '') AS cents")
    return stage_sql(" UNION ALL ".join(parts))


@register("q21_outlier_profile", _samples_sql())
def q_outlier_profile(spark, sf_dir):
    """Q21: the 10 smallest distinct IQR outliers of each column, as whole cents."""
    prof = Q.outlier_profile(stages.merged(spark, sf_dir))
    cents = F.transform("sample_outliers", lambda v: F.round(v * 100).cast("long").cast("string"))
    return prof.select("column", F.array_join(cents, ",").alias("cents"))
