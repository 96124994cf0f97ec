"""Queries of the preprocessing and model stages (R, F21–F24, Q28, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import cleaning as P
from shelfspark.operators import forest as RF
from shelfspark.operators import gridsearch as GS
from shelfspark.operators import logistic as LR
from shelfspark.operators import metrics as M
from shelfspark.operators import models as ML
from shelfspark.operators import neighbours as KN
from shelfspark.operators import sampling as R
from shelfspark.operators import scaling as S
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.session import cut_lineage, ensure_checkpoint_dir
from shelfspark.sources import retail_view as rv

# Columns scaled by the preprocessing stage: numeric model-frame columns minus the
# no-scale list (checked against the schema at run time).
SCALE_COLS = [
    "Size", "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5", "CPI",
    "Unemployment", "UMCSENT", "RSXFS", "PCE", "Month", "Week", "Quarter", "DayOfYear", "WeekOfMonth", "DaysInMonth",
    "YearProgress", "HolidayProximity", "TotalMarkDown", "AvgMarkDownAmount", "MaxMarkDown", "SizePerType",
    "StoreDeptCount", "DeptFrequency", "ConsumerConfRatio", "Holiday_Size", "Temp_Season", "MarkDown_Intensity",
    "Month_sin", "Month_cos", "Week_sin", "Week_cos",
]


def model_frame(spark, sf_dir):
    """P6–P8 on the feature table: the frame the split and scaler see."""
    return P.drop_leakage(P.drop_encoded_categoricals(P.bool_to_int(stages.featured(spark, sf_dir))))


def _checked_scale_cols(df):
    cols = S.scale_columns(df)
    if sorted(cols) != sorted(SCALE_COLS):
        raise AssertionError(f"scale columns changed: {sorted(set(cols) ^ set(SCALE_COLS))}")
    return cols


_PREPARED: dict = {}


def prepared(spark, sf_dir):
    """Split (R3) → robust scaler fitted on train (F21) → (train, test, params); split and parameters are
    written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        mf = model_frame(spark, sf_dir)
        cols = _checked_scale_cols(mf)
        flagged = cut_lineage(R.split_flag(mf), "split")
        params = cut_lineage(S.fit_robust(flagged.where(~F.col("is_test")), cols), "scaler")
        scaled = S.apply_scaler(flagged, params, cols)  # a projection: not written a second time
        _PREPARED[key] = (scaled.where(~F.col("is_test")).drop("is_test"), scaled.where(F.col("is_test")).drop("is_test"), params)
    return _PREPARED[key]


# --- sampling / split (rows-only: engine-specific hashing) ------------------------------------
@register("r1_seeded_sample_5000", None)
def r1(spark, sf_dir):
    """5,000 rows by seeded hash order (same rows on any partitioning)."""
    return R.sample_n(stages.eda(spark, sf_dir), 5000)


@register("r1_seeded_sample_per_type", None)
def r1b(spark, sf_dir):
    """Up to 2,000 rows per store type."""
    return R.sample_n(stages.eda(spark, sf_dir), 2000, by="Type")


@register("r2_fraction_sample", None)
def r2(spark, sf_dir):
    """R2: 25 % seeded fraction sample."""
    return R.sample_fraction(stages.eda(spark, sf_dir), 0.25)


@register("r3_r4_stratified_split_report", None)
def r3(spark, sf_dir):
    """R3 stratified 80/20 split by class (hash threshold) and R4 report."""
    return R.split_report(R.split_flag(model_frame(spark, sf_dir)))


def _exact_sizes_sql(fraction: float, by: str | None) -> str:
    part = f"PARTITION BY {by}" if by else ""
    n = f"count(*) OVER ({part})"
    own = f"{by}, " if by else "-1 AS stratum, "
    return stage_sql(f"SELECT DISTINCT {own}{n} AS rows, CAST(round({n} * {fraction}) AS BIGINT) AS test_rows FROM featured")


@register("r3_exact_split_sizes", _exact_sizes_sql(0.2, "Sales_Class"))
def r3c(spark, sf_dir):
    """R3 exact variant: each class has round(0.2 · n) test rows, and no row is lost or doubled."""
    flagged = R.split_flag(model_frame(spark, sf_dir), exact=True)
    return flagged.groupBy("Sales_Class").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_test").alias("test_rows"))


@register("r3_exact_stratified_split_report", None)
def r3b(spark, sf_dir):
    """R3 exact variant: per-class counts round(0.2·n) from hash ranks."""
    return R.split_report(R.split_flag(model_frame(spark, sf_dir), exact=True))


@register(
    "r3_r5_split_invariants",
    stage_sql("SELECT 'stratified' AS split, count(*) AS rows, TRUE AS share_in_band FROM featured UNION ALL SELECT 'holdout', count(*), TRUE FROM featured"),
)
def r35(spark, sf_dir):
    """Every row is on one side, and the test share is within 5 standard deviations of the wanted one."""
    mf, out = model_frame(spark, sf_dir), None
    for name, fraction, by in (("stratified", 0.2, "Sales_Class"), ("holdout", 0.15, None)):
        n, share = F.count(F.lit(1)), F.avg(F.col("is_test").cast("double"))
        band = F.abs(share - fraction) <= 5 * F.sqrt(fraction * (1 - fraction) / n) + 0.001
        part = R.split_flag(mf, test_fraction=fraction, stratify=by).agg(n.alias("rows"), band.alias("share_in_band"))
        part = part.select(F.lit(name).alias("split"), "rows", "share_in_band")
        out = part if out is None else out.unionByName(part)
    return out


@register("r5_holdout_split_report", None)
def r5(spark, sf_dir):
    """Unstratified 85/15 hold-out."""
    return R.split_report(R.split_flag(model_frame(spark, sf_dir), test_fraction=0.15, stratify=None))


# --- scaling ---------------------------------------------------------------------------------
def _robust_sql(table: str) -> str:
    return stage_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS center, "
            f"CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1e0 "
            f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS scale FROM {table}"
            for c in SCALE_COLS
        )
    )


@register("f21_robust_scaler_params_full", _robust_sql("featured"), round_cols=["center", "scale"], digits=6)
def f21(spark, sf_dir):
    """robust-scaler parameters (median, IQR; IQR 0 → 1) fitted on the whole feature table."""
    mf = model_frame(spark, sf_dir)
    return S.fit_robust(mf, _checked_scale_cols(mf))


@register(
    "f22_standard_scaler_params_full",
    stage_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", avg({c}) AS center, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1e0 "
            f"ELSE stddev_pop({c}) END AS scale FROM featured"
            for c in SCALE_COLS
        )
    ),
    round_cols=["center", "scale"],
    digits=4,
)
def f22(spark, sf_dir):
    """standard-scaler parameters (mean, population std; 0 → 1)."""
    mf = model_frame(spark, sf_dir)
    return S.fit_standard(mf, _checked_scale_cols(mf))


@register("f21_scaled_train_medians", None)
def f21b(spark, sf_dir):
    """F21 fit on train, applied to both: scaled train medians are ≈ 0 (rows-only)."""
    from shelfspark.operators.ranks import quantiles_wide

    train, _, _ = prepared(spark, sf_dir)
    return quantiles_wide(train, SCALE_COLS, {"median": 0.5})


@register(
    "q28_post_scale_checks",
    stage_sql(
        "SELECT 'train and test' AS frame, sum(nulls) AS null_cells, CAST(0 AS BIGINT) AS inf_cells FROM (SELECT "
        + " + ".join(f"count_if({c} IS NULL)" for c in SCALE_COLS)
        + " AS nulls FROM featured)"
    ),
)
def q28b(spark, sf_dir):
    """Q28: scaling adds no NULL cell to the scaled columns and no infinite one, over train and test together."""
    train, test, _ = prepared(spark, sf_dir)
    both = train.select(*SCALE_COLS).unionByName(test.select(*SCALE_COLS))
    return S.post_scale_checks(both, "train and test")


@register("q28_post_scale_checks_by_side", None)
def q28(spark, sf_dir):
    """Q28: NULL and infinite cells of scaled train and test."""
    train, test, _ = prepared(spark, sf_dir)
    return S.post_scale_checks(train, "train").unionByName(S.post_scale_checks(test, "test"))


@register("f23_f24_feature_metadata", None)
def f24(spark, sf_dir):
    """F23 scale-column selection and F24 feature metadata (binary / continuous / scaled)."""
    train, _, _ = prepared(spark, sf_dir)
    return S.feature_metadata(train, SCALE_COLS)


# --- metrics on a ready (y, ŷ) table ----------------------------------------------------------
LABELS_CTE = (
    "lab AS (SELECT l.doc_id, l.quality AS y, 1 - l.toxic AS pred, CAST(d.n_chars AS DOUBLE) AS score, d.lang <> 'en' AS segment "
    "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
)


def labels_frame(spark, sf_dir):
    """(y, pred, score, segment): quality vs. the non-toxic flag, document length as score,
    non-English documents as the up-weighted segment."""
    lab = rv.table(spark, sf_dir, "labels")
    docs = rv.table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    return lab.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").alias("y"),
        (1 - F.col("toxic")).alias("pred"),
        F.col("n_chars").cast("double").alias("score"),
        (F.col("lang") != "en").alias("segment"),
    )


def _metrics_sql(src: str) -> str:
    return (
        "SELECT tp, fp, fn, tn, CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0e0 END AS accuracy, "
        "prec AS precision, rec AS recall, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0e0 END AS f1 FROM ("
        "SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS prec, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS rec FROM ("
        f"SELECT count_if(y = 1 AND pred = 1) AS tp, count_if(y <> 1 AND pred = 1) AS fp, count_if(y = 1 AND pred <> 1) AS fn, "
        f"count_if(y <> 1 AND pred <> 1) AS tn FROM {src}))"
    )


@register("m8_binary_metrics", stage_sql(_metrics_sql("lab"), LABELS_CTE), round_cols=["accuracy", "precision", "recall", "f1"], digits=9)
def m8(spark, sf_dir):
    """M8: accuracy, precision, recall, F1 from confusion counts."""
    return M.binary_metrics(labels_frame(spark, sf_dir))


def _auc_sql(src: str) -> str:
    rk = "((rank() OVER (ORDER BY score)) + (count(*) OVER () - rank() OVER (ORDER BY score DESC) + 1)) / 2e0"
    return (
        "SELECT CASE WHEN n1 > 0 AND n0 > 0 THEN (rs - n1 * (n1 + 1) / 2) / (n1 * n0) END AS roc_auc FROM ("
        f"SELECT sum(CASE WHEN y = 1 THEN rk END) AS rs, CAST(count_if(y = 1) AS DOUBLE) AS n1, CAST(count_if(y <> 1) AS DOUBLE) AS n0 "
        f"FROM (SELECT y, {rk} AS rk FROM {src} WHERE score IS NOT NULL AND y IS NOT NULL))"
    )


@register("m9_roc_auc_labels", stage_sql(_auc_sql("lab"), LABELS_CTE), round_cols=["roc_auc"], digits=9)
def m9(spark, sf_dir):
    """M9: exact ROC-AUC (rank sum, average ranks for ties) of document length for quality."""
    return M.roc_auc(labels_frame(spark, sf_dir))


@register(
    "m9_roc_auc_retail_size",
    stage_sql(_auc_sql("(SELECT Sales_Class AS y, CAST(Size AS DOUBLE) AS score FROM eda)")),
    round_cols=["roc_auc"],
    digits=9,
)
def m9b(spark, sf_dir):
    """M9 on the retail table: AUC of store Size as a univariate score of the class."""
    e = stages.eda(spark, sf_dir).select(F.col("Sales_Class").alias("y"), F.col("Size").cast("double").alias("score"))
    return M.roc_auc(e)


@register(
    "m10_weighted_f1",
    stage_sql(
        "SELECT sum(f1 * support) / sum(support) AS weighted_f1 FROM (SELECT support, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0e0 END AS f1 FROM ("
        "SELECT s.support, CASE WHEN COALESCE(pr.predicted, 0) > 0 THEN COALESCE(t.tp, 0) / pr.predicted ELSE 0e0 END AS p, "
        "CASE WHEN s.support > 0 THEN COALESCE(t.tp, 0) / s.support ELSE 0e0 END AS r FROM "
        "(SELECT y AS k, count(*) AS support FROM lab GROUP BY y) s "
        "LEFT JOIN (SELECT y AS k, count(*) AS tp FROM lab WHERE y = pred GROUP BY y) t ON s.k = t.k "
        "LEFT JOIN (SELECT pred AS k, count(*) AS predicted FROM lab GROUP BY pred) pr ON s.k = pr.k))",
        LABELS_CTE,
    ),
    round_cols=["weighted_f1"],
    digits=9,
)
def m10(spark, sf_dir):
    """Support-weighted F1."""
    return M.weighted_f1(labels_frame(spark, sf_dir))


_SEG_SQL = (
    "SELECT ha AS holiday_accuracy, ra AS regular_accuracy, (5 * (1 - ha) + 1 * (1 - ra)) / 6 AS weighted_classification_error FROM ("
    "SELECT COALESCE(avg(CASE WHEN segment THEN CAST(y = pred AS DOUBLE) END), 0e0) AS ha, "
    "COALESCE(avg(CASE WHEN NOT segment THEN CAST(y = pred AS DOUBLE) END), 0e0) AS ra FROM {src})"
)


@register(
    "m11_m12_segment_accuracy",
    stage_sql(_SEG_SQL.format(src="lab"), LABELS_CTE),
    round_cols=["holiday_accuracy", "regular_accuracy", "weighted_classification_error"],
    digits=9,
)
def m11(spark, sf_dir):
    """M11 segment accuracy (0.0 when empty) and M12 weighted classification error."""
    return M.segment_accuracy(labels_frame(spark, sf_dir))


_PREDICTORS = {
    "non_toxic": "1 - toxic_flag",
    "long_document": "CASE WHEN score > 1000 THEN 1 ELSE 0 END",
    "always_high": "1",
}


def _comparison_sql() -> str:
    parts = []
    for name, expr in _PREDICTORS.items():
        src = f"(SELECT y, {expr} AS pred, score, segment FROM (SELECT y, 1 - pred AS toxic_flag, score, segment FROM lab))"
        parts.append(
            f"SELECT '{name}' AS model, m.accuracy, m.precision, m.recall, m.f1, a.roc_auc, s.holiday_accuracy, s.regular_accuracy, "
            f"s.weighted_classification_error FROM ({_metrics_sql(src)}) m, ({_auc_sql(src)}) a, ({_SEG_SQL.format(src=src)}) s"
        )
    return " UNION ALL ".join(parts)


@register(
    "m13_model_comparison",
    stage_sql(_comparison_sql(), LABELS_CTE),
    round_cols=["accuracy", "precision", "recall", "f1", "roc_auc", "holiday_accuracy", "regular_accuracy", "weighted_classification_error"],
    digits=9,
)
def m13(spark, sf_dir):
    """Metric rows of several predictors, comparable as one table."""
    lab = labels_frame(spark, sf_dir)
    preds = {
        "non_toxic": F.col("pred"),
        "long_document": F.when(F.col("score") > 1000, 1).otherwise(0),
        "always_high": F.lit(1),
    }
    out = None
    for name, e in preds.items():
        rep = M.model_report(lab.withColumn("pred", e), name)
        out = rep if out is None else out.unionByName(rep)
    return out


@register(
    "m13_best_model",
    stage_sql(f"SELECT model, f1 FROM ({_comparison_sql()}) ORDER BY f1 DESC, model LIMIT 1", LABELS_CTE),
    round_cols=["f1"],
    digits=9,
)
def m13b(spark, sf_dir):
    """Best predictor by F1."""
    return M.best_model(m13(spark, sf_dir)).select("model", "f1")


# --- models (rows-only: training is randomised) ----------------------------------------------------
def _train_test(spark, sf_dir):
    train, test, _ = prepared(spark, sf_dir)
    keep = [*C.SELECTED_FEATURES, C.TARGET, "IsHoliday"]
    return train.select(*keep), test.select(*keep)


def _evaluate(scored, name: str):
    df = scored.select(
        F.col(C.TARGET).alias("y"), F.col("prediction").cast("int").alias("pred"), F.col("p1").alias("score"), F.col("IsHoliday").alias("segment")
    )
    return M.model_report(cut_lineage(df, "scored"), name)  # each metric reads it: rows are scored once


@register("m1_dummy_baseline", None)
def m1(spark, sf_dir):
    """M1: stratified dummy baseline scored on the test split."""
    train, test = _train_test(spark, sf_dir)
    return _evaluate(ML.dummy_stratified(train, test), "dummy_stratified")


@register("m2_m7_logistic_regression", None)
def m2(spark, sf_dir):
    """M2 logistic regression (C = 1) trained on train, M7 scored on test."""
    _, test = _train_test(spark, sf_dir)
    return _evaluate(_logistic(spark, sf_dir).score(test), "logistic_regression")


def _logistic(spark, sf_dir):
    """The M2 model, fitted once per application and folder: M7 and M14 read it."""
    key = (spark.sparkContext.applicationId, sf_dir, "logistic")
    if key not in _PREPARED:
        _PREPARED[key] = LR.fit_logistic(_train_test(spark, sf_dir)[0], C.SELECTED_FEATURES)
    return _PREPARED[key]


@register(
    "m2_newton_optimum",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, TRUE AS is_optimum" for f in [*C.SELECTED_FEATURES, "(intercept)"]),
)
def m2b(spark, sf_dir):
    """M2: at the fitted coefficients the penalised loss over all training rows has no slope in any direction (SQL aggregates)."""
    slopes = LR.gradient_at(_train_test(spark, sf_dir)[0], _logistic(spark, sf_dir))
    return slopes.select("feature", (F.abs("gradient") < 1e-6).alias("is_optimum"))


@register("m3_random_forest", None)
def m3(spark, sf_dir):
    """M3 random forest (200 trees, depth 30, no node of fewer than 5 rows split) on the selected features, fitted on all
    training rows."""
    train, test = _train_test(spark, sf_dir)
    return _evaluate(RF.Forest(C.SELECTED_FEATURES, num_trees=200, max_depth=30, min_split=5).fit(train).score(test), "random_forest")


def _boosted(spark, sf_dir):
    """The M4 model, fitted once per application and folder: M7, M14 and M15 read it."""
    key = (spark.sparkContext.applicationId, sf_dir, "boosted")
    if key not in _PREPARED:
        _PREPARED[key] = ML.boosted_trees(C.SELECTED_FEATURES).fit(_train_test(spark, sf_dir)[0])
    return _PREPARED[key]


@register("m4_boosted_trees", None)
def m4(spark, sf_dir):
    """M4 gradient-boosted trees (100 rounds, depth 7, step 0.1)."""
    _, test = _train_test(spark, sf_dir)
    return _evaluate(ML.score(_boosted(spark, sf_dir), test, C.SELECTED_FEATURES), "boosted_trees")


@register("m5_grid_search", None)
def m5(spark, sf_dir):
    """M5: the best of the whole grid (243 combinations, 3 folds, 100 rounds, ROC-AUC) on all training rows, fitted again with
    Spark and scored."""
    train, test = _train_test(spark, sf_dir)
    scores = GS.grid_scores(train, C.SELECTED_FEATURES, C.BOOSTING_GRID)
    best = GS.best_parameters(scores)
    weighted = ML.with_class_weight(train, best["scale_pos_weight"])
    model = ML.boosted_trees(
        C.SELECTED_FEATURES, max_depth=int(best["max_depth"]), step=best["learning_rate"], min_info_gain=best["gamma"] / max(train.count(), 1), weight="_w", edges_by_all=True
    ).fit(weighted)
    return _evaluate(ML.score(model, test, C.SELECTED_FEATURES), "boosted_trees_cv")


@register("m6_nearest_neighbours", None)
def m6(spark, sf_dir):
    """M6: 5 nearest neighbours of every test row among all training rows, standardised features, majority class."""
    train, test = _train_test(spark, sf_dir)
    return _evaluate(KN.classify(train, test, C.SELECTED_FEATURES), "nearest_neighbours")


#: Days at the end of the table that are predicted from those before.
LAST_DAYS = 28


def _last_days_sql() -> str:
    dims = C.SELECTED_FEATURES
    scaled = ", ".join(f"coalesce((CAST(f.{c} AS DOUBLE) - m{i}) / CASE WHEN coalesce(s{i}, 0) = 0 THEN 1 ELSE s{i} END, 0) AS v{i}" for i, c in enumerate(dims))
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(dims))
    squares = " + ".join(f"(q.v{i} - t.v{i}) * (q.v{i} - t.v{i})" for i in range(len(dims)))
    v = ", ".join(f"v{i}" for i in range(len(dims)))
    own = " AND ".join(f"q.v{i} = b.v{i}" for i in range(len(dims)))
    return stage_sql(
        f"""SELECT q.Store, q.Dept, q.Date, q.Sales_Class, CAST(CASE WHEN 2 * high > n THEN 1 ELSE 0 END AS INTEGER) AS prediction, nearest, farthest
FROM asked q JOIN (
    SELECT {v}, count(*) AS n, count_if(label = 1) AS high, min(distance) AS nearest, max(distance) AS farthest FROM (
        SELECT * FROM (
            SELECT {", ".join(f"q.v{i}" for i in range(len(dims)))}, round(sqrt({squares}), 9) AS distance, t.Sales_Class AS label,
                row_number() OVER (PARTITION BY {", ".join(f"q.v{i}" for i in range(len(dims)))} ORDER BY round(sqrt({squares}), 9), t.Sales_Class) AS place
            FROM (SELECT DISTINCT {v} FROM asked) q CROSS JOIN known t) WHERE place <= 5) GROUP BY {v}) b ON {own}""",
        f"""cutoff AS (SELECT max(Date) - INTERVAL {LAST_DAYS} DAY AS d FROM featured),
parameters AS (SELECT {stats} FROM featured, cutoff WHERE Date <= d),
scaled AS MATERIALIZED (SELECT f.Store, f.Dept, f.Date, f.Sales_Class, f.Date > d AS late, {scaled} FROM featured f, cutoff, parameters),
asked AS MATERIALIZED (SELECT * FROM scaled WHERE late),
known AS MATERIALIZED (SELECT * FROM scaled WHERE NOT late)""",
    )


@register("m6_nearest_neighbours_last_days", _last_days_sql(), round_cols=["nearest", "farthest"], digits=5)
def m6b(spark, sf_dir):
    """M6 on a split by time: all rows of the last 28 days, each against all rows before them."""
    f = stages.featured(spark, sf_dir)
    late = f.agg(F.date_sub(F.max("Date"), LAST_DAYS).alias("d")).first().d
    train, test = f.where(F.col("Date") <= F.lit(late)), f.where(F.col("Date") > F.lit(late))
    out = KN.classify(train, test, C.SELECTED_FEATURES)
    return out.select("Store", "Dept", "Date", "Sales_Class", "prediction", "nearest", "farthest")


@register("m14_feature_importance", None)
def m14(spark, sf_dir):
    """Impurity importances (the M4 boosted trees) and |coefficients| (logistic)."""
    lr = _logistic(spark, sf_dir)
    linear = spark.createDataFrame([("logistic_regression", f, abs(w)) for f, w in zip(lr.features, lr.coefficients)], "model string, feature string, importance double")
    return ML.importances(_boosted(spark, sf_dir), C.SELECTED_FEATURES, "boosted_trees").unionByName(linear)


@register("m15_permutation_importance", None)
def m15(spark, sf_dir):
    """Fall of R² on the test rows when one feature's values are dealt out anew (boosted regressor of the class)."""
    train, test = _train_test(spark, sf_dir)
    model = ML.boosted_regressor(C.SELECTED_FEATURES).fit(train)
    return ML.permutation_importance(model, test, C.SELECTED_FEATURES)


@register(
    "m15_permuted_columns",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, TRUE AS same_values, TRUE AS moved" for f in C.SELECTED_FEATURES),
)
def m15b(spark, sf_dir):
    """Each permuted column holds the values of its feature, each as often (sums of two hashes), in other places."""
    _, test = _train_test(spark, sf_dir)
    rows = ML.permuted(test.select(*C.SELECTED_FEATURES), C.SELECTED_FEATURES)

    def sums(c):
        return [F.sum(F.xxhash64(F.lit(s), F.col(c)).cast("decimal(38,0)")) for s in (1, 2)]

    parts = [
        F.struct(
            F.lit(f).alias("feature"),
            ((sums(f)[0] == sums(f"{f}__perm")[0]) & (sums(f)[1] == sums(f"{f}__perm")[1])).alias("same_values"),
            (F.count_if(~F.col(f).eqNullSafe(F.col(f"{f}__perm"))) > 0).alias("moved"),
        )
        for f in C.SELECTED_FEATURES
    ]
    return rows.agg(F.array(*parts).alias("r")).select(F.explode("r").alias("r")).select("r.*")


@register("m16_load_or_train", None)
def m16(spark, sf_dir):
    """Reuse the saved logistic model under the checkpoint folder, else train and save."""
    train, test = _train_test(spark, sf_dir)
    path = ensure_checkpoint_dir(spark).rstrip("/") + "/models/logistic_" + sf_dir.strip("/").replace("/", "_")
    model = ML.load_or_train(path, ML.logistic(C.SELECTED_FEATURES, train.count()), train)
    return _evaluate(ML.score(model, test, C.SELECTED_FEATURES), "logistic_regression_saved")

