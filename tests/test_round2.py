"""Faults named in the last review: hot values, NULL classes, ties, empty and one-row frames, sources, p-values."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.functions import calendar as cal
from shelfspark.functions.pvalues import r_two_sided_p, t_two_sided_p
from shelfspark.operators import aggregates as A
from shelfspark.operators import correlation as CR
from shelfspark.operators import features as FE
from shelfspark.operators import gridsearch as GS
from shelfspark.operators import profile as D
from shelfspark.operators import quality as Q
from shelfspark.operators import sampling as S
from shelfspark.operators import timeseries as X
from shelfspark.operators.common import one_row_concat
from shelfspark.operators.ranks import group_quantiles
from shelfspark.session import ensure_checkpoint_dir
from shelfspark.sources import files


def linear_quantile(values, p):
    v, h = sorted(values), p * (len(values) - 1)
    lo = math.floor(h)
    return v[lo] + (h - lo) * (v[min(lo + 1, len(v) - 1)] - v[lo])


@pytest.mark.parametrize("accuracy", [10000, 50])
def test_bracketed_quantiles_are_exact(spark, accuracy):
    rng = random.Random(1)
    rows = [("hot", 0.0)] * 700 + [("hot", rng.random()) for _ in range(900)] + [("few", float(k)) for k in (3, 1, 2)] + [("one", 5.0), ("none", None), (None, 1.0), (None, 2.0)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in group_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", probs, ["g"], accuracy=accuracy).collect()}
    for g in ("hot", "few", "one", None):
        own = [v for k, v in rows if k == g]
        for p in probs:
            assert got[(g, p)] == pytest.approx(linear_quantile(own, p), abs=1e-12), (g, p)
    assert ("none", 0.5) not in got


def test_quantile_plan_runs_no_job_and_has_no_wide_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("v"))
    plan = group_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile_approx" in plan


def test_null_class_is_no_class(spark):
    df = spark.createDataFrame([(0,)] * 4 + [(1,)] * 4 + [(None,)], "Sales_Class int")
    assert {r["class"]: (r["count"], r.pct, r.imbalance_ratio) for r in A.class_distribution(df).collect()} == {0: (4, 50.0, 1.0), 1: (4, 50.0, 1.0)}
    row = Q.check_distribution(df).where("metric = 'imbalance_ratio'").collect()
    assert [(r.status, r.value) for r in row] == [("PASS", 1.0)]
    one = spark.createDataFrame([(0,), (None,)], "Sales_Class int")
    assert Q.check_distribution(one).count() == 0


def test_skipped_dimension_stays_skipped(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, None, 1.0)], "Size double, Weekly_Sales double, RSXFS double, PCE double, Unemployment double")
    summary = Q.dimension_summary(Q.check_relationships(df)).collect()
    assert [(r.total_checks, r.overall_status) for r in summary] == [(0, "SKIP")]


def test_exact_split_with_equal_rows(spark):
    df = spark.createDataFrame([(7, 0)] * 90 + [(k, 0) for k in range(10)] + [(7, 1)] * 5, "a int, Sales_Class int").repartition(6)
    flagged = S.split_flag(df, exact=True)
    got = {r.Sales_Class: (r.n, r.t) for r in flagged.groupBy("Sales_Class").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got == {0: (100, 20), 1: (5, 1)}


@pytest.mark.parametrize("t,df,p", [(2.0, 10, 0.07338803477074), (1.0, 1, 0.5), (2.228138851964939, 10, 0.05), (0.5, 1e10, 0.6170750774519738), (0.5, 1e12, 0.6170750774519738), (0.0, 5, 1.0), (40.0, 5, 1.8411962e-07), (1e9, 30, 0.0), (12.706204736432095, 1, 0.05)])
def test_p_values_do_not_drift(t, df, p):
    assert t_two_sided_p(t, df) == pytest.approx(p, rel=1e-6, abs=1e-200)


def test_p_values_without_an_answer():
    assert t_two_sided_p(None, 3) is None and t_two_sided_p(float("nan"), 3) is None and r_two_sided_p(0.5, 2) is None and r_two_sided_p(1.0, 10) == 0.0


def test_hot_value_of_qq_points_is_cut_into_blocks(spark):
    values = [0.0] * 500 + [float(k) for k in range(1, 31)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    pts = sorted((r.i, r.ordered) for r in D.qq_points(df, "v", block=64).collect())
    assert [i for i, _ in pts] == list(range(1, 531)) and [v for _, v in pts] == sorted(values)


def test_categorical_profile_with_many_values(spark):
    df = spark.createDataFrame([("a",)] * 5 + [(None,)] * 5 + [(f"v{k}",) for k in range(200)], "c string")
    rows = D.categorical_profile(df, "c", top=3).collect()
    assert [(r.value, r["count"], r["rank"], r.unique_values) for r in sorted(rows, key=lambda r: r["rank"])] == [(None, 5, 1, 201), ("a", 5, 2, 201), ("v0", 1, 3, 201)]


def test_samples_of_bad_values_are_the_smallest(spark):
    df = spark.createDataFrame([(k % 50,) for k in range(1000)], "k int")
    row = Q.smallest_distinct(df, {"low": F.when(F.col("k") > 9, F.col("k")), "none": F.when(F.col("k") > 99, F.col("k"))}, 4).first()
    assert row.low == [10, 11, 12, 13] and row.none == []


def series(n, seed=3):
    rng = random.Random(seed)
    day = dt.date(2011, 1, 1)
    return [(1, 1, day + dt.timedelta(days=rng.randint(0, 60)), float(rng.randint(0, 30))) for _ in range(n)] + [(2, 1, day, 4.0)]


def test_long_series_in_blocks(spark):
    df = spark.createDataFrame(series(120), "Store int, Dept int, Date date, Weekly_Sales double")
    for op in (X.add_lags, X.add_rolling, X.add_trend):
        whole, cut = (sorted(map(tuple, op(df, blocks=b).collect()), key=str) for b in (1, 9))
        assert len(cut) == 121
        for a, b in zip(whole, cut):
            assert a == pytest.approx(b) if all(x is not None for x in (*a, *b)) and False else all(x == y or (isinstance(x, float) and x == pytest.approx(y, rel=1e-9, abs=1e-9)) for x, y in zip(a, b))


def test_holiday_weeks_on_the_circle(spark):
    weeks = spark.range(1, 54).select(F.col("id").cast("int").alias("Week"), F.lit(1).alias("Month"))
    inside = {w for _, a, b in C.HOLIDAY_WINDOWS for w in range(a, b + 1)}
    for r in weeks.withColumns(cal.holiday_columns()).collect():
        assert r.HolidayProximity == min(min(abs(r.Week - h), 52 - abs(r.Week - h)) for h in inside)
        assert r.IsPreHoliday == int(r.Week + 1 in inside) and r.IsPostHoliday == int(r.Week - 1 in inside and r.Week <= 52)


def test_pairwise_sums_match_corr(spark):
    rng = random.Random(5)
    rows = [(rng.random(), None if rng.random() < 0.2 else rng.random() * 1e6 + 1e9, 3.0, k) for k in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int").repartition(5)
    got = {(r.a, r.b): (r.n, r.r) for r in CR.pair_sums(df, ["a", "b", "c", "d"]).collect()}
    want = df.agg(F.corr("a", "b").alias("ab"), F.corr("b", "d").alias("bd"), F.count("b").alias("n")).first()
    assert got[("a", "b")][1] == pytest.approx(want.ab) and got[("d", "b")][1] == pytest.approx(want.bd) and got[("b", "a")][0] == want.n
    assert got[("a", "c")][1] is None and got[("a", "a")][1] == pytest.approx(1.0)
    assert {r.r for r in CR.pair_sums(df.where("a < 0"), ["a", "b"]).collect()} == {None}


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None, 5), (1, 3.0, None, None)], "k int, v double, allnull double, single int")
    assert FE.zero_variance_columns(df) == ["k"]
    assert FE.zero_variance_columns(df.where("k > 1")) == [] and FE.zero_variance_columns(df.limit(1)) == []


def merged_rows(n=40):
    day = dt.date(2010, 2, 5)
    return [(1 + k % 4, 1 + k % 3, day + dt.timedelta(weeks=k), float(100 * k - 50), k % 5 == 0, "ABC"[k % 3], 1000 * (1 + k % 4), None if k % 2 else 5.0 * k, k % 2) for k in range(n)]


MERGED = "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean, Type string, Size int, MarkDown1 double, Sales_Class int"


def test_stage_checks_find_injected_faults(spark):
    from shelfspark.operators import cleaning as P

    before = spark.createDataFrame(merged_rows(), MERGED)
    after = P.clean(before)[0]

    def status(rows):
        return {r.check: r.status for r in rows.collect()}

    good = status(Q.check_cleaned(before, after, markdowns=["MarkDown1"]))
    assert set(good.values()) == {"PASS"}
    bad = status(Q.check_cleaned(before, after.limit(39).drop("is_return").withColumn("x", F.lit("text")).withColumn("MarkDown1", F.lit(None).cast("double")).withColumn("inf", F.lit(float("inf"))), markdowns=["MarkDown1"]))
    assert (bad["Row count preserved"], bad["All expected new columns created"], bad["No unexpected text columns"], bad["No remaining null values"], bad["No infinite values"]) == ("FAIL", "FAIL", "WARN", "WARN", "FAIL")
    feats = after.withColumn("Month_sin", F.lit(0.5))
    assert set(status(Q.check_features(after, feats)).values()) == {"PASS"}
    worse = status(Q.check_features(after, feats.withColumn("Month_sin", F.lit(1.5)).withColumn("Sales_Class", F.lit(2))))
    assert worse["Month_sin in [-1, 1]"] == "FAIL" and worse["Target column intact"] == "FAIL"


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_one_row_frames(spark, n):
    df = spark.createDataFrame(merged_rows(n), MERGED)
    for check in (Q.check_accuracy, Q.check_completeness, Q.check_consistency, Q.check_uniqueness, Q.check_relationships):
        assert {r.status for r in check(df).collect()} <= {"PASS", "FAIL", "WARN", "SKIP"}
    assert Q.check_outliers(df, ["Weekly_Sales"]).count() == 7 * n
    assert D.numeric_profile(df, ["Weekly_Sales"]).count() == n


def test_only_one_row_sides_are_concatenated(spark):
    with pytest.raises(ValueError):
        one_row_concat(spark.range(2), spark.range(2))


def test_grid_search_learns_and_is_complete(spark):
    rng = random.Random(2)
    rows = [(rng.random(), rng.random() if k % 10 else None, int(rng.random() < 0.1)) for k in range(400)]
    df = spark.createDataFrame([(a, b, y if rng.random() < 0.0 else int(a > 0.6)) for a, b, y in rows], "a double, b double, Sales_Class int")
    scores = GS.grid_scores(df, ["a", "b"], {"max_depth": [1, 2], "learning_rate": [0.3], "gamma": [0.0], "reg_lambda": [1.0], "scale_pos_weight": [1.0, 3.0]}, rounds=10)
    assert scores.count() == 4 and GS.best_parameters(scores)["learning_rate"] == 0.3
    assert scores.agg(F.min("roc_auc")).first()[0] > 0.98


# --- sources ---------------------------------------------------------------------------------------
def folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/sources-{name}-{random.random()}"


def put(path, text):
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_csv_with_carriage_returns_only(spark):
    path = put(folder(spark, "cr") + "/stores.csv", "Store,Type,Size\r1,A,151315\r2,B,202307\r")
    assert [tuple(r) for r in files.read_dim(spark, path).orderBy("Store").collect()] == [(1, "A", 151315), (2, "B", 202307)]


def test_facts_and_context_csv(spark):
    path = put(folder(spark, "f") + "/facts.csv", "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,24924.5,FALSE\n1,1,2010-02-12,NaN,TRUE\n")
    rows = files.read_facts(spark, path).orderBy("Date").collect()
    assert (rows[0].Date, rows[0].Weekly_Sales, rows[0].IsHoliday) == (dt.date(2010, 2, 5), 24924.5, False) and rows[1].Weekly_Sales is None
    names = [f.name for f in files.CONTEXT_SCHEMA.fields]
    path = put(folder(spark, "c") + "/context.csv", ",".join(names) + "\n1,2010-02-05,42.3,2.5,NA,NA,NA,NA,NA,211.1,8.1,FALSE\n")
    row = files.read_context(spark, path).first()
    assert row.MarkDown1 is None and row.Temperature == 42.3 and row.IsHoliday is False


def test_series_payload(spark):
    path = put(folder(spark, "s") + "/UMCSENT.json", '{"observations": [{"date": "2010-02-01", "value": "73.6"}, {"date": "2010-03-01", "value": "."}]}')
    rows = files.read_series_json(spark, path).orderBy("Date").collect()
    assert [(r.Date, r.series_id, r.value) for r in rows] == [(dt.date(2010, 2, 1), "UMCSENT", 73.6), (dt.date(2010, 3, 1), "UMCSENT", None)]
    empty = put(folder(spark, "e") + "/X.json", '{"observations": []}')
    assert files.read_series_json(spark, empty).count() == 0


def test_missing_input_is_named_and_other_faults_are_raised(spark):
    with pytest.raises(files.MissingInputError, match="facts"):
        files.read_facts(spark, folder(spark, "none") + "/absent.csv")
    absent = files.read_optional_json(spark, folder(spark, "none") + "/absent", files.SERIES_PAYLOAD_SCHEMA)
    assert absent.count() == 0
    with pytest.raises(Exception):
        files.read_optional_json(spark, "nosuchscheme://x/y", files.SERIES_PAYLOAD_SCHEMA)


def test_metrics_sink(spark):
    path = folder(spark, "m")
    files.write_metrics(spark.createDataFrame([("lr", 0.7)], "model string, f1 double"), path)
    assert [tuple(r) for r in spark.read.json(path).select("model", "f1").collect()] == [("lr", 0.7)]


def test_checkpoint_folder_is_required_off_local_masters(monkeypatch, spark):
    from shelfspark import session

    class Context:
        master = "spark://cluster:7077"
        _jsc = spark.sparkContext._jsc

    class Conf:
        @staticmethod
        def get(key, default=None):
            return None

    class Cluster:
        conf, sparkContext = Conf, Context

    class NoFolder:
        @staticmethod
        def isDefined():
            return False

    monkeypatch.setattr(Context, "_jsc", type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: NoFolder)}))}))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Cluster)
