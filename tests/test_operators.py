"""Unit tests on small hand-written frames (shapes of the reference's test fixtures)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import calendar as cal
from shelfspark.functions.pvalues import r_two_sided_p, t_two_sided_p
from shelfspark.operators import aggregates as A
from shelfspark.operators import cleaning as P
from shelfspark.operators import features as FE
from shelfspark.operators import joins as J
from shelfspark.operators import metrics as M
from shelfspark.operators import quality as Q
from shelfspark.operators import sampling as R
from shelfspark.operators.ranks import average_ranks, group_quantiles

D = dt.date


def test_asof_backward_exact_match_and_gaps(spark):
    left = spark.createDataFrame(
        [(1, D(2010, 2, 5)), (1, D(2010, 3, 1)), (2, D(2010, 1, 15)), (2, D(2010, 4, 20))], "Store int, Date date"
    )
    right = spark.createDataFrame(
        [(D(2010, 2, 1), 73.6, None), (D(2010, 3, 1), 73.4, 1.0), (D(2010, 4, 1), 72.2, 2.0)], "Date date, UMCSENT double, RSXFS double"
    )
    got = {(r.Store, r.Date): (r.UMCSENT, r.RSXFS) for r in J.asof_join(left, right, "Date").collect()}
    assert got[(1, D(2010, 2, 5))] == (73.6, None)  # NULL cell of the chosen row stays NULL
    assert got[(1, D(2010, 3, 1))] == (73.4, 1.0)  # exact match allowed
    assert got[(2, D(2010, 1, 15))] == (None, None)  # before the first right row
    assert got[(2, D(2010, 4, 20))] == (72.2, 2.0)


def test_asof_by_key_and_duplicate_right_keys_fail(spark):
    left = spark.createDataFrame([(1, 5), (1, 9), (2, 9)], "k int, t int")
    right = spark.createDataFrame([(1, 4, "a"), (1, 8, "b"), (2, 10, "c")], "k int, t int, v string")
    got = sorted((r.k, r.t, r.v) for r in J.asof_join(left, right, "t", by=["k"]).collect())
    assert got == [(1, 5, "a"), (1, 9, "b"), (2, 9, None)]
    dup = spark.createDataFrame([(1, 4, "a"), (1, 4, "b")], "k int, t int, v string")
    with pytest.raises(ValueError):
        J.asof_join(left, dup, "t", by=["k"])


def test_store_median_target_strict_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10.0), (1, 20.0), (1, 30.0), (2, 5.0), (2, 5.0), (2, None)], "Store int, Weekly_Sales double"
    )
    got = sorted(
        ((r.Store, r.Weekly_Sales, r.Sales_Class) for r in A.add_store_median_target(df).collect()),
        key=lambda t: (t[0], t[1] is None, t[1] or 0.0),
    )
    assert [g[2] for g in got if g[0] == 1] == [0, 0, 1]  # median 20: strict
    assert [g[2] for g in got if g[0] == 2] == [0, 0, 0]  # ties and NULL → 0


def test_exact_quantiles_match_linear_interpolation(spark):
    vals = [1.0, 2.0, 4.0, 9.0, 30.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = {r.p: r.q for r in group_quantiles(df, "x", [0.25, 0.5, 0.75, 0.01, 0.99]).collect()}
    assert q[0.25] == pytest.approx(2.0) and q[0.5] == pytest.approx(4.0) and q[0.75] == pytest.approx(9.0)
    assert q[0.01] == pytest.approx(1.04) and q[0.99] == pytest.approx(29.16)


def test_quantiles_with_hot_group_and_few_partitions(spark):
    rows = [("hot", float(i % 97)) for i in range(3000)] + [("cold", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: r.q for r in group_quantiles(df, "x", [0.5], ["g"]).collect()}
    ref = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("x", 0.5).alias("q")).collect()}
    assert got == pytest.approx(ref)


def test_average_ranks_ties(spark):
    df = spark.createDataFrame([(v,) for v in [10.0, 20.0, 20.0, 30.0]], "x double")
    got = {r.x: r.avg_rank for r in average_ranks(df, "x").collect()}
    assert got == {10.0: 1.0, 20.0: 2.5, 30.0: 4.0}


def test_cleaning_flags_fill_clip(spark):
    rows = [(float(i), (float(i) if i % 3 else None)) for i in range(-5, 200)]
    df = spark.createDataFrame(rows, "Weekly_Sales double, MarkDown1 double")
    filled = P.add_sign_flag(P.flag_and_fill(df, ["MarkDown1"]))
    assert filled.where("MarkDown1 IS NULL").count() == 0
    assert filled.where("has_MarkDown1 = 0").count() == len([r for r in rows if r[1] is None])
    assert filled.where("is_return = 1").count() == 5
    clipped, bounds = P.percentile_clip(filled, ["Weekly_Sales"])
    b = bounds.collect()[0]
    mn, mx = clipped.agg(F.min("Weekly_Sales"), F.max("Weekly_Sales")).first()
    assert mn == pytest.approx(b.lower) and mx == pytest.approx(b.upper)
    # the middle 1..99 % is untouched
    kept = clipped.join(filled.select(F.col("Weekly_Sales").alias("o")), F.col("Weekly_Sales") == F.col("o")).count()
    # 205 values: P1 = -2.96 and P99 = 196.96, so exactly three values clip on each side
    assert kept == len(rows) - 6


def test_calendar_iso_week_and_holidays(spark):
    df = spark.createDataFrame([(D(2010, 1, 1),), (D(2010, 2, 12),), (D(2012, 2, 29),), (D(2010, 12, 31),)], "Date date")
    rows = FE.add_holiday(FE.add_temporal(df)).withColumn("YearWeek", cal.year_week("Date")).collect()
    out = {r.Date: r for r in rows}
    assert out[D(2010, 1, 1)].Week == 53 and out[D(2010, 1, 1)].YearWeek == "2009-W53"
    assert out[D(2010, 2, 12)].HolidayType == 1 and out[D(2010, 2, 12)].IsPreHoliday == 1  # week 6: window and pre-window
    assert out[D(2012, 2, 29)].DaysInMonth == 29 and out[D(2012, 2, 29)].IsMonthEnd == 1
    assert out[D(2010, 12, 31)].IsYearEnd == 1 and out[D(2010, 12, 31)].IsPeakSeason == 1
    assert all(0 <= r.HolidayProximity <= 26 for r in rows)


def test_quartile_labels_and_equal_edges(spark):
    df = spark.createDataFrame([(float(s),) for s in [10, 20, 30, 40, 50, 60, 70, 80]], "Size double")
    got = [r.SizeQuartile for r in FE.add_quartile(df).orderBy("Size").collect()]
    assert got == [1, 1, 2, 2, 3, 3, 4, 4]
    const = spark.createDataFrame([(1.0,)] * 8, "Size double")
    with pytest.raises(Exception):
        FE.add_quartile(const).collect()


def test_duplicates_and_check_statuses(spark):
    rows = [(1, 1, D(2010, 2, 5), 10.0)] * 3 + [(1, 2, D(2010, 2, 5), 11.0)]
    df = spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double")
    u = {(r.check, r.metric): r for r in Q.check_uniqueness(df).collect()}
    assert u[("No exact full-row duplicates", "duplicate_count")].value == 2.0
    assert u[("No exact full-row duplicates", "duplicate_count")].status == "FAIL"


def test_rollup_statuses(spark):
    rows = [("A", "c1", None, "PASS", "m", 1.0, None), ("A", "c2", None, "WARN", "m", 1.0, None), ("B", "c3", None, "FAIL", "m", 1.0, None)]
    checks = spark.createDataFrame(rows, Q.ROW_SCHEMA)
    s = {r.dimension: r.overall_status for r in Q.dimension_summary(checks).collect()}
    assert s == {"A": "WARN", "B": "FAIL"}
    assert Q.overall_summary(Q.dimension_summary(checks)).first().overall_status == "FAIL"


def test_split_is_a_partition_and_stable(spark):
    df = spark.range(20000).withColumn("Sales_Class", (F.col("id") % 2).cast("int"))
    a = R.split_flag(df).where("is_test").select("id")
    b = R.split_flag(df.repartition(13)).where("is_test").select("id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.count() / 20000
    assert 0.18 < share < 0.22
    exact = R.split_flag(df, exact=True).groupBy("Sales_Class").agg(F.sum(F.col("is_test").cast("int")).alias("t")).collect()
    assert all(r.t == 2000 for r in exact)


def test_metrics_and_auc(spark):
    rows = [(1, 1, 0.9, True), (1, 0, 0.8, False), (0, 1, 0.7, False), (0, 0, 0.1, True), (1, 1, 0.7, False)]
    df = spark.createDataFrame(rows, "y int, pred int, score double, segment boolean")
    m = M.binary_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 1)
    assert m.f1 == pytest.approx(2 / 3)
    auc = M.roc_auc(df).first().roc_auc
    # positives: 0.9, 0.8, 0.7 ; negatives: 0.7, 0.1 → (2 + 2 + 1.5) / 6
    assert auc == pytest.approx(5.5 / 6)
    s = M.segment_accuracy(df).first()
    # segment rows are both right; regular rows: 1 of 3 right → WCE = (5·0 + 1·2/3) / 6
    assert s.holiday_accuracy == 1.0 and s.weighted_classification_error == pytest.approx((2 / 3) / 6)


def test_pvalues_match_tables():
    assert t_two_sided_p(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert t_two_sided_p(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert t_two_sided_p(1.95996, 10**6) == pytest.approx(0.05, abs=1e-4)
    assert r_two_sided_p(0.0, 100) == pytest.approx(1.0)
    assert math.isclose(r_two_sided_p(1.0, 10), 0.0)
