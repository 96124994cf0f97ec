"""Stage tables at size: joins with small sides, bounds found once, rounding for comparison."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import aggregates, cleaning, features, joins, ranks
from shelfspark.plans import catalog, stages
from shelfspark.session import HUGE_METHOD, small_methods


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _wide(spark, n=2000):
    return spark.range(n).selectExpr(
        "cast(id % 7 as int) AS Store", "cast(id % 5 as int) AS Dept", "date_add(date'2020-01-01', cast(id % 90 as int)) AS Date",
        "cast(id as double) AS Weekly_Sales", "cast(30 + id % 11 as int) AS Size", "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END AS Type",
    )


def test_asof_join_does_not_shuffle_the_rows_for_few_dates(spark):
    right = spark.sql("SELECT date_add(date'2020-01-01', cast(30 * id as int)) AS Date, cast(id as double) AS v FROM range(3)")
    out = joins.asof_join(_wide(spark), right, on="Date")
    assert "Exchange hashpartitioning" not in _plan(out) and "SortMergeJoin" not in _plan(out)
    assert {(r.at, r.v) for r in out.select((F.datediff("Date", F.lit("2020-01-01")) / 30).cast("int").alias("at"), "v").collect()} == {(k, float(k)) for k in range(3)}


def test_median_target_and_store_counts_do_not_shuffle_the_rows(spark):
    df = _wide(spark)
    for out in (aggregates.add_store_median_target(df), features.add_store_dept(df)):
        assert "Exchange hashpartitioning" not in _plan(out) and out.count() == 2000
    assert {(r.StoreDeptCount, r.DeptFrequency) for r in features.add_store_dept(df).collect()} == {(5, 7)}


def test_store_counts_with_nulls(spark):
    rows = [(None, 1, "A", 1), (1, None, "A", 2), (2, 1, "B", 3), (2, 1, "B", 4), (2, 3, "C", 5)]
    out = features.add_store_dept(spark.createDataFrame(rows, "Store int, Dept int, Type string, Size int"))
    assert {(r.Size, r.StoreDeptCount, r.DeptFrequency) for r in out.collect()} == {(1, None, 1), (2, 0, None), (3, 2, 1), (4, 2, 1), (5, 2, 1)}


def test_clip_bounds_are_found_once(spark):
    clipped, _ = cleaning.percentile_clip(spark.range(100).select(F.col("id").cast("double").alias("v")), ["v"], 0.1, 0.9)
    assert "MapInArrow" not in _plan(clipped)
    assert clipped.agg(F.min("v"), F.max("v")).first()[:] == pytest.approx((9.9, 89.1))


def test_constant_columns_beyond_the_first_rows(spark):
    df = spark.range(5000).repartition(3).selectExpr("id", "1 AS one", "if(id = 4999, 2, 1) AS late", "if(id = 4999, 2, NULL) AS single", "cast(NULL AS int) AS none")
    assert features.zero_variance_columns(df) == ["one"]


def test_rounding_away_from_ties_is_the_decimal_one(spark):
    values = [0.0, -0.0, 1.0, 0.1234567895, -0.1234567895, 2.5e-10, 123456.7890125, -1e-12, 1e15, 562949.953421312, float(2**53), 1 / 3, -2 / 3, 99.9999999996]
    df = spark.createDataFrame([(x,) for x in [*values, *[k * 0.0005 for k in range(-40, 40)], None]], "x double")
    for digits in (4, 6, 9):
        pairs = df.select(catalog.compare_round(F.col("x"), digits).cast("string").alias("a"), catalog._decimal_round(F.col("x"), digits).cast("string").alias("b"))
        assert pairs.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_generated_methods_stay_small(spark):
    before = spark.conf.get(HUGE_METHOD, "65535")
    try:
        spark.conf.set(HUGE_METHOD, "65535")
        small_methods(spark)
        assert spark.conf.get(HUGE_METHOD) == "8000"
        spark.conf.set(HUGE_METHOD, "5000")  # a choice of the session stands
        small_methods(spark)
        assert spark.conf.get(HUGE_METHOD) == "5000"
    finally:
        spark.conf.set(HUGE_METHOD, before)


def test_feature_stage_is_not_written_a_second_time(spark, tmp_path):
    """Features are a projection of the merged table: their sixty columns are computed where they are read."""
    n = spark.range(400)
    n.selectExpr(
        "id AS l_orderkey", "id % 30 AS l_partkey", "id % 8 AS l_suppkey", "cast(id % 5 + 1 as int) AS l_linenumber", "cast(id % 50 as double) AS l_quantity", "id * 1.5D AS l_extendedprice",
        "(id % 11) / 100D AS l_discount", "(id % 9) / 100D AS l_tax", "if(id % 4 = 0, 'R', 'N') AS l_returnflag", "date_add(date'2020-01-01', cast(id as int)) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    n.selectExpr("id AS o_orderkey", "if(id % 5 = 0, '1-URGENT', '2-HIGH') AS o_orderpriority", "date_add(date'2020-01-01', cast(id as int)) AS o_orderdate", "id * 10D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(8).selectExpr("id AS s_suppkey", "id % 4 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = stages.featured(spark, str(tmp_path))
    read = {f.split("/tables/")[1].split("/")[0].rsplit("-", 1)[0] for f in found.inputFiles()}
    assert "merged" in read and "featured" not in read
    assert stages.featured(spark, str(tmp_path)) is found and found.count() == 400
    want = features.engineer(cleaning.clean(stages.merged(spark, str(tmp_path)))[0])
    assert found.columns == want.columns and found.exceptAll(want).count() == 0
    used = stages.eda(spark, str(tmp_path)).groupBy("HasAnyMarkDown", "IsHoliday").agg(F.avg("Weekly_Sales"))
    assert "hashpartitioning(Store" not in _plan(used)


def test_quantiles_by_group_shuffle_no_rows_for_the_brackets(spark):
    df, limit = spark.range(30_000).selectExpr("nullif(id % 7, 6) AS g", "cast(id as double) AS v"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "20000")  # fewer bytes than the rows, more than the brackets
        out = ranks.group_quantiles(df, "v", [0.5], ["g"])
        assert "SortMergeJoin" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
        assert {r.g: r.q for r in out.collect()} == {None if k == 6 else k: (k + (k + (29_999 - k) // 7 * 7)) / 2 for k in range(7)}
    finally:
        spark.conf.set(limit, before)
