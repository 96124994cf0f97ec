"""Samples by group and exact splits at size."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from shelfspark.operators import ranks, sampling


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sample_by_group_sorts_only_rows_near_the_end(spark):
    df = spark.range(600).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'x' ELSE 'y' END AS g", "id % 50 AS v").unionByName(
        spark.sql("SELECT -1L AS id, 'z' AS g, 0L AS v FROM range(30)")
    )
    out = sampling.sample_n(df, 20, by="g")
    assert {r.g: r["count"] for r in out.groupBy("g").count().collect()} == {None: 20, "x": 20, "y": 20, "z": 20}
    hashed = df.withColumn("_h", sampling.row_hash(df)).collect()
    for g in (None, "x", "y"):
        least = sorted((r for r in hashed if r.g == g), key=lambda r: r._h)[:20]
        assert {r.id for r in out.where(F.col("g").eqNullSafe(F.lit(g))).collect()} == {r.id for r in least}
    assert "_last" in _plan(out) and out.columns == df.columns


def test_ranks_of_a_null_group(spark):
    out = ranks.rank_table(spark.createDataFrame([(None, 1), (None, 2), ("a", 2), ("a", 2)], "g string, v int"), "v", ["g"])
    assert {(r.g, r.v, r.n, r.below, r.n_group) for r in out.collect()} == {(None, 1, 1, 0, 2), (None, 2, 1, 1, 2), ("a", 2, 2, 0, 2)}


def test_exact_split_does_not_shuffle_the_rows_by_stratum(spark):
    df = spark.range(3000).selectExpr("id", "cast(id % 2 as int) AS g")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16384")  # below the bytes of the rows
    try:
        plan = _plan(sampling.split_flag(df, 0.2, stratify="g", exact=True).where("id < 0"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"hashpartitioning\(coalesce\(g#\d+, 0\), isnull\(g#\d+\), \d+\)", plan)
