"""Profiles and quantiles at size: summaries of columns, moments by arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.functions.moments import sample_excess_kurtosis, sample_skew
from shelfspark.operators import profile, ranks


@pytest.mark.parametrize("kind", ["normal", "hot", "sorted", "few", "nan"])
def test_summary_keeps_ranks_within_the_margin(monkeypatch, kind):
    monkeypatch.setattr(ranks, "SUMMARY", 512)
    rng = np.random.default_rng(2)
    x = rng.normal(size=200_000)
    x = {"normal": x, "hot": np.round(x), "sorted": np.sort(x), "few": x[:300], "nan": np.append(x, np.nan)}[kind]
    summary = ranks.Summary()
    for part in np.array_split(x, 37):
        summary.add(part)
    values, weights = summary.result()
    upto, order = np.cumsum(weights), np.sort(x)
    assert len(values) <= 512 and upto[-1] == pytest.approx(len(x)) and summary.n == len(x)
    assert summary.least == order[0] and (summary.most == order[-1] or kind == "nan" and np.isnan(summary.most))
    for p in np.linspace(0.01, 0.99, 25):
        value = values[min(np.searchsorted(upto, p * upto[-1]), len(values) - 1)]
        below, upto_it = np.searchsorted(order, value), np.searchsorted(order, value, side="right")
        assert below - 0.005 * len(x) - 1 <= p * len(x) <= upto_it + 0.005 * len(x) + 1


def test_whole_quantiles_make_no_sketch_in_the_plan(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SUMMARY", 1024)
    monkeypatch.setattr(ranks, "MARGIN", 0.004)
    rng = np.random.default_rng(4)
    a = rng.exponential(size=30_000)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": np.round(a), "c": -a})).withColumn("none", F.lit(None).cast("double")).repartition(5)
    monkeypatch.setattr(F, "percentile_approx", None)
    found = {(r.column, r.p): r.q for r in ranks.column_quantiles(df, ["a", "b", "c", "none"], [0.0, 0.25, 0.5, 0.999, 1.0]).collect()}
    for c, x in (("a", a), ("b", np.round(a)), ("c", -a)):
        for p in (0.0, 0.25, 0.5, 0.999, 1.0):
            assert found.pop((c, p)) == pytest.approx(np.quantile(x, p))
    assert not found


def test_whole_quantiles_read_the_columns_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(20_000).mapInArrow(read, "id long")
    assert [r.q for r in ranks.column_quantiles(df, ["id"], [0.5]).collect()] == [9999.5]
    assert seen.value == 40_000  # once for the brackets, once for the counts


def test_moments_are_those_of_the_aggregates(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = pd.DataFrame({"a": rng.exponential(size=2000) + 1e3, "same": 0.1, "i": rng.integers(0, 9, 2000)})
    df.loc[::7, "a"] = np.nan
    frame = spark.createDataFrame(df).withColumn("a", F.when(~F.isnan("a"), F.col("a"))).withColumn("none", F.lit(None).cast("double")).repartition(6)
    frame = frame.withColumn("two", F.when(F.col("a") > F.lit(frame.agg(F.percentile("a", 0.999)).first()[0]), F.col("a")))
    cols = ["a", "same", "i", "none", "two"]
    found = {r["column"]: r for r in profile.column_moments(frame, cols).collect()}
    assert set(found) == {"a", "same", "i", "two"}
    for c, r in found.items():
        v = F.col(c).cast("double")
        wanted = frame.agg(F.count(v), F.count(F.lit(1)), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v), sample_skew(v), sample_excess_kurtosis(v)).first()
        assert list(r)[1:] == [w if w is None else pytest.approx(w, rel=1e-9) for w in wanted]
    assert profile.column_moments(frame.limit(0), cols).count() == 0


def test_profile_does_not_turn_rows_into_cells(spark, monkeypatch):
    monkeypatch.setattr(ranks, "unpivot_numeric", None)
    x = np.append(np.arange(100.0), [1e4, -1e4])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "one": 1.0})).withColumn("none", F.lit(None).cast("double"))
    found = {r["column"]: r for r in profile.numeric_profile(df, ["x", "one", "none"]).collect()}
    assert set(found) == {"x", "one"} and found["x"].iqr_outlier_count == 2 and found["one"].iqr_outlier_count == 0
    assert found["x"]["count"] == 102 and found["one"].kurtosis == 0.0 and found["x"].median == np.median(x)
    assert profile.numeric_profile(df.limit(0), ["x", "one"]).count() == 0
