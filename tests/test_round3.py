"""Nearest neighbours, Newton logistic regression, importances, densities, wide quantiles, joint ranks, exact splits."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import correlation, density, forest, joins, logistic, models, neighbours, quality, ranks, sampling


def points(rng, n, dims=3):
    return [(*[rng.choice([0.0, 1.0, rng.gauss(0, 1), rng.gauss(5, 0.1)]) for _ in range(dims)], rng.randint(0, 1)) for _ in range(n)]


@pytest.mark.parametrize("seed,k,pivots,block", [(0, 5, None, 16_384), (1, 3, 7, 4), (2, 1, 1, 3), (3, 50, 4, 16_384)])
def test_nearest_against_all_pairs(spark, seed, k, pivots, block, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", block)
    rng = random.Random(seed)
    train, asked = points(rng, 30 if k == 50 else 200), points(rng, 40)
    train += train[:20] * 3 + [(None, 1.0, 2.0, 1)]
    names = ["a", "b", "c"]
    t, q = (spark.createDataFrame(rows, "a double, b double, c double, y int") for rows in (train, asked + asked[:5]))
    got = {}
    for r in neighbours.nearest(t, q, names, "y", k, pivots).collect():
        got.setdefault((r.a, r.b, r.c), []).extend([(r.distance, r.y if hasattr(r, "y") else r.label)] * r.n)
    for *x, _ in asked:
        pairs = sorted((round(math.sqrt(sum((u - v) ** 2 for u, v in zip(x, row[:3]))), 9), row[3]) for row in train if row[0] is not None)[:k]
        found = sorted(got[tuple(x)])
        assert [label for _, label in found] == [label for _, label in pairs]
        assert [d for d, _ in found] == pytest.approx([d for d, _ in pairs], abs=2e-9)


def test_classify_keeps_rows_and_handles_nothing(spark):
    train = spark.createDataFrame([(0.0, 0), (0.1, 0), (5.0, 1), (5.1, 1), (None, 1)], "x double, y int")
    asked = spark.createDataFrame([("p", 0.05), ("p", 0.05), ("q", 5.2), ("r", None)], "name string, x double")
    out = sorted((r.name, r.x, r.prediction) for r in neighbours.classify(train, asked, ["x"], "y", k=1).collect() if r.x is not None)
    assert out == [("p", 0.05, 0), ("p", 0.05, 0), ("q", 5.2, 1)]
    none = neighbours.classify(train.where("x > 99"), asked, ["x"], "y", k=1)
    assert none.count() == 4 and none.where("prediction IS NOT NULL").count() == 0


def test_newton_equals_the_library(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=800), rng.normal(50, 20, 800), rng.integers(0, 2, 800)])
    y = (rng.random(800) < 1 / (1 + np.exp(-(x[:, 0] - 0.03 * x[:, 1] + 1)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "Sales_Class": y}))
    own = logistic.fit_logistic(df, ["a", "b", "c"])
    other = models.logistic(["a", "b", "c"], 800, max_iter=500).fit(df).stages[-1]
    assert own.steps < 12 and own.gradient < 1e-9
    assert own.coefficients == pytest.approx(list(other.coefficients), abs=1e-4)
    assert own.intercept == pytest.approx(other.intercept, abs=1e-3)
    slopes = [r.gradient for r in logistic.gradient_at(df, own).collect()]
    assert len(slopes) == 4 and max(map(abs, slopes)) < 1e-8
    flat = logistic.fit_logistic(df.withColumn("a", F.lit(3.0)).withColumn("c", F.lit(None).cast("double")), ["a", "b", "c"])
    assert flat.coefficients[0] == 0 and flat.coefficients[2] == 0 and flat.coefficients[1] != 0
    assert logistic.fit_logistic(df.limit(0), ["a"]).coefficients == [0.0]


def test_permuted_columns_and_importances(spark, monkeypatch):
    monkeypatch.setattr(models, "PERMUTED_ROWS", 100)
    rng = random.Random(5)
    rows = [(rng.randint(0, 9), rng.random(), 0) for _ in range(400)]
    rows = [(a, b, int(a > 4)) for a, b, _ in rows]
    df = spark.createDataFrame(rows, "a int, b double, Sales_Class int")
    moved = models.permuted(df, ["a", "b"]).collect()
    assert sorted(r.a__perm for r in moved) == sorted(r[0] for r in rows) and sorted(r.b__perm for r in moved) == sorted(r[1] for r in rows)
    assert sum(r.a != r.a__perm for r in moved) > 200
    model = models.boosted_regressor(["a", "b"], max_iter=3, max_depth=3).fit(df)
    found = {r.feature: r for r in models.permutation_importance(model, df, ["a", "b"]).collect()}
    assert found["a"].importance > 0.5 and abs(found["b"].importance) < 0.05
    assert found["a"].r2 + found["a"].importance == pytest.approx(found["b"].r2 + found["b"].importance)


def test_density_equals_the_direct_sum(spark):
    rng = np.random.default_rng(6)
    x, group = np.append(rng.normal(10, 3, 300), [10.0] * 50), rng.integers(0, 2, 350)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "flat": 1.0, "g": group}))
    out = density.density_curves(df, ["x", "flat"], by="g", points=50).toPandas()
    assert set(out["column"]) == {"x"} and len(out) == 150
    for name, own in (("all", x), ("0", x[group == 0]), ("1", x[group == 1])):
        curve = out[out["group"] == name].sort_values("point")
        h = own.std(ddof=1) * len(own) ** -0.2
        direct = np.exp(-0.5 * ((curve["x"].to_numpy()[:, None] - own) / h) ** 2).sum(1) / (len(own) * h * math.sqrt(2 * math.pi))
        assert np.abs(curve["density"].to_numpy() - direct).max() < 1e-6
    assert density.density_curves(df.limit(0), ["x"], by="g").count() == 0


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_wide_quantiles(spark, accuracy):
    rng = np.random.default_rng(7)
    data = pd.DataFrame({"a": rng.normal(size=3000), "b": rng.integers(0, 3, 3000).astype(float), "c": np.where(rng.random(3000) < 0.5, 7.0, rng.exponential(size=3000)), "d": np.full(3000, np.nan), "e": np.full(3000, 2.5)})
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "a double, b double, c double, d double, e double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    got = {(r.column, r.p): r.q for r in ranks._whole_quantiles(df, list(data), probs, accuracy).collect()}
    assert got == {(c, p): pytest.approx(data[c].quantile(p)) for c in "abce" for p in probs}
    assert ranks._whole_quantiles(df.limit(0), ["a"], probs).count() == 0


def test_spearman_with_nulls_and_ties(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 6, 500).astype(float)
    data = pd.DataFrame({"a": a, "b": a + rng.normal(size=500), "c": np.full(500, 1.0)})
    df = spark.createDataFrame(data)
    got = {(r.a, r.b): r for r in correlation.pair_correlations(df, [("a", "b"), ("b", "a"), ("a", "c")]).collect()}
    assert got["a", "b"].spearman_r == pytest.approx(data["a"].rank().corr(data["b"].rank()))
    assert got["b", "a"].spearman_r == pytest.approx(got["a", "b"].spearman_r) and got["a", "c"].spearman_r is None


def test_full_row_duplicates(spark):
    rows = [(1, None, "x")] * 3 + [(1, None, "y"), (2, 5.0, "x"), (2, 5.0, "x"), (3, 0.0, None)]
    out = quality.check_uniqueness(spark.createDataFrame(rows, "Store int, v double, t string"), key=("Store",), fingerprint=("Store", "v"))
    found = {(r.check.split(" (")[0], r.metric): r.value for r in out.collect()}
    assert found["No exact full-row duplicates", "duplicate_count"] == 3
    assert found["Unique business key", "duplicate_count"] == 4 and found["Unique fingerprint", "duplicate_count"] == 4


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_exact_split_sizes_with_equal_rows(spark, fraction):
    rows = [(i % 3 if i % 3 else None, i) for i in range(400)] + [(7, -1)] * 101 + [(8, 0)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(4)
    out = sampling.split_flag(df, fraction, stratify="g", exact=True).groupBy("g").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert sum(r.n for r in out) == len(rows)
    assert all(r.t == math.floor(r.n * fraction + 0.5) for r in out)
    whole = sampling.split_flag(df, fraction, stratify=None, exact=True)
    assert whole.count() == len(rows) and whole.where("is_test").count() == math.floor(len(rows) * fraction + 0.5)


def test_forest_splits_no_small_node(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "Sales_Class": ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(300) < 0.1)).astype(int)}))
    model = models.random_forest(["a", "b"], num_trees=5, max_depth=12).fit(df)
    whole = forest.BoundedForest(model, ["a", "b"], min_split=1)
    own = [r.p1 for r in whole.score(df).collect()]
    assert own == pytest.approx([r.p1 for r in models.score(model, df, ["a", "b"]).collect()])
    bounded = forest.BoundedForest(model, ["a", "b"], min_split=5)
    assert bounded.rows[bounded.inner].min() >= 5 and whole.rows[whole.inner].min() < 5
    assert bounded.score(df.limit(0)).columns == [*df.columns, "p1", "prediction"]


def test_join_that_multiplies_rows_is_refused(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert joins.assert_same_rows(left, left.join(right.limit(1), "k", "left")) == 2
    with pytest.raises(AssertionError):
        joins.assert_same_rows(left, left.join(right, "k", "left"))


def test_quantile_of_counts_interpolates(spark):
    rng = random.Random(11)
    for n in (1, 2, 7, 40, 333):
        values = [min(rng.randrange(6), rng.randrange(6)) for _ in range(n)]
        counts = [F.lit(values.count(k)).cast("long") for k in range(6)]
        for p in (0.0, 0.5, 0.95, 1.0):
            got = spark.range(1).select(quality._quantile_of_counts(counts, F.lit(n), p).alias("q")).first().q
            assert got == pytest.approx(float(np.quantile(values, p)))
