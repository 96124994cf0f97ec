"""Correlation and significance operators.

Pearson r is Spark's mergeable ``corr`` aggregate (pairwise deletion of
NULLs).  Spearman ρ is Pearson r of average ranks, with ranks from the exact
rank table (no global sort in one task).  Test statistics (t, Welch df,
Cohen's d) are aggregate expressions; p-values are computed on the
aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.functions.pvalues import r_pvalue_udf, t_pvalue_udf
from shelfspark.operators.common import present
from shelfspark.operators.ranks import average_ranks, unpivot_numeric

def pearson(df: DataFrame, a: str, b: str) -> Column:
    """Pearson r aggregate of two columns (rows where either is NULL are skipped; NULL where one does not vary)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.covar_pop(x, y) / F.nullif(F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)), F.lit(0.0))


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, spearman_r) of each pair: average ranks of each column's values, on the rows that have both.

    Ranks come from the columns' frequency tables and meet the pairs' joint frequency tables (a hot value is one row in the
    one and as many as it has partners in the other); the table itself is not joined.  NULL where a rank does not vary."""
    columns = sorted({c for p in pairs for c in p})
    long = unpivot_numeric(df, columns).where("value IS NOT NULL")
    ranks = average_ranks(long, "value", ["column"]).select("column", "value", (F.col("avg_rank") - (F.col("n_group") + 1) / 2.0).alias("d"))
    both = F.array(*[
        F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")))
        for a, b in pairs
    ])
    joint = df.select(F.explode(F.array_compact(both)).alias("p")).groupBy("p.a", "p.b", "p.x", "p.y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    for name, value, out in (("a", "x", "da"), ("b", "y", "db")):
        own = ranks.select(F.col("column").alias("_c"), F.col("value").alias("_v"), F.col("d").alias(out))
        joint = joint.join(own, (F.col(name) == F.col("_c")) & (F.col(value) == F.col("_v"))).drop("_c", "_v")
    n, a, b = F.col("n"), F.col("da"), F.col("db")
    sums = joint.groupBy("a", "b").agg(*[F.sum(e).alias(k) for k, e in (("s", n), ("sa", n * a), ("sb", n * b), ("ab", n * a * b), ("aa", n * a * a), ("bb", n * b * b))])
    square = (F.col("s") * F.col("aa") - F.col("sa") * F.col("sa")) * (F.col("s") * F.col("bb") - F.col("sb") * F.col("sb"))
    return sums.select("a", "b", F.when(square > 0, (F.col("s") * F.col("ab") - F.col("sa") * F.col("sb")) / F.sqrt(square)).alias("spearman_r"))


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], spearman: bool = True) -> DataFrame:
    """(a, b, n, pearson_r, spearman_r) for each pair, on the rows given (complete cases
    are the caller's choice, as in Q25)."""
    pairs = list(pairs)
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, n long, pearson_r double, spearman_r double")
    exprs = []
    for i, (a, b) in enumerate(pairs):
        exprs += [F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"n{i}"), pearson(df, a, b).alias(f"p{i}")]
    structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{i}").alias("n"), F.col(f"p{i}").alias("pearson_r")) for i, (a, b) in enumerate(pairs)]
    out = df.agg(*exprs).select(F.explode(F.array(*structs)).alias("r")).select("r.*")
    if not spearman:
        return out.withColumn("spearman_r", F.lit(None).cast("double"))
    return out.join(spearman_pairs(df, pairs), ["a", "b"], "left")


def with_r_pvalue(df: DataFrame, r: str = "pearson_r", n: str = "n", out: str = "p_value") -> DataFrame:
    """Two-sided p of r (Student t with n−2 df), on aggregated rows."""
    return df.withColumn(out, r_pvalue_udf(F.col(r), F.col(n).cast("double")))


def pair_sums(df: DataFrame, columns: Sequence[str], against: Sequence[str] | None = None) -> DataFrame:
    """(a, b, n, r) of every column with every column of ``against`` (default: all), over the rows where both are there.

    One pass for the means, one for the sums: each task adds up matrix products of its Arrow batches (values less the mean,
    NULL as 0, and the masks of what is there) and passes on one row a pair, however many rows it read."""
    cols = list(columns)
    others = cols if against is None else list(against)
    names = list(dict.fromkeys([*cols, *others]))
    if not names:
        return df.sparkSession.createDataFrame([], "a string, b string, n long, r double")
    data = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(names)])
    means = data.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in data.columns]).first()
    centre = np.array([float(m) if np.isfinite(m) else 0.0 for m in means])
    left, right = [names.index(c) for c in cols], [names.index(c) for c in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], axis=1).astype(float) - centre
                there = (~np.isnan(x)).astype(float)
                x = np.where(there > 0, x, 0.0)
                ma, mb, xa, xb = there[:, left], there[:, right], x[:, left], x[:, right]
                sums = np.stack([ma.T @ mb, xa.T @ mb, ma.T @ xb, (xa * xa).T @ mb, ma.T @ (xb * xb), xa.T @ xb])
                total = sums if total is None else total + sums
        if total is not None:
            i, j = (k.ravel() for k in np.indices(total.shape[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(v.ravel()) for v in total]], ["i", "j", "n", "sa", "sb", "saa", "sbb", "sab"])

    rows = data.mapInArrow(run, "i int, j int, n double, sa double, sb double, saa double, sbb double, sab double")
    t = rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    va, vb = F.col("saa") - F.col("sa") * F.col("sa") / n, F.col("sbb") - F.col("sb") * F.col("sb") / n
    # a variance that is nothing but rounding of the squares it is left from counts as none
    spread = (n > 1) & (va > 1e-12 * F.col("saa")) & (vb > 1e-12 * F.col("sbb"))
    r = F.when(spread, (F.col("sab") - F.col("sa") * F.col("sb") / n) / F.sqrt(va * vb))
    every = [(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(others)]  # no rows: n = 0, r NULL
    grid = df.sparkSession.createDataFrame(every, "i int, j int, a string, b string")
    return grid.join(t, ["i", "j"], "left").select(
        "a",
        "b",
        F.coalesce(n, F.lit(0)).cast("long").alias("n"),
        F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], complete_cases: bool = False) -> DataFrame:
    """Long (a, b, r) over every ordered pair incl. the diagonal.  EDA: pairwise deletion; validation:
    ``complete_cases=True``."""
    cols = present(df, columns)
    data = df.select(*cols).na.drop(how="any") if complete_cases else df.select(*cols)
    return pair_sums(data, cols).select("a", "b", "r")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str = C.TARGET) -> DataFrame:
    """C4: r of each column with the target (pairwise deletion)."""
    cols = [c for c in present(df, columns) if c != target]
    return pair_sums(df, cols, [target]).select(F.col("a").alias("feature"), "r")


def top_by_sign(corrs: DataFrame, k: int = 5) -> DataFrame:
    """C4: top-k positive and top-k negative correlations."""
    pos = corrs.where(F.col("r") > 0).orderBy(F.col("r").desc(), "feature").limit(k).withColumn("side", F.lit("positive"))
    neg = corrs.where(F.col("r") < 0).orderBy(F.col("r").asc(), "feature").limit(k).withColumn("side", F.lit("negative"))
    return pos.unionByName(neg)


def top_collinear_pairs(matrix: DataFrame, k: int = 15, threshold: float = 0.7) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold, top-k by |r|."""
    upper = matrix.where(F.col("a") < F.col("b")).where(F.abs("r") > threshold)
    return upper.orderBy(F.abs("r").desc(), "a", "b").limit(k)


def point_biserial(df: DataFrame, columns: Sequence[str], target: str = C.TARGET, min_n: int = 100, top: int | None = 25) -> DataFrame:
    """Point-biserial r (= Pearson vs the 0/1 target) per column with ≥ min_n pairs:
    |r|, direction, p-value; top-k by |r|."""
    cols = [c for c in present(df, columns) if c != target]
    long = pair_sums(df, cols, [target]).select(F.col("a").alias("feature"), "n", "r").where(F.col("n") >= min_n)
    out = long.select(
        "feature", "n", F.abs("r").alias("correlation"), F.when(F.col("r") > 0, "+").otherwise("-").alias("direction"), "r"
    )
    if top:
        out = out.orderBy(F.col("correlation").desc(), "feature").limit(top)
    return with_r_pvalue(out, "r", "n")


def class_moments(df: DataFrame, columns: Sequence[str], target: str = C.TARGET) -> DataFrame:
    """Per column: n, mean, sample variance for class 0 and class 1 — one aggregate by (column, class)."""
    cols = [c for c in present(df, columns) if c != target]
    long = unpivot_numeric(df.where(F.col(target).isin(0, 1)), cols, [target])
    v = F.col("value")
    m = long.groupBy("column", target).agg(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("v"))
    sides = [F.max(F.when(F.col(target) == k, F.col(s))).alias(f"{s}{k}") for k in (0, 1) for s in ("n", "m", "v")]
    return m.groupBy(F.col("column").alias("feature")).agg(*sides)


def welch_t_test(df: DataFrame, columns: Sequence[str], target: str = C.TARGET, min_n: int = 30, top: int | None = 25) -> DataFrame:
    """Welch t (class 0 minus class 1), Welch–Satterthwaite df, p, significant, −log10 p."""
    m = class_moments(df, columns, target).where((F.col("n0") >= min_n) & (F.col("n1") >= min_n))
    se2 = F.col("v0") / F.col("n0") + F.col("v1") / F.col("n1")
    t = F.when(se2 > 0, (F.col("m0") - F.col("m1")) / F.sqrt(se2))
    dof = F.when(
        se2 > 0,
        se2 * se2
        / (F.pow(F.col("v0") / F.col("n0"), 2) / (F.col("n0") - 1) + F.pow(F.col("v1") / F.col("n1"), 2) / (F.col("n1") - 1)),
    )
    out = m.select("feature", t.alias("t_stat"), dof.alias("dof"))
    out = out.withColumn("p_value", t_pvalue_udf(F.col("t_stat"), F.col("dof")))
    out = out.withColumn("significant", F.col("p_value") < 0.05).withColumn(
        "neg_log_p", -F.log10(F.greatest(F.col("p_value"), F.lit(1e-300)))
    )
    if top:
        out = out.orderBy(F.col("neg_log_p").desc(), F.abs("t_stat").desc(), "feature").limit(top)
    return out


def cohens_d(df: DataFrame, columns: Sequence[str], target: str = C.TARGET, min_n: int = 30, top: int | None = 25) -> DataFrame:
    """|(mean1 − mean0) / sqrt((s0² + s1²)/2)| for columns with a positive pooled std."""
    m = class_moments(df, columns, target).where((F.col("n0") >= min_n) & (F.col("n1") >= min_n))
    pooled = F.sqrt((F.col("v0") + F.col("v1")) / 2)
    out = m.where(pooled > 0).select("feature", F.abs((F.col("m1") - F.col("m0")) / pooled).alias("cohens_d"))
    if top:
        out = out.orderBy(F.col("cohens_d").desc(), "feature").limit(top)
    return out


def significance_summary(df: DataFrame, columns: Sequence[str], target: str = C.TARGET, top: int = 10) -> DataFrame:
    """Number of significant features and number tested (Welch, all columns), and the ``top`` features by point-biserial
    r and by Cohen's d: rows (section, feature, value)."""
    t = welch_t_test(df, columns, target, top=None)
    counts = t.agg(F.count_if(F.col("significant")).alias("significant_features"), F.count(F.lit(1)).alias("features_tested"))
    totals = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("section"), F.lit("").alias("feature"), F.col(c).cast("double").alias("value")) for c in counts.columns])).alias("x")).select("x.*")
    by_r = point_biserial(df, columns, target, top=top).select(F.lit("top_correlation").alias("section"), "feature", F.col("correlation").alias("value"))
    by_d = cohens_d(df, columns, target, top=top).select(F.lit("top_cohens_d").alias("section"), "feature", F.col("cohens_d").alias("value"))
    return totals.unionByName(by_r).unionByName(by_d)
