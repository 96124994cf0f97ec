"""Column profiles and descriptive statistics.

Numeric profiles go over the columns as arrays: a task returns one row of
moments a column, quartiles are exact for all columns together, and values
beyond their fences are counted in one wide aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.moments import shape_label
from shelfspark.operators.common import numeric_columns, one_row_concat, pct, present
from shelfspark.operators.ranks import group_quantiles, quantiles_wide, rank_table
from shelfspark.session import cut_lineage


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, _rows, mean, std (n−1), min, max, skewness, kurtosis) of numeric columns; skewness and excess kurtosis are
    bias-corrected as in :mod:`moments`.  Columns without a value have no row."""
    cols = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(cols)])

    def merged(a: tuple, b: tuple) -> tuple:
        """Two pieces' (n, mean, sums of the 2nd to 4th powers of distances from it, least, greatest) as one."""
        (na, ma, a2, a3, a4, la, ga), (nb, mb, b2, b3, b4, lb, gb) = a, b
        n, d = na + nb, mb - ma
        m2 = a2 + b2 + d * d * na * nb / n
        m3 = a3 + b3 + d**3 * na * nb * (na - nb) / n**2 + 3 * d * (na * b2 - nb * a2) / n
        m4 = a4 + b4 + d**4 * na * nb * (na * na - na * nb + nb * nb) / n**3 + 6 * d * d * (na * na * b2 + nb * nb * a2) / n**2 + 4 * d * (na * b3 - nb * a3) / n
        return n, ma + d * nb / n, m2, m3, m4, np.fmin(la, lb), np.maximum(ga, gb)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple | None] = [None] * len(cols)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for k in range(len(cols)):
                x = batch.column(k).drop_null().to_numpy()
                if not len(x):
                    continue
                least, most = float(np.fmin.reduce(x)), float(x.max())
                mean = least if least == most else float(x.mean())
                d = x - mean
                square = d * d
                new = (float(len(x)), mean, float(square.sum()), float(square @ d), float(square @ square), least, most)
                held[k] = new if held[k] is None else merged(held[k], new)
        for k, values in enumerate(held):
            if rows:
                yield pa.RecordBatch.from_pylist([{"k": k, "rows": rows, "values": values and list(map(float, values))}], kinds)

    def whole(table: pa.Table) -> pa.Table:
        values = None
        for piece in table.column("values").to_pylist():
            if piece is not None:
                values = tuple(piece) if values is None else merged(values, tuple(piece))
        if values is None:
            return out_kinds.empty_table()
        n, mean, m2, m3, m4, least, most = map(float, values)
        with np.errstate(all="ignore"):
            g1, g2 = np.sqrt(n) * m3 / np.sqrt(np.float64(m2) ** 3), n * m4 / np.float64(m2) ** 2 - 3
        skew = None if n < 3 else 0.0 if m2 == 0 else float(g1 * np.sqrt(n * (n - 1)) / (n - 2))
        kurtosis = None if n < 4 else 0.0 if m2 == 0 else float((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
        row = (cols[table.column("k")[0].as_py()], int(n), sum(table.column("rows").to_pylist()), mean, float(np.sqrt(m2 / (n - 1))) if n > 1 else None, least, most, skew, kurtosis)
        return pa.Table.from_pylist([dict(zip(out_kinds.names, row))], out_kinds)

    kinds = pa.schema([("k", pa.int32()), ("rows", pa.int64()), ("values", pa.list_(pa.float64()))])
    doubles = ["mean", "std", "min", "max", "skewness", "kurtosis"]
    out_kinds = pa.schema([("column", pa.string()), ("count", pa.int64()), ("_rows", pa.int64()), *[(c, pa.float64()) for c in doubles]])
    found = numbers.mapInArrow(run, "k int, rows long, values array<double>").groupBy("k")
    return found.applyInArrow(whole, "column string, count long, _rows long, " + ", ".join(f"{c} double" for c in doubles))


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """Per column count, null_pct, mean, median, std (n−1), min, max, q1, q3,
    bias-corrected skew and excess kurtosis, shape label, IQR outlier count and pct."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    cols = present(df, cols)
    stats = column_moments(df, cols)
    q = quantiles_wide(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, method=method)
    prof = cut_lineage(stats.join(q, "column", "left"), "profile")  # one row a column
    fences = {r["column"]: (r.q1 - 1.5 * (r.q3 - r.q1), r.q3 + 1.5 * (r.q3 - r.q1)) for r in prof.where("q1 IS NOT NULL").collect()}
    beyond = [F.count_if((F.col(c).cast("double") < fences[c][0]) | (F.col(c).cast("double") > fences[c][1])) for c in fences]
    names = F.array(*[F.lit(c) for c in fences]).cast("array<string>")
    counts = df.agg(F.array(*beyond).cast("array<long>").alias("_beyond")).select(F.explode(F.arrays_zip(names.alias("column"), F.col("_beyond").alias("iqr_outlier_count"))).alias("_o"))
    outl = counts.select("_o.column", "_o.iqr_outlier_count")
    out = prof.join(outl, "column", "left")
    return out.select(
        "column",
        "count",
        pct(F.col("_rows") - F.col("count"), F.col("_rows")).alias("null_pct"),
        "mean",
        "median",
        "std",
        "min",
        "max",
        "q1",
        "q3",
        "skewness",
        "kurtosis",
        shape_label(F.col("skewness")).alias("distribution_shape"),
        "iqr_outlier_count",
        pct(F.col("iqr_outlier_count"), F.col("count")).alias("iqr_outlier_pct"),
    ).where(F.col("count") > 0)


def categorical_profile(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Top-k values (NULL included, count desc then value asc), unique non-null count,
    dominant pct and balance flag on every row."""
    vc = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    totals = vc.agg(F.sum("count").alias("_total"), F.count("value").alias("unique_values"), F.max("count").alias("_top"))
    order = [F.col("count").desc(), F.col("value").asc_nulls_first()]
    first = vc.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most ``top`` rows
    dom = pct(F.col("_top"), F.col("_total"))
    return one_row_concat(first, F.broadcast(totals)).select(
        F.lit(column).alias("column"),
        "value",
        "count",
        "rank",
        "unique_values",
        dom.alias("dominant_value_pct"),
        F.when(dom > 70, "highly_imbalanced").when(dom > 50, "imbalanced").otherwise("balanced").alias("balance_flag"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None, density: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), optionally per class."""
    mm = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    j = one_row_concat(df.where(F.col(column).isNotNull()), F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col(column) - F.col("_lo")) / width).cast("int") + 1, F.lit(bins))
    )
    keys = ([by] if by else []) + ["bin"]
    h = j.withColumn("bin", b).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    w = (F.col("_hi") - F.col("_lo")) / bins
    out = h.select(
        *keys,
        (F.col("_lo") + (F.col("bin") - 1) * w).alias("bin_start"),
        (F.col("_lo") + F.col("bin") * w).alias("bin_end"),
        "count",
    )
    if density:
        tot = Window.partitionBy(*([by] if by else []))
        out = out.withColumn("density", F.col("count") / (F.sum("count").over(tot) * F.when(w > 0, w).otherwise(F.lit(1.0))))
    return out


def box_summary(df: DataFrame, value: str, group: str, method: str = "exact") -> DataFrame:
    """Per group q1, median, q3, Tukey whiskers (extreme points inside the fences) and
    the number of points outside them."""
    q = group_quantiles(df.where(F.col(group).isNotNull()), value, [0.25, 0.5, 0.75], [group], method=method)
    qw = q.groupBy(group).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    qw = qw.withColumn("_lb", F.col("q1") - 1.5 * iqr).withColumn("_ub", F.col("q3") + 1.5 * iqr)
    j = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).join(qw, group)
    x = F.col(value)
    inside = (x >= F.col("_lb")) & (x <= F.col("_ub"))
    agg = j.groupBy(group).agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return qw.join(agg, group).select(group, "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")


def qq_points(df: DataFrame, value: str, block: int = 1 << 16) -> DataFrame:
    """Normal Q–Q points with Filliben plotting positions and the least-squares line.

    Order statistics come from the rank table (no global sort in one task).  A value that occurs many times is cut into
    blocks of ``block`` positions, which are dealt out before they become points, so neither one array nor one task holds
    its copies.  The points are written once; the line is an aggregate over the written table."""
    rt = rank_table(df, value)
    blocks = rt.select(value, "below", "n", F.col("n_group").alias("_all"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block))).alias("_b"))
    first = F.col("below") + 1 + F.col("_b") * block
    last = F.least(F.col("below") + F.col("n"), first + block - 1)
    dealt = blocks.select(value, "_all", first.alias("_first"), last.alias("_last")).repartition("_first")
    x = dealt.select(value, "_all", F.explode(F.sequence("_first", "_last")).alias("i"))
    m = F.when(F.col("i") == 1, 1 - F.pow(F.lit(0.5), 1.0 / F.col("_all"))).when(
        F.col("i") == F.col("_all"), F.pow(F.lit(0.5), 1.0 / F.col("_all"))
    ).otherwise((F.col("i") - 0.3175) / (F.col("_all") + 0.365))
    pts = cut_lineage(x.select("i", _inv_norm(m).alias("theoretical"), F.col(value).alias("ordered")), "qq-points")
    line = pts.agg(F.regr_slope("ordered", "theoretical").alias("slope"), F.regr_intercept("ordered", "theoretical").alias("intercept"))
    return one_row_concat(pts, F.broadcast(line))


def _inv_norm(p):
    """Acklam's rational approximation of the standard normal quantile (|error| < 1.2e-9)."""
    a = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
    b = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00]
    lo = 0.02425
    q = F.sqrt(-2 * F.log(p))
    tail = (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    r = (p - 0.5) * (p - 0.5)
    mid = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * (p - 0.5) / (
        ((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1
    )
    qh = F.sqrt(-2 * F.log(1 - p))
    upper = -(((((c[0] * qh + c[1]) * qh + c[2]) * qh + c[3]) * qh + c[4]) * qh + c[5]) / ((((d[0] * qh + d[1]) * qh + d[2]) * qh + d[3]) * qh + 1)
    return F.when(p < lo, tail).when(p > 1 - lo, upper).otherwise(mid)


def missing_summary(df: DataFrame, top: int | None = None) -> DataFrame:
    """Count and pct of NULLs per column that has any; ordered by pct (top-k optional)."""
    cols = df.columns
    w = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = w.unpivot(["_n"], cols, "column", "missing_count")
    out = long.where(F.col("missing_count") > 0).select(
        "column", "missing_count", F.when(F.col("_n") > 0, F.round(F.col("missing_count") * 100.0 / F.col("_n"), 2)).alias("missing_pct")
    )
    if top:
        out = out.orderBy(F.col("missing_pct").desc(), "column").limit(top)
    return out


def schema_snapshot(df: DataFrame) -> DataFrame:
    """(column, type) rows."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, type string")


def dataset_summary(df: DataFrame, target: str = "Sales_Class", date: str = "Date") -> DataFrame:
    """Rows, columns, date range, class counts and balance ratio."""
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date).alias("date_start"),
        F.max(date).alias("date_end"),
        F.count_if(F.col(target) == 1).alias("high_count"),
        F.count_if(F.col(target) == 0).alias("low_count"),
    )
    return agg.select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        "date_start",
        "date_end",
        "high_count",
        "low_count",
        F.round(F.greatest("high_count", "low_count") / F.least("high_count", "low_count"), 4).alias("balance_ratio"),
    )


def head(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows in an explicit key order."""
    return df.orderBy(*keys).limit(n)


def completeness_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, null cells, completeness %."""
    cols = df.columns
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    w = df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("null_cells"))
    cells = F.col("rows") * len(cols)
    return w.select(
        "rows",
        F.lit(len(cols)).alias("columns"),
        "null_cells",
        F.when(cells > 0, F.round(100 * (1 - F.col("null_cells") / cells), 2)).otherwise(F.lit(100.0)).alias("completeness_pct"),
    )


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added and removed by a stage."""
    b, a = set(before.columns), set(after.columns)
    rows = [(c, "added") for c in sorted(a - b)] + [(c, "removed") for c in sorted(b - a)]
    return before.sparkSession.createDataFrame(rows, "column string, change string")


def binary_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column, whether every value is 0 or 1 (a NULL makes it non-binary)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    w = df.agg(*[F.coalesce(F.bool_and(F.col(c).isNotNull() & F.col(c).isin(0, 1)), F.lit(True)).alias(c) for c in cols])
    return w.unpivot([], cols, "column", "is_binary")


def tail_ratio(profile: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Max / q3 per column, flagged when above ``threshold``."""
    ratio = F.when(F.col("q3") != 0, F.col("max") / F.col("q3"))
    return profile.select("column", ratio.alias("tail_ratio"), (ratio > threshold).alias("heavy_tail"))


def scaled_statistics(profile: DataFrame) -> DataFrame:
    """(min, q1, median, mean, q3, max) of each column scaled to 0–1 within the column."""
    stats = ["min", "q1", "median", "mean", "q3", "max"]
    rng = F.col("max") - F.col("min")
    return profile.select(
        "column", *[F.when(rng != 0, (F.col(s) - F.col("min")) / rng).otherwise(F.lit(0.0)).alias(s) for s in stats]
    )
