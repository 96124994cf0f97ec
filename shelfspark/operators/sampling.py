"""Seeded sampling and splitting.

Row identity is a 64-bit hash of the row's columns (the table has no unique
key); a seeded hash gives a uniform draw per row that is the same on every
partitioning and every retry.  Splits are one narrow pass — no shuffle —
unless ``exact=True`` asks for exact per-stratum counts, which look for the
k-th smallest hash in a bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators.common import one_row_concat
from shelfspark.operators.ranks import rank_table
from shelfspark.session import cut_lineage

SCALE = 1_000_000


def row_hash(df: DataFrame, seed: int = C.SEED, columns: Sequence[str] | None = None) -> Column:
    """Seeded 64-bit hash of the given (default: all) columns."""
    cols = list(columns) if columns is not None else df.columns
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])


def uniform(df: DataFrame, seed: int = C.SEED, columns: Sequence[str] | None = None) -> Column:
    """Deterministic pseudo-uniform draw in [0, 1) per row."""
    return F.pmod(row_hash(df, seed, columns), F.lit(SCALE)) / float(SCALE)


def sample_n(df: DataFrame, n: int, seed: int = C.SEED, by: str | None = None, predicate: Column | None = None) -> DataFrame:
    """At most ``n`` rows (per ``by`` group), chosen by seeded hash order.

    Without ``by``: ``orderBy(hash).limit(n)`` (per-partition top-n, then a merge).
    With ``by``: ``row_number() <= n`` over the hash order.  The n-th hash of each group is found on (group, hash) alone, where
    Spark plans a partial per-group limit before the shuffle; only rows up to it are sorted as a whole."""
    src = df.where(predicate) if predicate is not None else df
    h = row_hash(df, seed)
    if by is None:
        return src.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
    w, place = Window.partitionBy(by).orderBy("_h"), F.row_number()
    least = src.select(by, h.alias("_h")).withColumn("_rn", place.over(w)).where(F.col("_rn") <= n)
    last = cut_lineage(least.groupBy(F.col(by).alias("_group")).agg(F.max("_h").alias("_last")), "sample-ends")
    near = src.withColumn("_h", h).join(last, F.col(by).eqNullSafe(F.col("_group")) & (F.col("_h") <= F.col("_last")))
    return near.withColumn("_rn", place.over(w)).where(F.col("_rn") <= n).select(*df.columns)


def sample_fraction(df: DataFrame, fraction: float, seed: int = C.SEED) -> DataFrame:
    """R2: keep a row when its seeded draw is below ``fraction``."""
    return df.where(uniform(df, seed) < fraction)


def split_flag(
    df: DataFrame,
    test_fraction: float = C.TEST_FRACTION,
    seed: int = C.SEED,
    stratify: str | None = C.TARGET,
    exact: bool = False,
    out: str = "is_test",
    key_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add a boolean ``out``; every row lands in exactly one side.

    Hash threshold (default): class shares are preserved within sampling error.
    ``exact=True``: per stratum, the ``round(test_fraction · n)`` rows with the
    smallest hashes are test rows — exact counts, by the k-th smallest hash of each stratum.  Equal rows share a hash; where the count
    falls among them, they are numbered by (partition of a written table, place in it)."""
    h = row_hash(df, seed, key_columns)
    if not exact:
        return df.withColumn(out, (F.pmod(h, F.lit(SCALE)) / float(SCALE)) < test_fraction)
    groups = [stratify] if stratify else []
    staged = df.withColumn("_h", h)
    limits = cut_lineage(_kth_hash(staged, groups, test_fraction), "split-limits")  # a row a stratum, whose bytes the planner sees
    same = F.lit(True)
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    side = F.when(F.col("_limit").isNull() | (F.col("_h") < F.col("_limit")), True).when((F.col("_h") > F.col("_limit")) | (F.col("_take") == 0), False)
    joined = staged.join(limits, same) if groups else one_row_concat(staged, F.broadcast(limits.groupBy().agg(F.max("_limit").alias("_limit"), F.max("_take").alias("_take"))))
    joined = joined.select(*df.columns, side.alias(out), "_take")
    # rows of one hash per stratum that fall on both sides: identical, so any of them will do
    split = cut_lineage(joined.where(F.col(out).isNull()), "split-ties").withColumn("_part", F.spark_partition_id())
    strata = [F.col(c) for c in groups]
    sizes = split.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(*strata).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*[F.col(c).alias(f"_s_{c}") for c in groups], F.col("_part").alias("_s_part"), before.alias("_before"))
    at = F.col("_part") == F.col("_s_part")
    for c in groups:
        at = at & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    place = F.row_number().over(Window.partitionBy(*strata, "_part").orderBy("_take"))
    numbered = split.withColumn("_place", place).join(sizes, at)
    chosen = numbered.withColumn(out, F.col("_before") + F.col("_place") <= F.col("_take"))
    return joined.where(F.col(out).isNotNull()).select(*df.columns, out).unionByName(chosen.select(*df.columns, out))


def _kth_hash(staged: DataFrame, groups: Sequence[str], fraction: float, accuracy: int = 10000) -> DataFrame:
    """One row a stratum: ``_limit``, the hash at which its first ``round(fraction · n)`` rows by hash end (NULL: all rows are
    among them), and ``_take``, how many rows of that hash are.

    An approximate percentile brackets the hash; rows below the bracket are counted, only those inside are ranked.  A rank
    outside its bracket stops the query."""
    h, keys = F.col("_h"), [f"_r_{c}" for c in groups]
    strata = staged.select(*[F.col(c).alias(k) for c, k in zip(groups, keys)], "_h")
    margin = 2.0 / accuracy
    edges = [max(fraction - margin, 0.0), min(fraction + margin, 1.0)]
    stats = strata.groupBy(*keys).agg(F.count(h).alias("_n"), F.min(h).alias("_min"), F.max(h).alias("_max"), F.percentile_approx(h, edges, accuracy).alias("_e"))
    few = F.col("_n") <= accuracy
    stats = stats.select(*[F.col(k).alias(f"{k}s") for k in keys], F.round(F.col("_n") * fraction).cast("long").alias("_k"), "_n", F.when(few, F.col("_min")).otherwise(F.col("_e")[0]).alias("_lo"), F.when(few, F.col("_max")).otherwise(F.col("_e")[1]).alias("_hi"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}s"))
    stats = cut_lineage(stats, "split-brackets")
    near = strata.join(stats, same) if keys else one_row_concat(strata, F.broadcast(stats.groupBy().agg(*[F.max(c).alias(c) for c in stats.columns])))
    below = near.groupBy(*[f"{k}s" for k in keys]).agg(F.count_if(h < F.col("_lo")).alias("_below"))
    inside = rank_table(near.where((h >= F.col("_lo")) & (h <= F.col("_hi"))).select(*keys, "_h"), "_h", keys)
    inside = inside.select(*keys, "_h", F.col("n").alias("_rows"), F.col("below").alias("_inner"))

    def matched(left: DataFrame, right: DataFrame, suffix: str) -> DataFrame:
        if not keys:
            return one_row_concat(left, F.broadcast(right.groupBy().agg(*[F.max(c).alias(c) for c in right.columns])))
        cond = F.lit(True)
        for k in keys:
            cond = cond & left[k if k in left.columns else f"{k}s"].eqNullSafe(right[f"{k}{suffix}"])
        return left.join(right, cond)

    counts = matched(stats, below.select(*[F.col(f"{k}s").alias(f"{k}b") for k in keys], "_below"), "b")
    first = F.col("_below") + F.col("_inner")
    found = matched(inside, counts, "s").where((first <= F.col("_k")) & (F.col("_k") < first + F.col("_rows")))
    found = found.select(*[F.col(f"{k}s").alias(f"{k}f") for k in keys], h.alias("_limit"), (F.col("_k") - first).alias("_take"))
    if not keys:
        out = one_row_concat(counts, F.broadcast(found.agg(F.max("_limit").alias("_limit"), F.max("_take").alias("_take"))))
    else:
        cond = F.lit(True)
        for k in keys:
            cond = cond & counts[f"{k}s"].eqNullSafe(found[f"{k}f"])
        out = counts.join(found, cond, "left")
    missed = F.raise_error(F.lit("split rank outside its bracket")).cast("long")
    take = F.when(F.col("_limit").isNotNull(), F.col("_take")).when(F.col("_k") >= F.col("_n"), F.lit(0).cast("long")).otherwise(missed)
    return out.select(*[F.col(f"{k}s").alias(k) for k in keys], "_limit", take.alias("_take"))


def stratified_split(df: DataFrame, test_fraction: float = C.TEST_FRACTION, seed: int = C.SEED, stratify: str | None = C.TARGET, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames from one flagged plan."""
    flagged = split_flag(df, test_fraction, seed, stratify, exact)
    return flagged.where(~F.col("is_test")).drop("is_test"), flagged.where(F.col("is_test")).drop("is_test")


def split_report(flagged: DataFrame, target: str = C.TARGET, flag: str = "is_test") -> DataFrame:
    """Rows per side and class share within each side (rounded to 4 places)."""
    counts = flagged.groupBy(flag, target).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy(flag)
    return counts.select(
        F.when(F.col(flag), "test").otherwise("train").alias("split"),
        target,
        "rows",
        F.round(F.col("rows") / F.sum("rows").over(w), 4).alias("share"),
        F.sum("rows").over(w).alias("split_rows"),
    )
