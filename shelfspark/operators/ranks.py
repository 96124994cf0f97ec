"""Exact ranks and quantiles without collecting a group into one task.

Spark's exact ``percentile`` keeps a value->count map per group and merges each group's map in a single task, so a
group holding a third of a 100 TB table would land in one task.

**Quantiles** (:func:`group_quantiles`) are bracketed; brackets by group are written, so that the rows aren't shuffled for few:

1. ``percentile_approx`` (map-side combined) gives each group a low and a high value around each wanted rank.  Its rank
   error is at most n / accuracy; the bracket is twice as wide on either side, and a group of fewer than ``accuracy`` rows
   takes its whole range.
2. Values are counted by group, wanted rank and value; all below the bracket count as one, all above are dropped, so only
   the sliver inside is shuffled, and a hot value is one row.
3. A running sum over the sliver gives the two order statistics.  A rank outside its bracket stops the query: an
   approximation is never returned.

**Ranks of all values** (:func:`rank_table`: Spearman, AUC, exact splits, Q-Q points) come from a frequency table cut
into value chunks:

1. ``groupBy(group, value).count()`` (map-side combine; one hot value is one row),
2. equi-depth chunks of the value order (deterministic bucket of the value), so a hot group spans many chunks,
3. a running sum inside each (group, chunk) piece,
4. per-(group, chunk) totals (at most P·#groups rows, usually P + #groups) turned into offsets,
5. offset + local running sum = number of rows below each value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.chunks import bucket, chunk_bounds, order_key
from shelfspark.session import cut_lineage

CHUNK = "_chunk_id"


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _null_safe_keys(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column | list[str]:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def rank_table(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per distinct (group, value) with ``n`` (its count), ``below`` (rows of the
    group with a smaller value) and ``n_group`` (non-null rows of the group).

    NULL values are excluded (they have no rank); NaN must have been mapped to NULL.
    """
    g = list(groups)
    v = F.col(value)
    p = _partitions(df, partitions)
    key = order_key(v, df.schema[value].dataType)
    bounds = chunk_bounds([(df.where(v.isNotNull()), key)], p)
    freq = df.where(v.isNotNull()).groupBy(*g, value).agg(F.count(F.lit(1)).alias("n"))
    freq = freq.withColumn(CHUNK, bucket(order_key(F.col(value), df.schema[value].dataType), bounds))

    w_local = Window.partitionBy(*g, CHUNK).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = freq.withColumn("_local", F.coalesce(F.sum("n").over(w_local), F.lit(0)))

    chunks = freq.groupBy(*g, CHUNK).agg(F.sum("n").alias("_chunk"))
    w_chunk = Window.partitionBy(*g).orderBy(CHUNK)
    chunks = chunks.select(
        *g,
        CHUNK,
        F.coalesce(F.sum("_chunk").over(w_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_chunk").over(Window.partitionBy(*g)).alias("n_group"),
    )
    chunks = chunks.select(*[F.col(c).alias(f"_of_{c}") for c in [*g, CHUNK]], "_offset", "n_group")
    same = F.lit(True)
    for c in [*g, CHUNK]:  # NULL is a group of its own
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = local.join(chunks, same, "inner")
    return joined.select(
        *g,
        value,
        "n",
        (F.col("_offset") + F.col("_local")).alias("below"),
        "n_group",
    )


def _covers(rank: Column) -> Column:
    return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))


def group_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    groups: Sequence[str] = (),
    method: str = "exact",
    accuracy: int = 10000,
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per group: columns (*groups, p, q).

    ``method='exact'`` picks the order statistics from a bracket (see above);
    ``method='approx'`` uses ``percentile_approx`` (bounded memory sketch).
    A group without a non-null value has no row.
    """
    g = list(groups)
    probs = [float(x) for x in probs]
    if method == "approx":
        arr = F.percentile_approx(F.col(value).cast("double"), probs, accuracy)
        out = df.groupBy(*g).agg(arr.alias("_qs"))
        return out.select(*g, F.posexplode("_qs").alias("_i", "q")).select(
            *g, F.element_at(F.array(*[F.lit(x) for x in probs]), F.col("_i") + 1).alias("p"), "q"
        )
    src = df.select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(g)], F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    keys, v = [f"_g{k}" for k in range(len(g))], F.col("_v")
    margin = 2.0 / accuracy
    edges = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    ranges = src.groupBy(*keys).agg(
        F.count(v).alias("_n"), F.min(v).alias("_min"), F.max(v).alias("_max"), F.percentile_approx(v, edges, accuracy).alias("_e")
    )
    few = F.col("_n") <= accuracy
    wanted = F.array(*[
        F.struct(
            F.lit(p).alias("p"),
            F.when(few, F.col("_min")).otherwise(F.col("_e")[2 * k]).alias("lo"),
            F.when(few, F.col("_max")).otherwise(F.col("_e")[2 * k + 1]).alias("hi"),
        )
        for k, p in enumerate(probs)
    ])
    ranges = ranges.select(*[F.col(c).alias(f"_r{c}") for c in keys], "_n", wanted.alias("_wanted"))
    if g:  # the planner chooses the join by the brackets' bytes, one row a group
        ranges = cut_lineage(ranges, "quantile-brackets")
        cond = None
        for c in keys:
            e = F.col(c).eqNullSafe(F.col(f"_r{c}"))
            cond = e if cond is None else cond & e
        joined = src.join(ranges, cond)
    else:
        joined = src.crossJoin(F.broadcast(ranges))  # one row
    x = joined.select(*keys, "_n", "_v", F.explode("_wanted").alias("_w")).where(v <= F.col("_w.hi"))
    below = F.when(v >= F.col("_w.lo"), v)  # NULL: somewhere below the bracket
    freq = x.groupBy(*keys, F.col("_w.p").alias("p"), "_n", below.alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys, "p").orderBy(v.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = freq.withColumn("below", F.coalesce(F.sum("n").over(order), F.lit(0)))
    pos = F.col("p") * (F.col("_n") - 1)
    agg = placed.where(_covers(F.floor(pos)) | _covers(F.ceil(pos))).groupBy(*keys, "p", "_n").agg(
        F.max(F.when(_covers(F.floor(pos)), v)).alias("_lo"), F.max(F.when(_covers(F.ceil(pos)), v)).alias("_hi")
    )
    missed = F.col("_lo").isNull() | F.col("_hi").isNull()
    lo = F.when(missed, F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")).otherwise(F.col("_lo"))
    return agg.select(*[F.col(k).alias(c) for k, c in zip(keys, g)], "p", (lo + (pos - F.floor(pos)) * (F.col("_hi") - F.col("_lo"))).alias("q"))


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    groups: Sequence[str] = (),
    method: str = "exact",
) -> DataFrame:
    """Quantiles of several columns in one pass: (*groups, column, p, q)."""
    if not groups and method == "exact":
        return _whole_quantiles(df, list(columns), [float(p) for p in probs])
    long = unpivot_numeric(df, columns, list(groups))
    return group_quantiles(long, "value", probs, [*groups, "column"], method=method)


#: Pieces that the values inside a bracket are cut into.
BRACKET_CHUNKS = 256
#: Pieces for the values below a bracket and at its ends.
BELOW, LOW, HIGH = -2, -1, BRACKET_CHUNKS


#: Values of a summary, and summaries that are merged into one of the next level.
SUMMARY, FAN = 8192, 8
#: Share of the ranks by which merged summaries may be wrong: 1 / (2 SUMMARY) a level, of eight at most (10^11 values a task).
MARGIN = 0.0006


class Summary:
    """Ranks of a stream of values, approximately: of each ``FAN`` sorted neighbours the middle one stands for all.

    Holds ``FAN`` arrays of ``SUMMARY`` values a level."""

    def __init__(self) -> None:
        self.raw: list[np.ndarray] = []
        self.count, self.n, self.least, self.most, self.levels = 0, 0, np.nan, np.nan, [[]]

    def add(self, x: np.ndarray) -> None:
        while len(x):
            part, x = np.split(x, [SUMMARY * FAN - self.count])
            self.raw.append(part)
            self.count += len(part)
            if self.count == SUMMARY * FAN:
                self._keep(0, self._sorted()[FAN // 2 :: FAN])

    def _sorted(self) -> np.ndarray:
        x = np.sort(np.concatenate(self.raw))  # NaN is the largest, as in Spark
        self.least, self.most = (np.sort([a, b] if self.n else [b, b])[at] for a, b, at in ((self.least, x[0], 0), (self.most, x[-1], 1)))
        self.n += len(x)
        self.raw, self.count = [], 0
        return x

    def _keep(self, level: int, x: np.ndarray) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(x)
        if len(self.levels[level]) == FAN:
            merged, self.levels[level] = np.sort(np.concatenate(self.levels[level])), []
            self._keep(level + 1, merged[FAN // 2 :: FAN])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Values, ascending, and how many each stands for; at most ``SUMMARY`` values."""
        parts = [(x, float(FAN ** (level + 1))) for level, held in enumerate(self.levels) for x in held]
        if self.count:
            rest = self._sorted()
            stride = -(-len(rest) // SUMMARY)
            some = rest[stride // 2 :: stride]
            parts.append((some, len(rest) / len(some)))
        if not parts:
            return np.zeros(0), np.zeros(0)
        values, weights = np.concatenate([x for x, _ in parts]), np.concatenate([np.full(len(x), w) for x, w in parts])
        order = np.argsort(values, kind="stable")
        values, upto = values[order], np.cumsum(weights[order])
        if len(values) <= SUMMARY:
            return values, weights[order]
        at = np.searchsorted(upto, (np.arange(SUMMARY) + 0.5) * upto[-1] / SUMMARY)
        return values[at], np.full(SUMMARY, upto[-1] / SUMMARY)


def _brackets(src: DataFrame, edges: Sequence[float]) -> dict[int, tuple]:
    """For each column of ``src`` (doubles) with a value, by its number: (values, least, greatest, value at about each edge).

    Tasks return a :class:`Summary` a column; one row a column is collected."""
    width = len(src.columns)
    kinds = pa.schema([("k", pa.int32()), ("n", pa.int64()), ("a", pa.float64()), ("z", pa.float64()), ("x", pa.binary()), ("w", pa.binary())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Summary() for _ in range(width)]
        for batch in batches:
            for k, summary in enumerate(held):
                summary.add(batch.column(k).drop_null().to_numpy())
        for k, summary in enumerate(held):
            x, w = summary.result()
            if len(x):
                yield pa.RecordBatch.from_pylist([{"k": k, "n": summary.n, "a": float(summary.least), "z": float(summary.most), "x": x.tobytes(), "w": w.tobytes()}], kinds)

    def merge(rows: pa.Table) -> pa.Table:
        x, w = (np.concatenate([np.frombuffer(b.as_py()) for b in rows.column(c)]) for c in ("x", "w"))
        least, most = (np.sort(rows.column(c).to_numpy())[at] for c, at in (("a", 0), ("z", -1)))
        order = np.argsort(x, kind="stable")
        upto = np.cumsum(w[order])
        at = np.searchsorted(upto, np.array(edges) * upto[-1]).clip(0, len(x) - 1)
        ends = [float(least if e <= 0 else most if e >= 1 else x[order[i]]) for e, i in zip(edges, at)]
        return pa.table({"k": rows.column("k")[:1], "n": [sum(rows.column("n").to_pylist())], "a": [float(least)], "z": [float(most)], "ends": pa.array([ends], pa.list_(pa.float64()))})

    found = src.mapInArrow(summarise, "k int, n long, a double, z double, x binary, w binary").groupBy("k")
    return {r.k: (r.n, r.a, r.z, r.ends) for r in found.applyInArrow(merge, "k int, n long, a double, z double, ends array<double>").collect()}


def _whole_quantiles(df: DataFrame, columns: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """(column, p, q) over the whole table, without turning rows into cells.

    Merged summaries of the columns give the brackets (one row a column is collected).  A second pass over the columns as arrays counts, by
    column and probability, the values below, at and between the ends of the bracket; only values strictly between the ends
    leave a task, counted by value and cut into ``BRACKET_CHUNKS`` equal pieces of the bracket.  The pieces' sums tell which
    piece holds the rank, and only that one is numbered.  A rank outside its bracket stops the query."""
    edges = [x for p in probs for x in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    names = [f"v{i}" for i in range(len(columns))]
    src = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    found = _brackets(src, edges)
    wanted = []
    for i in sorted(found):
        n, least, most, ends = found[i]
        for k, p in enumerate(probs):
            lo, hi = (least, most) if n <= accuracy else ends[2 * k : 2 * k + 2]
            wanted.append((i, k, columns[i], p, p * (n - 1), lo, hi))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside: dict[tuple, int] = {}
        for batch in batches:
            cells = []
            for i, k, _, _, _, lo, hi in wanted:
                x = batch.column(i).drop_null().to_numpy()
                sides = ((BELOW, lo, int((x < lo).sum())), (LOW, lo, int((x == lo).sum())), (HIGH, hi, int((x == hi).sum()) if hi > lo else 0))
                for chunk, at, times in sides:
                    if times:
                        outside[i, k, chunk, at] = outside.get((i, k, chunk, at), 0) + times
                between, times = np.unique(x[(x > lo) & (x < hi)], return_counts=True)
                if len(between):
                    chunk = np.clip((between / 2 - lo / 2) / (hi / 2 - lo / 2) * BRACKET_CHUNKS, 0, BRACKET_CHUNKS - 1).astype(np.int32)
                    cells.append((np.full(len(between), i, np.int32), np.full(len(between), k, np.int32), chunk, between, times))
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*cells)], ["i", "k", "chunk", "x", "n"])
        rows = [(*key, n) for key, n in outside.items()]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["i", "k", "chunk", "x", "n"])

    freq = src.mapInArrow(run, "i int, k int, chunk int, x double, n long").groupBy("i", "k", "chunk", "x").agg(F.sum("n").alias("n"))
    freq = cut_lineage(freq, "quantile-counts")  # read twice, so that the columns are not
    before = Window.partitionBy("i", "k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = freq.groupBy("i", "k", "chunk").agg(F.sum("n").alias("size")).withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    ranks = df.sparkSession.createDataFrame([w[:5] for w in wanted], "i int, k int, column string, p double, pos double")

    def holds(rank: Column, at: str, size: str) -> Column:
        return (F.col(at) <= rank) & (rank < F.col(at) + F.col(size))

    low, high = F.floor("pos"), F.ceil("pos")
    sums = sums.join(F.broadcast(ranks), ["i", "k"]).where(holds(low, "offset", "size") | holds(high, "offset", "size")).drop("size")
    own = Window.partitionBy("i", "k", "chunk").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    near = freq.join(F.broadcast(sums), ["i", "k", "chunk"])  # at most two pieces for each column and probability
    near = near.withColumn("below", F.col("offset") + F.coalesce(F.sum("n").over(own), F.lit(0)))
    missed = F.raise_error(F.lit("quantile rank outside its bracket")).cast("double")
    value = F.when(F.col("chunk") == BELOW, missed).otherwise(F.col("x"))
    ends = near.groupBy("column", "p", "pos").agg(F.max(F.when(holds(low, "below", "n"), value)).alias("lo"), F.max(F.when(holds(high, "below", "n"), value)).alias("hi"))
    lo = F.when(F.col("lo").isNull() | F.col("hi").isNull(), missed).otherwise(F.col("lo"))
    return ends.select("column", "p", (lo + (F.col("pos") - low) * (F.col("hi") - F.col("lo"))).alias("q"))


def quantiles_wide(
    df: DataFrame,
    columns: Sequence[str],
    probs: dict[str, float],
    groups: Sequence[str] = (),
    method: str = "exact",
) -> DataFrame:
    """One row per (*groups, column) with one column per named probability."""
    names = list(probs)
    q = column_quantiles(df, columns, [probs[n] for n in names], groups, method)
    return q.groupBy(*groups, "column").agg(
        *[F.max(F.when(F.col("p") == float(probs[n]), F.col("q"))).alias(n) for n in names]
    )


def unpivot_numeric(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long (ids..., column, value double) form of numeric columns."""
    cols = list(columns)
    staged = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return staged.unpivot(list(ids), cols, "column", "value")


def average_ranks(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, value, n, avg_rank) with 1-based average ranks for ties."""
    rt = rank_table(df, value, groups)
    return rt.select(*groups, value, "n", "n_group", (F.col("below") + (F.col("n") + 1) / 2.0).alias("avg_rank"))
