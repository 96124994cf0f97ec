"""Joins of the acquire stage (J1–J8) and their audits.

* J1 ``left_join_dim``       fact ⟕ dimension, dimension broadcast after a size check.
* J2 ``left_join_suffixed``  composite-key left join; colliding right columns get a suffix
                             and (P1) the suffixed duplicate is dropped.
* J3 ``outer_join_series``   N-way full outer join of series on Date, as one pivot.
* J4 ``asof_join``           backward as-of join (exact match allowed), optional ``by`` keys.
* J5 ``join_audit``          left/right/output rows, unmatched left rows, added nulls.
* J6 ``asof_audit``          unmatched = all right columns NULL.
* J7 ``assert_same_rows``    hard row-count invariant.
* J8 ``map_group_stat``      map a per-key statistic back onto rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.operators.chunks import bucket, chunk_bounds, order_key
from shelfspark.operators.common import one_row_concat
from shelfspark.session import cut_lineage

MATCH = "_matched"


def left_join_dim(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``facts ⟕ dim`` on ``keys``; the planner chooses the join by the size in bytes it sees at run time."""
    return facts.join(dim, list(keys), "left")


def left_join_suffixed(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    suffix: str = "_feat",
    drop_suffixed: bool = True,
) -> DataFrame:
    """J2 + P1: composite-key left join; right columns that collide with left
    non-key columns are renamed ``<name><suffix>`` and, by default, dropped."""
    keys = list(keys)
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    r = right.select(*keys, *[F.col(c).alias(c + suffix) if c in clash else F.col(c) for c in right.columns if c not in keys])
    out = left.join(r, keys, "left")
    if drop_suffixed:
        out = out.drop(*[c + suffix for c in clash])
    return out


def outer_join_series(long: DataFrame, series_ids: Sequence[str], date: str = "Date", series: str = "series_id", value: str = "value") -> DataFrame:
    """Equivalent of chaining full outer joins of single-series frames on ``date``.

    One shuffle: pivot with explicit series values.  ``max`` picks the single
    value of a (date, series) cell; NULL cells stay NULL.  Uniqueness of
    (date, series) is what makes this equal to the chained joins — use
    :func:`assert_unique` where the input is not trusted.
    """
    return long.groupBy(date).pivot(series, list(series_ids)).agg(F.max(value))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> None:
    """Raise if ``keys`` repeat in ``df`` (one aggregate, stops at the first duplicate)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {list(keys)} is not unique, e.g. {dup[0].asDict()}")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    check_unique: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """For every left row, the latest right *row* with ``right.on <= left.on``
    (within equal ``by`` keys).  All left rows are kept; left rows before the first
    right row get NULLs; NULL cells of the chosen right row stay NULL.

    Plan (no theta join, no unbounded group in one task):
      1. distinct left keys (map-side combine),
      2. union with right rows, written once and cut into equi-depth chunks of ``on`` (a
         deterministic bucket of the value; a hot ``by`` key spans many chunks),
      3. ``last(row, ignorenulls)`` running inside each (by, chunk); the carry-in for a
         chunk is the last right row of earlier chunks (a table of ≤ P·#by rows),
      4. resolved (key -> right row) written, so that the planner sees its bytes, and
         equi-joined back to ``left``: few keys are broadcast and ``left`` is not shuffled.
    """
    by = list(by)
    if check_unique:
        assert_unique(right, [*by, on], "as-of right side")
    payload = [c for c in right.columns if c not in by and c != on]
    row_type = right.select(F.struct(*payload).alias("_row")).schema["_row"].dataType

    keys = left.select(*by, on).where(F.col(on).isNotNull()).distinct()
    tagged = keys.select(*by, on, F.lit(1).alias("_side"), F.lit(None).cast(row_type).alias("_row")).unionByName(
        right.select(*by, on, F.lit(0).alias("_side"), F.struct(*payload).alias("_row"))
    )
    tagged = cut_lineage(tagged, "asof-keys")
    p = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ltype = tagged.schema[on].dataType
    bounds = chunk_bounds([(tagged, order_key(F.col(on), ltype))], p)
    chunked = tagged.withColumn("_chunk_id", bucket(order_key(F.col(on), ltype), bounds))

    w_in = Window.partitionBy(*by, "_chunk_id").orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, 0)
    inchunk = chunked.withColumn("_hit", F.last("_row", ignorenulls=True).over(w_in))

    last_in_chunk = (
        chunked.where(F.col("_side") == 0)
        .groupBy(*by, "_chunk_id")
        .agg(F.max_by("_row", F.col(on)).alias("_last"))
    )
    chunk_ids = chunked.select(*by, "_chunk_id").distinct()
    carry = chunk_ids.join(last_in_chunk, [*by, "_chunk_id"], "left")
    w_carry = Window.partitionBy(*by).orderBy("_chunk_id").rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(*by, "_chunk_id", F.last("_last", ignorenulls=True).over(w_carry).alias("_carry"))

    resolved = (
        inchunk.where(F.col("_side") == 1)
        .join(carry, [*by, "_chunk_id"], "left")
        .select(*by, on, F.coalesce("_hit", "_carry").alias("_row"))
    )
    resolved = cut_lineage(resolved, "asof-resolved")
    out = left.join(resolved, [*by, on], "left")
    return out.select(*left.columns, *[F.col("_row")[c].alias(c) for c in payload])


def join_audit(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    step: str = "join",
    suffix: str = "_feat",
) -> tuple[DataFrame, DataFrame]:
    """The left join of J2 plus one audit row: left_rows, right_rows, output_rows,
    unmatched_left_rows, rows_with_any_new_nulls and ``nulls_<col>`` per added column.

    A literal marker column on the right side replaces pandas' merge indicator."""
    keys = list(keys)
    added = [c for c in right.columns if c not in keys and c not in left.columns]
    marked = right.withColumn(MATCH, F.lit(True))
    joined = left_join_suffixed(left, marked, keys, suffix)
    any_null = F.lit(False)
    for c in added:
        any_null = any_null | F.col(c).isNull()
    stats = joined.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if(F.col(MATCH).isNull()).alias("unmatched_left_rows"),
        F.count_if(any_null).alias("rows_with_any_new_nulls"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in added],
    )
    audit = one_row_concat(
        stats, left.agg(F.count(F.lit(1)).alias("left_rows")), right.agg(F.count(F.lit(1)).alias("right_rows"))
    )
    audit = audit.select(
        F.lit(step).alias("step"),
        "left_rows",
        "right_rows",
        "output_rows",
        "unmatched_left_rows",
        "rows_with_any_new_nulls",
        *[f"nulls_{c}" for c in added],
    )
    return joined.drop(MATCH), audit


def asof_audit(merged: DataFrame, left_rows: DataFrame | int, right: DataFrame, on: str, step: str = "asof") -> DataFrame:
    """unmatched = all right columns NULL; any-null rows; NULLs per right column.

    ``left_rows`` is the left input (or its row count) for the invariant columns."""
    cols = [c for c in right.columns if c != on]
    all_null = F.lit(True)
    any_null = F.lit(False)
    for c in cols:
        all_null = all_null & F.col(c).isNull()
        any_null = any_null | F.col(c).isNull()
    stats = merged.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if(all_null).alias("unmatched_left_rows"),
        F.count_if(any_null).alias("rows_with_any_new_nulls"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols],
    )
    if isinstance(left_rows, DataFrame):
        lr = left_rows.agg(F.count(F.lit(1)).alias("left_rows"))
    else:
        lr = merged.sparkSession.range(1).select(F.lit(int(left_rows)).cast("long").alias("left_rows"))
    rr = right.agg(F.count(F.lit(1)).alias("right_rows"))
    return one_row_concat(stats, lr, rr).select(
        F.lit(step).alias("step"), "left_rows", "right_rows", "output_rows", "unmatched_left_rows",
        "rows_with_any_new_nulls", *[f"nulls_{c}" for c in cols],
    )


def assert_same_rows(before: DataFrame, after: DataFrame, what: str = "join") -> int:
    """Hard failure when a left join changed the row count."""
    nb, na = before.count(), after.count()
    if nb != na:
        raise AssertionError(f"Row count mismatch after {what}: expected {nb}, got {na}")
    return na


def map_group_stat(df: DataFrame, key: str, stat: Column, name: str) -> DataFrame:
    """Aggregate ``stat`` per ``key`` and map it back onto every row."""
    table = df.where(F.col(key).isNotNull()).groupBy(key).agg(stat.alias(name))
    return df.join(table, key, "left")
