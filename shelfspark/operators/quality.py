"""Data-quality checks as check rows (Q1–Q29).

Each dimension is computed from fused aggregates over the table — one wide
``agg`` for all scalar checks of a dimension, one exact-quantile pass where
quartiles or medians are needed, one shuffle per duplicate check — then
unpivoted into long rows::

    dimension, check, column, status, metric, value (double), text (string)

so every check has a fixed schema whatever its metrics.  Status rules: PASS /
FAIL / WARN / SKIP; a dimension fails if any check fails, warns if any warns;
the overall status is the same roll-up over dimensions (Q29).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from shelfspark import config as C
from shelfspark.functions.moments import sample_skew
from shelfspark.operators.common import fixed_round, one_row_concat, pct, present
from shelfspark.operators.ranks import quantiles_wide
from shelfspark.session import cut_lineage

ROW_SCHEMA = "dimension string, check string, column string, status string, metric string, value double, text string"


def _row(check: str, column: str | None, status: Column, metric: str, value: Column | None = None, text: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        status.cast("string").alias("status"),
        F.lit(metric).alias("metric"),
        (value if value is not None else F.lit(None)).cast("double").alias("value"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
    )


def _emit(wide: DataFrame, dimension: str, rows: list[Column]) -> DataFrame:
    """Unpivot the one-row metrics aggregate into check rows.

    The aggregate (all scans, shuffles and quantiles of the dimension) runs as one
    job; its single metrics row is then the input of the check-row projection, so
    the optimizer never has to push dozens of status expressions through the
    aggregate's plan."""
    if not rows:
        return wide.sparkSession.createDataFrame([], ROW_SCHEMA)
    return _local(wide).select(F.explode(F.array(*rows)).alias("r")).select(F.lit(dimension).alias("dimension"), "r.*")


def _local(one_row: DataFrame) -> DataFrame:
    """Run a one-row aggregate and keep its metrics row as a local relation."""
    return one_row.sparkSession.createDataFrame(one_row.collect(), one_row.schema).limit(1)


def _quantile_of_counts(counts: Sequence[Column], n: Column, p: float) -> Column:
    """The interpolated quantile of ``n`` whole numbers, ``counts[k]`` of which are k."""
    until = F.transform(F.sequence(F.lit(1), F.lit(len(counts))), lambda k: F.aggregate(F.slice(F.array(*counts), 1, k), F.lit(0).cast("long"), lambda x, y: x + y))
    place = F.lit(p) * (n - 1)

    def value(rank: Column) -> Column:
        return F.size(F.filter(until, lambda u: u <= rank))

    low, high = value(F.floor(place)), value(F.ceil(place))
    return low + (high - low) * (place - F.floor(place))


def smallest_distinct(df: DataFrame, values: dict[str, Column], k: int) -> DataFrame:
    """One row: for each name the array of its ``k`` smallest distinct non-null values.

    The values are made distinct by (name, value) before anything is gathered, and each task passes on at most ``k`` a name,
    so no task holds the set of all bad values."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in values.items()]))
    pairs = df.select(each.alias("x")).select("x.*").where("value IS NOT NULL").groupBy("name", "value").agg(F.lit(1).alias("one"))
    place = F.row_number().over(Window.partitionBy("name").orderBy("value"))
    few = pairs.withColumn("place", place).where(F.col("place") <= k)
    return few.agg(*[F.sort_array(F.collect_list(F.when(F.col("name") == n, F.col("value")))).alias(n) for n in values])


def _pf(cond: Column) -> Column:
    return F.when(cond, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], ROW_SCHEMA)


# --- 1 accuracy (Q1–Q6) ----------------------------------------------------------------
def check_accuracy(
    df: DataFrame,
    ranges: dict = C.VALUE_RANGES,
    types: Sequence[str] = C.STORE_TYPES,
    date_range: tuple[str, str] = C.DATE_RANGE,
    today: dt.date | None = None,
) -> DataFrame:
    today = today or dt.date.today()
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    samples: dict[str, Column] = {}
    cols = [c for c in ranges if c in df.columns]
    for c in cols:
        lo, hi = ranges[c]
        aggs += [F.count(c).alias(f"{c}__nn"), F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"{c}__viol")]
    has = set(df.columns)
    if "Type" in has:
        t = F.trim(F.col("Type").cast("string"))
        bad = t.isNotNull() & ~t.isin(list(types))
        aggs.append(F.count_if(bad).alias("Type__viol"))
        samples["Type__sample"] = F.when(bad, t)
    if "IsHoliday" in has:
        aggs.append(_non_boolean_distinct("IsHoliday", df).alias("IsHoliday__viol"))
    if "Date" in has:
        d = F.col("Date")
        lo, hi = (F.lit(x).cast("date") for x in date_range)
        aggs += [
            F.count_if((d < lo) | (d > hi)).alias("Date__out"),
            F.count_if(d > F.lit(today)).alias("Date__future"),
            F.min(d).cast("string").alias("Date__min"),
            F.max(d).cast("string").alias("Date__max"),
        ]
    if C.TARGET in has:
        y = F.col(C.TARGET)
        aggs.append(F.count_if(y.isNull()).alias("T__nulls"))
        samples["T__invalid"] = F.when(~y.isin(0, 1), y.cast("string"))
    if "Weekly_Sales" in has:
        aggs += [F.count_if(F.col("Weekly_Sales") < 0).alias("WS__neg"), F.min("Weekly_Sales").alias("WS__min")]
    w = df.agg(*aggs)
    if samples:
        joined = [F.array_join(F.col(c), ",").alias(c) for c in samples]
        w = one_row_concat(w, smallest_distinct(df, samples, 10).select(*joined))
    n = F.col("_n")
    rows: list[Column] = []
    for c in cols:
        lo, hi = ranges[c]
        name = f"{c} in [{lo}, {hi}]"
        p = pct(F.col(f"{c}__viol"), F.col(f"{c}__nn"))
        st = _pf(p <= 1.0)
        rows += [_row(name, c, st, "violations", F.col(f"{c}__viol")), _row(name, c, st, "violation_pct", p)]
    if "Type" in has:
        st = _pf(F.col("Type__viol") == 0)
        name = "Type in {" + ", ".join(types) + "}"
        rows += [_row(name, "Type", st, "violations", F.col("Type__viol"), F.col("Type__sample"))]
    if "IsHoliday" in has:
        rows += [_row("IsHoliday in {True, False}", "IsHoliday", _pf(F.col("IsHoliday__viol") == 0), "violations", F.col("IsHoliday__viol"))]
    if "Date" in has:
        name = f"Date within [{date_range[0]}, {date_range[1]}]"
        st = _pf((F.col("Date__out") == 0) & (F.col("Date__future") == 0))
        rows += [
            _row(name, "Date", st, "out_of_range_rows", F.col("Date__out"), F.col("Date__min")),
            _row(name, "Date", st, "future_date_rows", F.col("Date__future"), F.col("Date__max")),
        ]
    if C.TARGET in has:
        st = _pf((F.col("T__nulls") == 0) & (F.col("T__invalid") == ""))
        rows += [_row(f"{C.TARGET} values in {{0, 1}}", C.TARGET, st, "null_count", F.col("T__nulls"), F.col("T__invalid"))]
    if "Weekly_Sales" in has:
        st = F.when(F.col("WS__neg") > 0, "WARN").otherwise("PASS")
        name = "Negative Weekly_Sales inspection"
        rows += [
            _row(name, "Weekly_Sales", st, "negative_rows", F.col("WS__neg")),
            _row(name, "Weekly_Sales", st, "pct_negative", pct(F.col("WS__neg"), n)),
            _row(name, "Weekly_Sales", st, "min_value", F.col("WS__min")),
        ]
    return _emit(w, "Accuracy", rows)


def _non_boolean_distinct(col: str, df: DataFrame) -> Column:
    """Q3: number of distinct non-null values that are not booleans (0 for a boolean column)."""
    if isinstance(df.schema[col].dataType, T.BooleanType):
        return F.lit(0).cast("long")
    c = F.col(col).cast("string")
    return F.count_distinct(F.when(c.isNotNull() & F.lower(c).isin("true", "false").__invert__(), c))


def _non_boolean_rows(col: str, df: DataFrame) -> Column:
    """Q17: rows whose non-null value is not a boolean."""
    if isinstance(df.schema[col].dataType, T.BooleanType):
        return F.lit(0).cast("long")
    c = F.col(col).cast("string")
    return F.count_if(c.isNotNull() & ~F.lower(c).isin("true", "false"))


# --- 2 completeness (Q7–Q12) --------------------------------------------------------------
def _criticality(max_null: float) -> str:
    """The name of the first level of the table whose bound the threshold does not exceed."""
    return next(name for bound, name in C.CRITICALITY_LEVELS if max_null <= bound)


def row_missing_counts(df: DataFrame) -> Column:
    """Per-row number of NULL cells over all columns."""
    return sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))


def check_completeness(
    df: DataFrame,
    required: Sequence[str] = C.REQUIRED_COLUMNS,
    thresholds: dict = C.NULL_THRESHOLDS_PCT,
    min_rows: int = C.MIN_ROWS,
    series: Sequence[str] = C.SERIES_COLUMNS,
) -> DataFrame:
    cols = list(df.columns)
    ncols = len(cols)
    m = row_missing_counts(df)
    staged = df.withColumn("_miss", m)
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_miss") > 0).alias("_rows_any"),
        F.max("_miss").alias("_max_miss"),
        F.count_if(F.col("_miss") * 100.0 / ncols >= C.SEVERE_ROW_MISSING_PCT).alias("_severe_rows"),
    ] + [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols]
    for c in series:
        if c in cols:
            aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    # rows by their number of missing cells: at most one count a column, in the same pass; p95 is read off them
    aggs += [F.count_if(F.col("_miss") == k).alias(f"_miss_{k}") for k in range(ncols + 1)]
    w = _local(staged.agg(*aggs))
    w = w.withColumn("p95", F.when(F.col("_n") > 0, _quantile_of_counts([F.col(f"_miss_{k}") for k in range(ncols + 1)], F.col("_n"), 0.95)))
    n = F.col("_n")
    # derived metrics become columns of the one-row frame once, so the check rows
    # below reference plain columns instead of re-inlining these expressions
    derived = {}
    for c in cols:
        derived[f"{c}__npct"] = pct(F.col(f"{c}__nulls"), n)
        derived[f"{c}__pct2"] = F.when(n > 0, fixed_round(F.col(f"{c}__nulls") * 100.0 / n, 2)).otherwise(F.lit(0.0))
    w = w.withColumns(derived)
    sev = [F.col(f"{c}__pct2") >= C.SEVERE_COLUMN_MISSING_PCT for c in cols]
    ok = F.lit(True)
    for c in series:
        ok = ok & (F.col(f"{c}__pct2") < 5) if c in cols else F.lit(False)
    w = w.withColumns(
        {
            "_sev_n": sum((x.cast("int") for x in sev), F.lit(0)),
            "_sev_names": F.concat_ws(",", *[F.when(x, F.lit(c)) for x, c in zip(sev, cols)]),
            "_series_ok": ok,
            "_rows_pct": pct(F.col("_rows_any"), n),
        }
    )
    rows: list[Column] = [_row(f"Minimum row count >= {min_rows}", None, _pf(n >= min_rows), "actual_rows", n)]
    missing = sorted(set(required) - set(cols))
    extra = sorted(set(cols) - set(required))
    rows.append(
        _row("All required columns present", None, F.lit("PASS" if not missing else "FAIL"), "missing_columns", F.lit(len(missing)), F.lit(",".join(missing)))
    )
    rows.append(_row("All required columns present", None, F.lit("PASS" if not missing else "FAIL"), "extra_columns", F.lit(len(extra)), F.lit(",".join(extra))))
    for c in required:
        if c not in cols:
            rows.append(_row(f"{c} null threshold", c, F.lit("FAIL"), "column_missing", F.lit(1.0)))
            continue
        mx = float(thresholds.get(c, C.DEFAULT_NULL_THRESHOLD_PCT))
        p = F.col(f"{c}__npct")
        name = f"{c} null <= {mx}%"
        st = _pf(p <= mx)
        rows += [
            _row(name, c, st, "null_count", F.col(f"{c}__nulls"), F.lit(_criticality(mx))),
            _row(name, c, st, "null_pct", p, F.lit(_criticality(mx))),
        ]
    st = F.when(F.col("_rows_any") > 0, "WARN").otherwise("PASS")
    name = "Row-level missingness profile"
    rows += [
        _row(name, None, st, "rows_with_missing", F.col("_rows_any")),
        _row(name, None, st, "rows_with_missing_pct", F.col("_rows_pct")),
        _row(name, None, st, "max_missing_cells_in_row", F.col("_max_miss")),
        _row(name, None, st, "p95_missing_cells_in_row", F.col("p95")),
    ]
    st = F.when((F.col("_sev_n") == 0) & (F.col("_severe_rows") == 0), "PASS").otherwise("WARN")
    name = f"No columns >= {C.SEVERE_COLUMN_MISSING_PCT}% missing & no rows >= {C.SEVERE_ROW_MISSING_PCT}% missing"
    rows += [
        _row(name, None, st, "severe_columns", F.col("_sev_n"), F.col("_sev_names")),
        _row(name, None, st, "severe_row_count", F.col("_severe_rows")),
        _row(name, None, st, "severe_row_pct", pct(F.col("_severe_rows"), n)),
    ]
    nulls = sum((F.col(f"{c}__nulls") for c in cols), F.lit(0))
    cells = n * ncols
    overall = F.when(cells > 0, fixed_round(100 * (1 - nulls / cells), 2)).otherwise(F.lit(100.0))
    profile = "Row-level missingness profile"
    rows.append(_row(profile, None, F.when(F.col("_rows_any") > 0, "WARN").otherwise("PASS"), "overall_completeness_pct", overall))
    name = "Macro series fully populated"
    for c in series:
        if c in cols:
            for metric, v in (("null_pct", F.col(f"{c}__pct2")), ("min", F.col(f"{c}__min")), ("max", F.col(f"{c}__max"))):
                rows.append(_row(name, c, _pf(F.col("_series_ok")), metric, v))
        else:
            rows.append(_row(name, c, F.lit("FAIL"), "null_pct", F.lit(100.0)))
    return _emit(w, "Completeness", rows)


# --- 3 consistency (Q13–Q17) ----------------------------------------------------------------
def dtype_family(dt_: T.DataType) -> set[str]:
    """Q13: the families a Spark type belongs to."""
    fams = set()
    if isinstance(dt_, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        fams |= {"integer", "numeric"}
    if isinstance(dt_, (T.FloatType, T.DoubleType, T.DecimalType)):
        fams.add("numeric")
    if isinstance(dt_, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        fams.add("datetime")
    if isinstance(dt_, T.BooleanType):
        fams.add("bool")
    if isinstance(dt_, T.StringType):
        fams.add("string")
    return fams


def dtype_checks(df: DataFrame, expected: dict = C.DTYPE_EXPECTATIONS) -> list[tuple[str, str, str, str]]:
    """(check, column, status, actual type) per present expected column (schema only)."""
    out = []
    for c, fam in expected.items():
        if c in df.columns:
            t = df.schema[c].dataType
            out.append((f"{c} dtype is {fam}", c, "PASS" if fam in dtype_family(t) else "FAIL", t.simpleString()))
    return out


def check_consistency(
    df: DataFrame,
    expected: dict = C.DTYPE_EXPECTATIONS,
    store_range: tuple[int, int] = C.STORE_ID_RANGE,
    dept_range: tuple[int, int] = C.DEPT_ID_RANGE,
) -> DataFrame:
    has = set(df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    ids = [(c, p, r) for c, p, r in (("Store", "S", store_range), ("Dept", "D", dept_range)) if c in has]
    if {"Weekly_Sales", "Size"} <= has:
        sub = F.col("Weekly_Sales").isNotNull() & F.col("Size").isNotNull() & (F.col("Size") > 0)
        ratio = F.abs(F.col("Weekly_Sales") / F.when(sub, F.col("Size")))
        aggs += [F.count_if(sub).alias("R__n"), F.count_if(sub & (ratio > C.SALES_PER_SIZE_LIMIT)).alias("R__viol")]
    if {"Temperature", "Date"} <= has:
        aggs.append(F.count_if(F.month("Date").isin(C.SUMMER_MONTHS) & (F.col("Temperature") < 0)).alias("T__viol"))
    if "IsHoliday" in has:
        aggs.append(_non_boolean_rows("IsHoliday", df).alias("H__viol"))
    w = df.agg(*aggs)
    if ids:
        # each id once per column, from one aggregate; the samples are the smallest bad ids
        names = [c for c, *_ in ids]
        one = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("id")) for c in names])).alias("x"))
        one = one.select("x.*").where("id IS NOT NULL").groupBy("name", "id").agg(F.lit(1).alias("one"))
        counts, bad_ids = [], {}
        for c, p, r in ids:
            own = F.col("name") == c
            bad = own & ~F.col("id").between(*r)
            counts += [F.count_if(own).alias(f"{p}__uniq"), F.count_if(bad).alias(f"{p}__bad")]
            bad_ids[f"{p}__sample"] = F.when(bad, F.col("id"))
        samples = smallest_distinct(one, bad_ids, 20).select(*[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in bad_ids])
        w = one_row_concat(w, one.agg(*counts), samples)
    rows: list[Column] = [_row(chk, c, F.lit(st), "dtype", None, F.lit(t)) for chk, c, st, t in dtype_checks(df, expected)]
    if "Store" in has:
        name = f"Store IDs in [{store_range[0]}, {store_range[1]}]"
        st = _pf(F.col("S__bad") == 0)
        rows += [_row(name, "Store", st, "unique_stores", F.col("S__uniq"), F.col("S__sample")), _row(name, "Store", st, "invalid_count", F.col("S__bad"))]
    if "Dept" in has:
        name = f"Dept IDs in [{dept_range[0]}, {dept_range[1]}]"
        st = _pf(F.col("D__bad") == 0)
        rows += [_row(name, "Dept", st, "unique_depts", F.col("D__uniq")), _row(name, "Dept", st, "invalid_dept_count", F.col("D__bad"))]
    if {"Weekly_Sales", "Size"} <= has:
        p = pct(F.col("R__viol"), F.col("R__n"))
        name = f"|Weekly_Sales / Size| <= {C.SALES_PER_SIZE_LIMIT}"
        st = _pf(p <= C.SALES_PER_SIZE_MAX_PCT)
        rows += [_row(name, None, st, "violations", F.col("R__viol")), _row(name, None, st, "violation_pct", p)]
    if {"Temperature", "Date"} <= has:
        rows.append(_row("No sub-zero temperatures in Jun-Aug", "Temperature", _pf(F.col("T__viol") == 0), "violations", F.col("T__viol")))
    if "IsHoliday" in has:
        rows.append(_row("IsHoliday contains only boolean values", "IsHoliday", _pf(F.col("H__viol") == 0), "violations", F.col("H__viol")))
    return _emit(w, "Consistency", rows)


#: Hashes (16 bytes each) that are broadcast.
BROADCAST_HASHES = 1_000_000


# --- 4 uniqueness (Q18–Q20) -----------------------------------------------------------------
def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first per key (NULLs equal): one groupBy shuffle, map-side combined."""
    keys = list(keys or df.columns)
    return df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dups"))


def check_uniqueness(
    df: DataFrame,
    key: Sequence[str] = ("Store", "Dept", "Date"),
    fingerprint: Sequence[str] = ("Store", "Dept", "Date", "Weekly_Sales"),
) -> DataFrame:
    has_key = all(c in df.columns for c in key)
    has_fp = all(c in df.columns for c in fingerprint)
    # a row's two hashes are counted; only rows whose hashes come twice are compared as a whole
    hashes = {"_h1": F.xxhash64(*df.columns), "_h2": F.xxhash64(F.lit(1), *df.columns)}
    hashed = df.select(*[h.alias(n) for n, h in hashes.items()]).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_rows"))
    again = cut_lineage(hashed.where("_rows > 1").select("_h1", "_h2"), "repeated-hashes")
    few = F.broadcast(again) if again.count() <= BROADCAST_HASHES else again
    suspects = df.withColumns(hashes).join(few, ["_h1", "_h2"], "left_semi")
    full = suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_rows"))

    def beyond_first(counted: DataFrame, name: str) -> DataFrame:
        return counted.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias(name))

    parts = [df.agg(F.count(F.lit(1)).alias("_n")), beyond_first(full, "_full")]
    shorter = df
    if has_fp:
        shorter = df.groupBy(*fingerprint).agg(F.count(F.lit(1)).alias("_rows"))
        parts.append(beyond_first(shorter, "_fp"))
    if has_key:
        nested = has_fp and set(key) <= set(fingerprint)
        rows = F.sum("_rows") if nested else F.count(F.lit(1))
        parts.append(beyond_first((shorter if nested else df).groupBy(*key).agg(rows.alias("_rows")), "_key"))
    w = one_row_concat(*parts)
    nn = F.col("_n")
    rows = [
        _row("No exact full-row duplicates", None, _pf(F.col("_full") == 0), "duplicate_count", F.col("_full")),
        _row("No exact full-row duplicates", None, _pf(F.col("_full") == 0), "duplicate_pct", pct(F.col("_full"), nn)),
    ]
    if has_key:
        st = _pf(F.col("_key") == 0)
        name = "Unique business key (" + " + ".join(key) + ")"
        rows += [_row(name, None, st, "duplicate_count", F.col("_key")), _row(name, None, st, "duplicate_pct", pct(F.col("_key"), nn))]
    if has_fp:
        p = pct(F.col("_fp"), nn)
        st = _pf(p <= C.FINGERPRINT_MAX_PCT)
        name = "Unique fingerprint (" + " + ".join(fingerprint) + ")"
        rows += [_row(name, None, st, "duplicate_count", F.col("_fp")), _row(name, None, st, "duplicate_pct", p)]
    return _emit(w, "Uniqueness", rows)


# --- 5 outliers (Q21–Q23) ---------------------------------------------------------------------
def _fences(df: DataFrame, cols: Sequence[str], method: str) -> DataFrame:
    """One row: lower and upper IQR fence, mean and population std of each column."""
    q = quantiles_wide(df, cols, {"q1": 0.25, "q3": 0.75}, method=method)
    iqr = F.col("q3") - F.col("q1")
    k = C.IQR_MULTIPLIER
    row = q.agg(*[x for c in cols for x in (
        F.max(F.when(F.col("column") == c, F.col("q1") - k * iqr)).alias(f"{c}__lb"),
        F.max(F.when(F.col("column") == c, F.col("q3") + k * iqr)).alias(f"{c}__ub"),
    )])
    mom = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sd"))])
    return _local(one_row_concat(row, mom))


def _outside(c: str) -> Column:
    x = F.col(c)
    return x.isNotNull() & ((x < F.col(f"{c}__lb")) | (x > F.col(f"{c}__ub")))


def outlier_counts(df: DataFrame, columns: Sequence[str] = C.OUTLIER_COLUMNS, method: str = "exact", fences: DataFrame | None = None) -> DataFrame:
    """Per column: n, skew, fences, IQR and z-score outlier counts and pct, a status per method and overall."""
    cols = present(df, columns)
    fences = _fences(df, cols, method) if fences is None else fences
    j = one_row_concat(df.select(*cols), F.broadcast(fences))
    aggs = []
    for c in cols:
        x = F.col(c)
        z = F.abs(x - F.col(f"{c}__mean")) / F.when(F.col(f"{c}__sd") > 0, F.col(f"{c}__sd"))
        aggs += [
            F.count(x).alias(f"{c}__n"),
            sample_skew(x).alias(f"{c}__skew"),
            F.count_if(_outside(c)).alias(f"{c}__iqr"),
            F.count_if(z > C.ZSCORE_THRESHOLD).alias(f"{c}__z"),
        ]
    w = one_row_concat(j.agg(*aggs), F.broadcast(fences))
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__n").alias("n_non_null"),
            F.col(f"{c}__skew").alias("skewness"),
            F.col(f"{c}__lb").alias("lower_fence"),
            F.col(f"{c}__ub").alias("upper_fence"),
            F.col(f"{c}__iqr").alias("iqr_count"),
            pct(F.col(f"{c}__iqr"), F.col(f"{c}__n")).alias("iqr_pct"),
            F.col(f"{c}__z").alias("z_count"),
            pct(F.col(f"{c}__z"), F.col(f"{c}__n")).alias("z_pct"),
        )
        for c in cols
    ]
    prof = _local(w).select(F.explode(F.array(*structs)).alias("r")).select("r.*").where(F.col("n_non_null") > 0)
    iqr_ok = F.col("iqr_pct") <= C.OUTLIER_THRESHOLD_PCT
    z_ok = F.col("z_pct") <= C.OUTLIER_THRESHOLD_PCT
    skewed = F.abs(F.col("skewness")) > 1.0
    return prof.withColumns({
        "is_skewed": F.coalesce(skewed, F.lit(False)),
        "iqr_status": _pf(iqr_ok),
        "z_status": _pf(z_ok),
    }).withColumn("overall_status", _pf(F.when(F.col("is_skewed"), iqr_ok | z_ok).otherwise(iqr_ok & z_ok)))


def outlier_profile(df: DataFrame, columns: Sequence[str] = C.OUTLIER_COLUMNS, method: str = "exact") -> DataFrame:
    """:func:`outlier_counts` with the 10 smallest distinct IQR outliers of each column."""
    cols = present(df, columns)
    fences = _fences(df, cols, method)
    j = one_row_concat(df.select(*cols), F.broadcast(fences))
    few = smallest_distinct(j, {c: F.when(_outside(c), fixed_round(F.col(c), 2)) for c in cols}, 10)
    samples = few.unpivot([], cols, "column", "sample_outliers")
    return outlier_counts(df, cols, method, fences).join(samples, "column", "left")


def check_outliers(df: DataFrame, columns: Sequence[str] = C.OUTLIER_COLUMNS, method: str = "exact") -> DataFrame:
    p = outlier_counts(df, columns, method)
    metrics = ["iqr_count", "iqr_pct", "z_count", "z_pct", "skewness", "lower_fence", "upper_fence"]
    text = {"iqr_count": "iqr_status", "z_count": "z_status"}
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), (F.col(text[m]) if m in text else F.lit(None).cast("string")).alias("text"))
        for m in metrics
    ]
    out = p.select(
        F.lit("Outlier Detection").alias("dimension"),
        F.concat(F.lit("Outliers in "), F.col("column")).alias("check"),
        "column",
        F.col("overall_status").alias("status"),
        F.explode(F.array(*rows)).alias("m"),
    )
    return out.select("dimension", "check", "column", "status", "m.metric", "m.value", "m.text")


# --- 6 distribution sanity (Q24) -----------------------------------------------------------------
def mode_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value, ties to the smallest value (pandas ``mode()[0]``)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.col("count").desc(), F.col(column).asc())
        .limit(1)
        .select(F.col(column).cast("string").alias("mode"))
    )


def check_distribution(df: DataFrame, method: str = "exact") -> DataFrame:
    has = set(df.columns)
    med_cols = [c for c in ("Weekly_Sales", "Temperature", "Unemployment") if c in has]
    parts = []
    if med_cols:
        med = quantiles_wide(df, med_cols, {"median": 0.5}, method=method)
        parts.append(med.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"{c}__med") for c in med_cols]))
    if C.TARGET in has:
        counts = df.where(F.col(C.TARGET).isNotNull()).groupBy(C.TARGET).count()
        parts.append(counts.agg(F.count(F.lit(1)).alias("_classes"), F.max("count").alias("_cmax"), F.min("count").alias("_cmin")))
    if "Type" in has:
        parts.append(mode_value(df, "Type"))
    if not parts:
        return _empty(df)
    w = one_row_concat(*parts)
    rows = []
    for c, (lo, hi), label in (
        ("Weekly_Sales", C.SALES_MEDIAN_RANGE, "Median Weekly_Sales in"),
        ("Temperature", C.TEMPERATURE_MEDIAN_RANGE, "Median Temperature in"),
        ("Unemployment", C.UNEMPLOYMENT_MEDIAN_RANGE, "Median Unemployment in"),
    ):
        if c in med_cols:
            v = F.col(f"{c}__med")
            rows.append(_row(f"{label} [{lo}, {hi}]", c, _pf((v >= lo) & (v <= hi)), "median", fixed_round(v, 2)))
    if C.TARGET in has:
        ratio = fixed_round(F.col("_cmax") / F.col("_cmin"), 3)
        rows.append(
            _row("Class imbalance ratio < 2.0", C.TARGET, F.when(F.col("_classes") >= 2, _pf(ratio < C.MAX_IMBALANCE)), "imbalance_ratio", ratio)
        )
    if "Type" in has:
        rows.append(_row("Most common store Type is A", "Type", _pf(F.col("mode") == "A"), "mode", None, F.col("mode")))
    out = _emit(w, "Distribution Profile", rows)
    return out.where(F.col("status").isNotNull())


# --- 7 relationships (Q25) -------------------------------------------------------------------------
def check_relationships(
    df: DataFrame,
    columns: Sequence[str] = C.NUMERIC_COLUMNS,
    positive: Sequence[tuple[str, str]] = C.EXPECTED_POSITIVE,
    negative: Sequence[tuple[str, str]] = C.EXPECTED_NEGATIVE,
) -> DataFrame:
    """Q25: expected correlation signs on complete cases: Pearson r with its strength, p and significance (two-sided t-test,
    p < 0.05), Spearman ρ with its p, n.  Without a complete row every check is SKIP.  The correlations of every column
    with the sales are :func:`sales_correlations`."""
    from shelfspark.operators import correlation as CR

    cols = present(df, columns)
    cc = df.select(*cols).na.drop(how="any")
    pairs = [(a, b, "positive") for a, b in positive if a in cols and b in cols] + [
        (a, b, "negative") for a, b in negative if a in cols and b in cols
    ]
    none = F.lit(None).cast("string")

    def metric(name: str, value: Column, text: Column = none) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), text.alias("text"))

    def significant(p: str) -> Column:
        return F.when(F.col(p).isNull(), none).when(F.col(p) < 0.05, "significant").otherwise("not significant")

    r = F.col("pearson_r")
    strength = F.when(F.abs(r) > 0.6, "strong").when(F.abs(r) > 0.3, "moderate").otherwise("weak")
    res = CR.pair_correlations(cc, [(a, b) for a, b, _ in pairs], spearman=True)
    exp = df.sparkSession.createDataFrame([(a, b, d) for a, b, d in pairs], "a string, b string, expected string")
    j = res.join(exp, ["a", "b"])
    j = CR.with_r_pvalue(CR.with_r_pvalue(j), "spearman_r", "n", "spearman_p")
    ok = F.when(F.col("expected") == "positive", r > 0).otherwise(r < 0)
    expected = j.select(
        F.concat(F.col("a"), F.lit(" vs "), F.col("b"), F.lit(" ("), F.col("expected"), F.lit(")")).alias("check"),
        F.concat(F.col("a"), F.lit(","), F.col("b")).alias("column"),
        F.when(F.col("n") == 0, "SKIP").otherwise(_pf(ok)).alias("status"),
        F.explode(F.array(
            metric("pearson_r", r, strength), metric("pearson_p", F.col("p_value"), significant("p_value")),
            metric("spearman_r", F.col("spearman_r")), metric("spearman_p", F.col("spearman_p"), significant("spearman_p")), metric("n", F.col("n")),
        )).alias("m"),
    )
    return expected.select(F.lit("Relationships").alias("dimension"), "check", "column", "status", "m.metric", "m.value", "m.text")


def sales_correlations(df: DataFrame, columns: Sequence[str] = C.NUMERIC_COLUMNS, sales: str = "Weekly_Sales") -> DataFrame:
    """Q25: on complete cases, r of every other column with the sales: (feature, n, r, strength, p_value, significant)."""
    from shelfspark.operators import correlation as CR

    cols = present(df, columns)
    cc = df.select(*cols).na.drop(how="any")
    own = CR.pair_sums(cc, [c for c in cols if c != sales], [sales])
    r = F.col("r")
    strength = F.when(F.abs(r) > 0.6, "strong").when(F.abs(r) > 0.3, "moderate").otherwise("weak")
    out = CR.with_r_pvalue(own.select(F.col("a").alias("feature"), "n", "r", strength.alias("strength")), "r", "n")
    return out.withColumn("significant", F.col("p_value") < 0.05)


# --- stage checks (Q26, Q27) -------------------------------------------------------------------------
def _stage_aggregates(df: DataFrame) -> list[Column]:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    aggs = [
        F.count(F.lit(1)).alias("_rows"),
        sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).alias("_nulls"),
        sum((F.count_if(F.col(c).isNull()).cast("boolean").cast("int") for c in df.columns), F.lit(0)).alias("_null_columns"),
        sum((F.count_if(F.abs(F.col(c)) == float("inf")) for c in floats), F.lit(0)).alias("_infinite"),
    ]
    if C.TARGET in df.columns:
        y = F.col(C.TARGET)
        aggs += [F.count_if(y == 0).alias("_low"), F.count_if(y == 1).alias("_high"), F.count_if(y.isNull() | ~y.isin(0, 1)).alias("_other")]
    return aggs


def check_cleaned(before: DataFrame, after: DataFrame, markdowns: Sequence[str] = C.MARKDOWN_COLUMNS, text_columns: Sequence[str] = ("Type",)) -> DataFrame:
    """Q26: the cleaned table has no NULL (WARN) and no infinite cell, the rows of its input, a class ratio below 2 (WARN),
    the flag columns that cleaning adds, and no text column but the expected ones (WARN)."""
    w = one_row_concat(after.agg(*_stage_aggregates(after)), before.agg(F.count(F.lit(1)).alias("_before")))
    new = [f"has_{c}" for c in markdowns] + ["is_return"]
    missing = [c for c in new if c not in after.columns]
    texts = [f.name for f in after.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in text_columns]
    rows = [
        _row("No remaining null values", None, F.when(F.col("_nulls") == 0, "PASS").otherwise("WARN"), "null_cells", F.col("_nulls")),
        _row("No remaining null values", None, F.when(F.col("_nulls") == 0, "PASS").otherwise("WARN"), "columns_with_nulls", F.col("_null_columns")),
        _row("No infinite values", None, _pf(F.col("_infinite") == 0), "infinite_cells", F.col("_infinite")),
        _row("Row count preserved", None, _pf(F.col("_rows") == F.col("_before")), "rows", F.col("_rows")),
    ]
    if C.TARGET in after.columns:
        most, least = F.greatest("_low", "_high"), F.least("_low", "_high")
        ratio = fixed_round(F.when(least > 0, most / least), 3)
        rows.append(_row("Target distribution intact", C.TARGET, F.when(ratio < C.MAX_IMBALANCE, "PASS").otherwise("WARN"), "imbalance_ratio", ratio))
    rows += [
        _row("All expected new columns created", None, F.lit("FAIL" if missing else "PASS"), "missing_columns", F.lit(len(missing)), F.lit(",".join(missing))),
        _row("No unexpected text columns", None, F.lit("WARN" if texts else "PASS"), "text_columns", F.lit(len(texts)), F.lit(",".join(texts))),
    ]
    return _emit(w, "Post-Cleaning", rows)


def check_features(before: DataFrame, after: DataFrame, cyclical: Sequence[str] = C.CYCLICAL_COLUMNS, dropped: Sequence[str] = ()) -> DataFrame:
    """Q27: the feature table has no NULL (WARN) and no infinite cell, the rows of its input, a target of 0 and 1 both,
    cyclical features in [-1.01, 1.01]; ``dropped`` names the zero-variance columns that were removed (P9)."""
    pairs = [c for c in cyclical if c in after.columns]
    limits = [x for c in pairs for x in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))]
    w = one_row_concat(after.agg(*_stage_aggregates(after), *limits), before.agg(F.count(F.lit(1)).alias("_before")))
    rows = [
        _row("No NaN values in engineered features", None, F.when(F.col("_nulls") == 0, "PASS").otherwise("WARN"), "null_cells", F.col("_nulls")),
        _row("No NaN values in engineered features", None, F.when(F.col("_nulls") == 0, "PASS").otherwise("WARN"), "columns_with_nulls", F.col("_null_columns")),
        _row("No infinite values", None, _pf(F.col("_infinite") == 0), "infinite_cells", F.col("_infinite")),
        _row("Row count preserved", None, _pf(F.col("_rows") == F.col("_before")), "rows", F.col("_rows")),
    ]
    if C.TARGET in after.columns:
        intact = (F.col("_low") > 0) & (F.col("_high") > 0) & (F.col("_other") == 0)
        rows.append(_row("Target column intact", C.TARGET, _pf(intact), "other_values", F.col("_other")))
    for c in pairs:
        st = _pf((F.col(f"{c}__min") >= -1.01) & (F.col(f"{c}__max") <= 1.01))
        rows += [_row(f"{c} in [-1, 1]", c, st, m, fixed_round(F.col(f"{c}__{m}"), 4)) for m in ("min", "max")]
    rows.append(_row("No zero-variance features", None, F.lit("PASS"), "constant_columns_dropped", F.lit(len(dropped)), F.lit(",".join(dropped))))
    return _emit(w, "Post-Features", rows)


# --- Q29 roll-up ----------------------------------------------------------------------------------
def validate(df: DataFrame, today: dt.date | None = None, method: str = "exact") -> DataFrame:
    """All seven dimensions as one check-row table."""
    checks = [
        lambda: check_accuracy(df, today=today),
        lambda: check_completeness(df),
        lambda: check_consistency(df),
        lambda: check_uniqueness(df),
        lambda: check_outliers(df, method=method),
        lambda: check_distribution(df, method=method),
        lambda: check_relationships(df),
    ]
    # each dimension runs jobs of its own while its plan is built; side by side they share the executors
    inherit = inheritable_thread_target(df.sparkSession)
    with ThreadPoolExecutor(len(checks)) as pool:
        parts = [part.result() for part in [pool.submit(inherit(check)) for check in checks]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dimension_summary(checks: DataFrame) -> DataFrame:
    """Q29: per dimension: checks, passed, warnings, failed, skipped, overall status.  A skipped check is none of the checks;
    a dimension with nothing but skipped ones is SKIP."""
    per_check = checks.groupBy("dimension", "check").agg(F.first("status", ignorenulls=True).alias("status"))
    return per_check.groupBy("dimension").agg(
        F.count_if(F.col("status") != "SKIP").alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.count_if(F.col("status") == "SKIP").alias("skipped"),
    ).withColumn(
        "overall_status",
        F.when(F.col("failed") > 0, "FAIL").when(F.col("warnings") > 0, "WARN").when(F.col("passed") > 0, "PASS").otherwise("SKIP"),
    )


def overall_summary(summary: DataFrame) -> DataFrame:
    """Q29: totals over dimensions and the global status."""
    return summary.agg(
        F.sum("total_checks").alias("total_checks"),
        F.sum("passed").alias("passed"),
        F.sum("warnings").alias("warnings"),
        F.sum("failed").alias("failed"),
        F.count(F.lit(1)).alias("dimensions_evaluated"),
        F.count_if(F.col("overall_status") == "PASS").alias("dimensions_passed"),
        F.count_if(F.col("overall_status") == "WARN").alias("dimensions_warned"),
        F.count_if(F.col("overall_status") == "FAIL").alias("dimensions_failed"),
    ).withColumn(
        "overall_status",
        F.when(F.col("dimensions_failed") > 0, "FAIL").when(F.col("dimensions_warned") > 0, "WARN").otherwise("PASS"),
    )
