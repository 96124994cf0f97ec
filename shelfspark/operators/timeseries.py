"""Documented-only features of the reference's report.

The reference's code does not compute these; its report describes them.  They
are per-(Store, Dept) window features over prior rows only (no leakage of the
current week), computed in date blocks of a series, plus macro-series
composites and a date-ordered split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators.chunks import bucket, chunk_bounds, order_key
from shelfspark.operators.common import one_row_concat
from shelfspark.operators.features import min_max_normalise

KEYS = ["Store", "Dept"]


def _with_history(df: DataFrame, rows: int, value: str, keys: Sequence[str], order: str = "Date", blocks: int | None = None):
    """``df`` in blocks of the order, each preceded by the last ``rows`` rows of its key from earlier blocks (``_halo``).

    Returns the frame and the window over (key, block).  A series of any length is cut into blocks; from each block at most
    ``rows`` rows travel on, so no task holds a whole series.  Ties of the order are ordered by the value."""
    p = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = order_key(F.col(order), df.schema[order].dataType)
    blocked = df.withColumn("_block", bucket(key, chunk_bounds([(df, key)], p)))
    sort = [F.col(order), F.col(value)]
    inside = Window.partitionBy(*keys, "_block")
    # each block's last rows; before the first of them stand, in order, the last rows of all earlier blocks
    end = F.row_number().over(inside.orderBy(*[c.desc() for c in sort]))
    tails = blocked.select(*keys, "_block", order, value, end.alias("_end")).where(F.col("_end") <= rows)
    series = Window.partitionBy(*keys).orderBy("_block", *sort)
    earlier = F.collect_list(F.struct(F.col(order), F.col(value))).over(series.rowsBetween(-rows, -1))
    first = F.row_number().over(inside.orderBy(*sort))
    halos = tails.select(*keys, "_block", earlier.alias("_earlier"), first.alias("_first")).where(F.col("_first") == 1)
    halo = halos.select(*keys, "_block", F.explode("_earlier").alias("_e")).select(*keys, "_block", F.col(f"_e.{order}").alias(order), F.col(f"_e.{value}").alias(value))
    extra = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c not in (*keys, order, value)]
    halo = halo.select("*", *extra, F.lit(True).alias("_halo"))
    both = blocked.withColumn("_halo", F.lit(False)).unionByName(halo)
    # halo rows of equal order and value stand before the block's own
    return both, Window.partitionBy(*keys, "_block").orderBy(*sort, F.col("_halo").desc())


def _done(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(~F.col("_halo")).drop("_halo", "_block").select(*columns)


def add_lags(df: DataFrame, lags: Sequence[int] = (1, 2, 4), value: str = "Weekly_Sales", keys: Sequence[str] = KEYS, blocks: int | None = None) -> DataFrame:
    """Previous 1/2/4 rows of the key's series."""
    both, w = _with_history(df, max(lags), value, keys, blocks=blocks)
    new = {f"{value}_lag{k}": F.lag(value, k).over(w) for k in lags}
    return _done(both.withColumns(new), [*df.columns, *new])


def add_rolling(df: DataFrame, windows: Sequence[int] = (4, 8, 12), std_window: int = 4, value: str = "Weekly_Sales", keys: Sequence[str] = KEYS, blocks: int | None = None) -> DataFrame:
    """Rolling means over the previous k rows (excluding the current row) and a rolling std."""
    both, w = _with_history(df, max(*windows, std_window), value, keys, blocks=blocks)
    new = {f"{value}_roll_mean{k}": F.avg(value).over(w.rowsBetween(-k, -1)) for k in windows}
    new[f"{value}_roll_std{std_window}"] = F.stddev_samp(value).over(w.rowsBetween(-std_window, -1))
    return _done(both.withColumns(new), [*df.columns, *new])


def add_trend(df: DataFrame, k: int = 4, value: str = "Weekly_Sales", keys: Sequence[str] = KEYS, blocks: int | None = None) -> DataFrame:
    """Least-squares slope of the previous k values against their position, and its change."""
    both, w = _with_history(df, k + 1, value, keys, blocks=blocks)
    staged = both.withColumn("_pos", F.row_number().over(w).cast("double"))
    slope = F.regr_slope(value, "_pos").over(w.rowsBetween(-k, -1))
    out = staged.withColumn(f"{value}_trend{k}", slope)
    out = out.withColumn(f"{value}_accel{k}", F.col(f"{value}_trend{k}") - F.lag(f"{value}_trend{k}", 1).over(w))
    return _done(out, [*df.columns, f"{value}_trend{k}", f"{value}_accel{k}"])


def add_econ_composites(df: DataFrame) -> DataFrame:
    """EconIndex (mean of min-max normalised series), RealSpendingPerCapita = RSXFS/PCE,
    FuelBurden = Fuel_Price/CPI, Econ_Size = EconIndex × SizeQuartile (when present).
    EconMomentum (month-over-month change of EconIndex) needs the monthly series: see
    :func:`econ_momentum`."""
    normed = min_max_normalise(df, C.SERIES_COLUMNS)
    idx = sum((F.col(f"{c}_norm") for c in C.SERIES_COLUMNS), F.lit(0.0)) / len(C.SERIES_COLUMNS)
    out = normed.withColumn("EconIndex", idx).drop(*[f"{c}_norm" for c in C.SERIES_COLUMNS])
    out = out.withColumns(
        {
            "RealSpendingPerCapita": F.when(F.col("PCE") != 0, F.col("RSXFS") / F.col("PCE")),
            "FuelBurden": F.when(F.col("CPI") != 0, F.col("Fuel_Price") / F.col("CPI")),
        }
    )
    if "SizeQuartile" in out.columns:
        out = out.withColumn("Econ_Size", F.col("EconIndex") * F.col("SizeQuartile"))
    return out


def econ_momentum(series: DataFrame) -> DataFrame:
    """EconIndex per month and its change from the previous month (the series table
    has one row per month, so a single ordered window over it is small)."""
    normed = min_max_normalise(series, C.SERIES_COLUMNS)
    idx = sum((F.col(f"{c}_norm") for c in C.SERIES_COLUMNS), F.lit(0.0)) / len(C.SERIES_COLUMNS)
    w = Window.orderBy("Date")  # one row per month: a small, bounded window
    return normed.select("Date", idx.alias("EconIndex")).withColumn("EconMomentum", F.col("EconIndex") - F.lag("EconIndex").over(w))


def time_split(df: DataFrame, cuts: Sequence[float] = (0.7, 0.85), date: str = "Date") -> DataFrame:
    """Train / validation / test by date cut-offs at quantiles of the distinct dates."""
    from shelfspark.operators.ranks import group_quantiles

    dates = df.select(F.unix_date(F.col(date)).alias("_d")).distinct()
    q = group_quantiles(dates, "_d", list(cuts))
    row = q.agg(*[F.max(F.when(F.col("p") == float(c), F.col("q"))).alias(f"_c{i}") for i, c in enumerate(cuts)])
    j = one_row_concat(df, F.broadcast(row))
    d = F.unix_date(F.col(date))
    return j.withColumn(
        "split", F.when(d <= F.col("_c0"), "train").when(d <= F.col("_c1"), "validation").otherwise("test")
    ).drop("_c0", "_c1")
