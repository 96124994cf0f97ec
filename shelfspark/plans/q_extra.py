"""Queries of the documented-only features (X1–X5) and the file sources/sinks (S)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import quality as Q
from shelfspark.operators import timeseries as X
from shelfspark.plans import stages
from shelfspark.plans.catalog import register, stage_sql
from shelfspark.session import ensure_checkpoint_dir
from shelfspark.sources import files
from shelfspark.sources import retail_view as rv

_W = "PARTITION BY Store, Dept ORDER BY Date, Weekly_Sales"


@register(
    "x1_x2_lags_and_rolling",
    stage_sql(
        "SELECT Store, Dept, Date, Weekly_Sales, "
        + ", ".join(f"lag(Weekly_Sales, {k}) OVER ({_W}) AS Weekly_Sales_lag{k}" for k in (1, 2, 4))
        + ", "
        + ", ".join(f"avg(Weekly_Sales) OVER ({_W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS Weekly_Sales_roll_mean{k}" for k in (4, 8, 12))
        + f", stddev_samp(Weekly_Sales) OVER ({_W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS Weekly_Sales_roll_std4 FROM merged"
    ),
    round_cols=["Weekly_Sales_roll_mean4", "Weekly_Sales_roll_mean8", "Weekly_Sales_roll_mean12", ("Weekly_Sales_roll_std4", 3)],
    digits=6,
)
def x1_x2(spark, sf_dir):
    """X1 lags 1/2/4 and X2 prior-row rolling means 4/8/12 and std 4 per (Store, Dept)."""
    m = stages.merged(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales")
    return X.add_rolling(X.add_lags(m))


@register(
    "x4_econ_composites",
    stage_sql(
        "SELECT Store, Dept, Date, (" + " + ".join(
            f"CASE WHEN max({c}) OVER () - min({c}) OVER () > 0 THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0e0 END"
            for c in ("UMCSENT", "RSXFS", "PCE")
        ) + ") / 3 AS EconIndex, CASE WHEN PCE <> 0 THEN RSXFS / PCE END AS RealSpendingPerCapita, "
        "CASE WHEN CPI <> 0 THEN Fuel_Price / CPI END AS FuelBurden FROM merged"
    ),
    round_cols=["EconIndex", "RealSpendingPerCapita", "FuelBurden"],
    digits=6,
)
def x4(spark, sf_dir):
    """EconIndex, RealSpendingPerCapita, FuelBurden."""
    m = stages.merged(spark, sf_dir).select("Store", "Dept", "Date", "UMCSENT", "RSXFS", "PCE", "Fuel_Price", "CPI")
    return X.add_econ_composites(m).select("Store", "Dept", "Date", "EconIndex", "RealSpendingPerCapita", "FuelBurden")


@register(
    "x5_time_split_counts",
    stage_sql(
        "SELECT split, count(*) AS rows FROM (SELECT CASE WHEN d <= c0 THEN 'train' WHEN d <= c1 THEN 'validation' ELSE 'test' END AS split "
        "FROM (SELECT date_diff('day', DATE '1970-01-01', Date) AS d FROM merged) CROSS JOIN "
        "(SELECT quantile_cont(dd, 0.7) AS c0, quantile_cont(dd, 0.85) AS c1 FROM "
        "(SELECT DISTINCT date_diff('day', DATE '1970-01-01', Date) AS dd FROM merged))) GROUP BY split"
    ),
)
def x5(spark, sf_dir):
    """Train / validation / test by date cut-offs (70 % / 85 % of distinct dates)."""
    return X.time_split(stages.merged(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "x3_trend_acceleration",
    stage_sql(
        "SELECT Store, Dept, Date, Weekly_Sales, t AS Weekly_Sales_trend4, t - lag(t) OVER (PARTITION BY Store, Dept ORDER BY pos) AS Weekly_Sales_accel4 FROM ("
        "SELECT *, CASE WHEN count(*) OVER b > 1 THEN regr_slope(Weekly_Sales, pos) OVER b END AS t FROM ("
        f"SELECT Store, Dept, Date, Weekly_Sales, CAST(row_number() OVER ({_W}) AS DOUBLE) AS pos FROM merged) "
        "WINDOW b AS (PARTITION BY Store, Dept ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"
    ),
    round_cols=[("Weekly_Sales_trend4", 3), ("Weekly_Sales_accel4", 3)],
)
def x3(spark, sf_dir):
    """4-row least-squares trend and its change per (Store, Dept)."""
    m = stages.merged(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales")
    return X.add_trend(m)


_INDEX = "(" + " + ".join(
    f"CASE WHEN max({c}) OVER () - min({c}) OVER () > 0 THEN ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) ELSE 0e0 END"
    for c in ("UMCSENT", "RSXFS", "PCE")
) + ") / 3"


@register(
    "x4_econ_momentum",
    stage_sql(f"SELECT Date, EconIndex, EconIndex - lag(EconIndex) OVER (ORDER BY Date) AS EconMomentum FROM (SELECT Date, {_INDEX} AS EconIndex FROM series)"),
    round_cols=["EconIndex", "EconMomentum"],
    digits=6,
)
def x4b(spark, sf_dir):
    """Month-over-month change of the EconIndex of the monthly series."""
    return X.econ_momentum(rv.monthly_series(spark, sf_dir))


# --- sources / sinks round trips: written to the checkpoint folder, read back, compared with the tables ------------
def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


@register("s1_facts_csv_roundtrip", stage_sql("SELECT Store, Dept, Date, Weekly_Sales, IsHoliday FROM facts"), round_cols=["Weekly_Sales"], digits=6)
def s1(spark, sf_dir):
    """The facts written as CSV and read back with the schema of the fact file."""
    path = _folder(spark, "facts-csv")
    rv.facts(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday").write.option("header", True).csv(path)
    return files.read_facts(spark, path)


@register("s2_stores_csv_roundtrip", stage_sql("SELECT Store, Type, Size FROM stores"))
def s2(spark, sf_dir):
    """The store dimension as CSV and back."""
    path = _folder(spark, "stores-csv")
    rv.stores(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_dim(spark, path)


_CONTEXT = ["Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5", "CPI", "Unemployment"]


@register(
    "s3_context_csv_roundtrip",
    stage_sql("SELECT Store, Date, " + ", ".join(f"avg({c}) AS {c}" for c in _CONTEXT) + ", bool_or(IsHoliday) AS IsHoliday FROM facts GROUP BY Store, Date"),
    round_cols=_CONTEXT,
    digits=6,
)
def s3(spark, sf_dir):
    """S3: the store-week context as CSV, with ``NA`` for what is missing, and back."""
    path = _folder(spark, "context-csv")
    files_columns = [f.name for f in files.CONTEXT_SCHEMA.fields]
    rv.store_week_context(spark, sf_dir).select(*files_columns).write.option("header", True).option("nullValue", "NA").csv(path)
    return files.read_context(spark, path)


@register("s4_series_json_roundtrip", stage_sql("SELECT Date, 'PCE' AS series_id, PCE AS value FROM series"), round_cols=["value"], digits=6)
def s4(spark, sf_dir):
    """One monthly series as the payload a series service lands (one JSON document), and back."""
    base = _folder(spark, "series-json")
    own = rv.monthly_series_long(spark, sf_dir).where("series_id = 'PCE'")
    each = F.struct(F.date_format("Date", "yyyy-MM-dd").alias("date"), F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value"))
    own.agg(F.sort_array(F.collect_list(each)).alias("observations")).write.json(base)  # one value a month
    return files.read_series_json(spark, base, series_id_from_file=False).withColumn("series_id", F.lit("PCE"))


@register("s7_s9_stage_table_roundtrip", stage_sql("SELECT Year, count(*) AS rows FROM eda GROUP BY Year"))
def s7(spark, sf_dir):
    """S7 partitioned Parquet sink of the EDA table and S9 read-back with Date coerced."""
    path = _folder(spark, "eda-by-year")
    files.write_table(stages.eda(spark, sf_dir), path, partition_by=["Year"], sort_within=["Date"])
    return files.read_eda(spark, path).groupBy("Year").agg(F.count(F.lit(1)).alias("rows"))


@register("s8_s11_check_rows_roundtrip", None)
def s8(spark, sf_dir):
    """S8 check-row sink (JSON) and S11 read-back with a schema (absent path → empty)."""
    path = _folder(spark, "accuracy")
    files.write_checks(Q.check_accuracy(stages.merged(spark, sf_dir)), path, fmt="json")
    schema = T.StructType.fromDDL(Q.ROW_SCHEMA)
    back = files.read_optional_json(spark, path, schema)
    missing = files.read_optional_json(spark, path + "_absent", schema)
    return back.unionByName(missing)
