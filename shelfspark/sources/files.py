"""File sources and sinks.

CSV inputs are read with explicit schemas (no inference pass over the data),
Parquet is the format between stages, reports are written as JSON/CSV rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators.common import FLOAT_TYPES

FACTS_SCHEMA = T.StructType(
    [
        T.StructField("Store", T.IntegerType()),
        T.StructField("Dept", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Weekly_Sales", T.DoubleType()),
        T.StructField("IsHoliday", T.BooleanType()),
    ]
)
STORES_SCHEMA = T.StructType(
    [
        T.StructField("Store", T.IntegerType()),
        T.StructField("Type", T.StringType()),
        T.StructField("Size", T.IntegerType()),
    ]
)
CONTEXT_SCHEMA = T.StructType(
    [
        T.StructField("Store", T.IntegerType()),
        T.StructField("Date", T.DateType()),
        T.StructField("Temperature", T.DoubleType()),
        T.StructField("Fuel_Price", T.DoubleType()),
        *[T.StructField(f"MarkDown{i}", T.DoubleType()) for i in range(1, 6)],
        T.StructField("CPI", T.DoubleType()),
        T.StructField("Unemployment", T.DoubleType()),
        T.StructField("IsHoliday", T.BooleanType()),
    ]
)
SERIES_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "observations",
            T.ArrayType(T.StructType([T.StructField("date", T.StringType()), T.StructField("value", T.StringType())])),
        )
    ]
)


class MissingInputError(FileNotFoundError):
    """A required input is absent; the message names the dataset and path."""


def _require(spark: SparkSession, path: str, name: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(jvm_path):
        raise MissingInputError(f"Missing required input '{name}': {path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, name: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    _require(spark, path, name)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("dateFormat", date_format)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Weekly fact CSV with a parsed Date."""
    return nan_to_null(read_csv(spark, path, FACTS_SCHEMA, "facts"))


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """Store dimension CSV (the default line separator also splits CR-only files)."""
    return read_csv(spark, path, STORES_SCHEMA, "stores")


def read_context(spark: SparkSession, path: str) -> DataFrame:
    """S3: store-week context CSV; the literal ``NA`` is missing."""
    _require(spark, path, "context")
    df = spark.read.schema(CONTEXT_SCHEMA).option("header", True).option("nullValue", "NA").csv(path)
    return nan_to_null(df)


def read_series_json(spark: SparkSession, paths: Sequence[str] | str, series_id_from_file: bool = True) -> DataFrame:
    """Landed series payloads ``{"observations": [{"date", "value"}]}`` → (Date, series_id, value).

    The series id is the file stem; ``value`` that is not a number (e.g. ``"."``)
    becomes NULL; an empty payload yields an empty typed frame."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        _require(spark, p, "series")
    raw = spark.read.schema(SERIES_PAYLOAD_SCHEMA).option("multiLine", True).json(paths)
    sid = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1) if series_id_from_file else F.lit(None)
    obs = raw.select(sid.alias("series_id"), F.explode("observations").alias("o"))
    return obs.select(
        F.to_date("o.date").alias("Date"),
        "series_id",
        F.expr("try_cast(o.value AS DOUBLE)").alias("value"),
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating NaN → SQL NULL once at the source (pandas treats NaN as missing)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)}
    if not fl:
        return df
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in fl else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", sort_within: Sequence[str] = ()) -> None:
    """Stage output as Parquet (optionally partitioned; W4 sort within files)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_checks(checks: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite") -> None:
    """Check rows as JSON or CSV; a map/struct ``metrics`` column is serialised with to_json."""
    out = checks
    if fmt == "csv":
        out = checks.select(
            *[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)) else F.col(f.name) for f in checks.schema.fields]
        )
        out.write.mode(mode).option("header", True).csv(path)
    else:
        out.write.mode(mode).json(path)


def read_eda(spark: SparkSession, path: str) -> DataFrame:
    """Parquet stage table with Date coerced to a date."""
    df = spark.read.parquet(path)
    if "Date" in df.columns:
        df = df.withColumn("Date", F.col("Date").cast("date"))
    return df


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Model metric rows as JSON."""
    metrics.write.mode(mode).json(path)


def read_optional_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back exported sections / metrics; an absent path gives an empty frame, any other fault is raised."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
