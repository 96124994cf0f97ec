"""Binding of the retail pipeline's inputs onto the driver's test tables.

The pipeline expects weekly store/department facts, a store dimension,
store-week context measures and monthly macro series.  The driver ships a
TPC-H-like star schema, so each input is a projection of it (the same
expressions are spelled out as SQL in :data:`ORACLE_VIEWS` for DuckDB):

* facts    — ``lineitem ⋈ orders``: Store, Dept, Date, Weekly_Sales, IsHoliday
             plus the row-level context measures (Temperature … MarkDown5).
* stores   — ``supplier``: Store, Type, Size (one row per store).
* context  — facts aggregated per (Store, Date): a (Store, Date)-keyed table for the
             composite-key join.
* series   — monthly aggregates of ``orders`` in long form (Date, series_id, value).

Everything is lazy: reading, projection and filters reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import config as C
from shelfspark.operators import joins
from shelfspark.operators.aggregates import add_store_median_target
from shelfspark.session import cut_lineage
from shelfspark.sources.files import nan_to_null

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _weekly_sales() -> F.Column:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return F.when(returned, -F.col("l_extendedprice") * 0.05).otherwise(
        F.col("l_extendedprice") * F.col("l_quantity") / 25
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly facts with row-level context measures (no store attributes, no series)."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("IsHoliday"))
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    out = j.select(
        (F.col("l_suppkey") + 1).cast("int").alias("Store"),
        (F.col("l_partkey") % 99 + 1).cast("int").alias("Dept"),
        F.col("l_shipdate").cast("date").alias("Date"),
        _weekly_sales().alias("Weekly_Sales"),
        "IsHoliday",
        (F.col("l_quantity") * 2).alias("Temperature"),
        (F.lit(2.5) + F.col("l_tax") * 20).alias("Fuel_Price"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("l_extendedprice") * F.col("l_discount")).alias("MarkDown1"),
        F.when(F.col("l_linenumber") % 4 == 0, F.col("l_extendedprice") * F.col("l_tax")).alias("MarkDown2"),
        F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity") * F.col("l_quantity")).alias("MarkDown3"),
        F.when(F.col("l_partkey") % 4 == 0, F.col("l_extendedprice") / 10).alias("MarkDown4"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("l_quantity") * 100).alias("MarkDown5"),
        (F.lit(126.0) + F.col("l_discount") * 1000).alias("CPI"),
        (F.lit(4.0) + F.col("l_tax") * 100).alias("Unemployment"),
    )
    return nan_to_null(out)


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store dimension: Store, Type, Size."""
    s = table(spark, sf_dir, "supplier")
    nk = F.col("s_nationkey") % 4
    return s.select(
        (F.col("s_suppkey") + 1).cast("int").alias("Store"),
        F.when(nk < 2, "A").when(nk == 2, "B").otherwise("C").alias("Type"),
        (F.lit(34000) + (F.col("s_suppkey") * 7919) % 186000).cast("int").alias("Size"),
    )


def store_week_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Store, Date)-keyed context table: averages of the row-level measures, and a
    colliding ``IsHoliday`` flag (any urgent order that day)."""
    f = facts(spark, sf_dir)
    measures = ["Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5", "CPI", "Unemployment"]
    return f.groupBy("Store", "Date").agg(
        *[F.avg(c).alias(c) for c in measures],
        F.bool_or("IsHoliday").alias("IsHoliday"),
    )


def monthly_series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed monthly macro series in long form: (Date, series_id, value).

    Every order counts; RSXFS is NULL in March (a NULL cell, not a missing row)."""
    o = table(spark, sf_dir, "orders")
    m = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("Date")).agg(
        (F.lit(40.0) + F.count(F.lit(1)) % 80).alias("UMCSENT"),
        F.when(F.month(F.min("o_orderdate")) == 3, F.lit(None).cast("double"))
        .otherwise(F.lit(200000.0) + F.count(F.lit(1)) * 100)
        .alias("RSXFS"),
        F.round((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 10000), 4).alias("PCE"),
    )
    return m.unpivot(["Date"], C.SERIES_COLUMNS, "series_id", "value")


def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide monthly series (J3 full outer join of the landed series on Date)."""
    return joins.outer_join_series(monthly_series_long(spark, sf_dir), C.SERIES_COLUMNS)


#: Bytes a core below which a table may lie in fewer row groups than there are cores.
FEW_BYTES = 4 << 20


def over_cores(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, dealt to all cores if its ``source`` is small: a row group is read by one task, and so would all that follows be."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * FEW_BYTES else df


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20-column merged table: facts ⟕ stores (J1) → as-of series (J4) → target (A1).

    facts ⟕ stores feeds three branches (distinct as-of keys, store medians, the
    final rows), so it is written once instead of re-running the fact join."""
    f = facts(spark, sf_dir)
    joined = over_cores(joins.left_join_dim(f, stores(spark, sf_dir), ["Store"]), table(spark, sf_dir, "lineitem"))
    with_store = cut_lineage(joined, "facts-with-stores")
    with_series = joins.asof_join(with_store, monthly_series(spark, sf_dir), on="Date")
    target = add_store_median_target(with_series, median_source=with_store)
    return target.select(*C.REQUIRED_COLUMNS)


# ---------------------------------------------------------------------------
# The same inputs as SQL text, runnable unchanged by DuckDB (oracle) and Spark.
# ---------------------------------------------------------------------------
ORACLE_VIEWS = """
facts AS (
  SELECT CAST(l_suppkey + 1 AS INT) AS Store,
         CAST(l_partkey % 99 + 1 AS INT) AS Dept,
         CAST(l_shipdate AS DATE) AS Date,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice * 0.05
              ELSE l_extendedprice * l_quantity / 25 END AS Weekly_Sales,
         o_orderpriority = '1-URGENT' AS IsHoliday,
         l_quantity * 2 AS Temperature,
         2.5e0 + l_tax * 20 AS Fuel_Price,
         CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice * l_discount END AS MarkDown1,
         CASE WHEN l_linenumber % 4 = 0 THEN l_extendedprice * l_tax END AS MarkDown2,
         CASE WHEN l_partkey % 3 = 0 THEN l_quantity * l_quantity END AS MarkDown3,
         CASE WHEN l_partkey % 4 = 0 THEN l_extendedprice / 10 END AS MarkDown4,
         CASE WHEN l_orderkey % 3 = 0 THEN l_quantity * 100 END AS MarkDown5,
         126e0 + l_discount * 1000 AS CPI,
         4e0 + l_tax * 100 AS Unemployment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
stores AS (
  SELECT CAST(s_suppkey + 1 AS INT) AS Store,
         CASE WHEN s_nationkey % 4 < 2 THEN 'A' WHEN s_nationkey % 4 = 2 THEN 'B' ELSE 'C' END AS Type,
         CAST(34000 + (s_suppkey * 7919) % 186000 AS INT) AS Size
  FROM supplier
),
series AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Date,
         40e0 + count(*) % 80 AS UMCSENT,
         CASE WHEN month(min(o_orderdate)) = 3 THEN NULL ELSE 200000e0 + count(*) * 100 END AS RSXFS,
         round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 10000, 4) AS PCE
  FROM orders
  GROUP BY 1
),
joined AS (
  SELECT f.Store, f.Dept, f.Date, f.Weekly_Sales, f.IsHoliday, s.Type, s.Size,
         f.Temperature, f.Fuel_Price, f.MarkDown1, f.MarkDown2, f.MarkDown3, f.MarkDown4, f.MarkDown5,
         f.CPI, f.Unemployment, m.UMCSENT, m.RSXFS, m.PCE
  FROM facts f LEFT JOIN stores s ON f.Store = s.Store
  ASOF LEFT JOIN series m ON f.Date >= m.Date
),
merged AS (
  SELECT j.*, CAST(COALESCE(j.Weekly_Sales > md.med, FALSE) AS INT) AS Sales_Class
  FROM joined j LEFT JOIN (SELECT Store, quantile_cont(Weekly_Sales, 0.5) AS med FROM joined GROUP BY Store) md
    ON j.Store = md.Store
)
"""


def oracle(sql_body: str, ctes: str = "") -> str:
    """Prefix an oracle query with the shared view definitions (plus extra CTEs)."""
    extra = (",\n" + ctes.strip()) if ctes else ""
    return "WITH " + ORACLE_VIEWS.strip() + extra + "\n" + sql_body
