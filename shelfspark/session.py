"""Spark session helpers.

Library code never creates its own session: every operator takes DataFrames
and uses ``df.sparkSession``.  These helpers exist for tests, ``bench.py``
and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

HUGE_METHOD, SPARK_HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit", "65535"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "shelfspark") -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHELFSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    small_methods(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder; on ``local`` masters (tests) a scratch one is set when it is unset.

    Elsewhere an unset folder is an error: each machine would write to its own."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="shelfspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def small_methods(spark: SparkSession) -> None:
    """Plans over sixty columns are run without one generated method for the whole stage, unless the session says otherwise.

    Java doesn't compile methods of more than 8,000 bytes of code: such a stage would be interpreted, several times slower."""
    if spark.conf.get(HUGE_METHOD, None) in (None, SPARK_HUGE_METHOD):
        spark.conf.set(HUGE_METHOD, "8000")


def cut_lineage(df: DataFrame, name: str = "stage", **options: str | int) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job writes it (an eager RDD checkpoint would compute the plan twice); the
    result has no lineage to recompute after an executor loss, and later plans get
    Parquet column pruning and filter pushdown on it.  ``options`` are those of the Parquet writer."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)
