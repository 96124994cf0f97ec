"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage

__all__ = ["crc_fold", "cut_lineage", "read_table", "text_rows", "typed_batch"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", binary: bool = False) -> DataFrame:
    """Only the id (long) and the text of ``docs`` (as UTF-8 bytes when ``binary``); other columns, whatever their
    names, do not take part."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (text.cast("binary") if binary else text).alias("text"))


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (NULL id: NULL)."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def typed_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)


def in_chunks(values: list, size: int) -> Iterator[list]:
    for start in range(0, len(values), size):
        yield values[start : start + size]
