"""Small helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Columns of ``cols`` that exist in ``df`` (operators skip missing ones)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def field_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric (and boolean-free) columns by schema, in table order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)]


def pct(count: Column, total: Column, digits: int = 3) -> Column:
    """``round(count/total*100, digits)``; 0.0 on an empty table."""
    return F.when(total > 0, fixed_round(count.cast("double") / total * 100, digits)).otherwise(F.lit(0.0))


def fixed_round(c: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value (same on Spark and DuckDB)."""
    return F.round(c.cast("decimal(38,12)"), digits).cast("double")


def pass_fail(cond: Column) -> Column:
    return F.when(cond, F.lit("PASS")).otherwise(F.lit("FAIL"))


def safe_div(a: Column, b: Column) -> Column:
    """NULL instead of an ANSI division-by-zero error."""
    return F.when(b != 0, a / b)


def as_double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def one_row_concat(*frames: DataFrame) -> DataFrame:
    """Side-by-side concatenation: every frame after the first is a global aggregate (or a limit of one), so it has one row.

    Anything else would be a cross join of tables and is refused."""
    out = frames[0]
    for f in frames[1:]:
        most = f._jdf.queryExecution().optimizedPlan().maxRows()
        if most.isEmpty() or most.get() > 1:
            raise ValueError("one_row_concat: a side may have more than one row")
        out = out.crossJoin(f)
    return out
