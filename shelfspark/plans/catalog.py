"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the driver's tables (through the stage tables derived from
them) and runs over whole tables.  ``round_cols`` gives the comparison a
tolerance: the listed double columns are rounded half-up to ``digits`` on
both engines (summation order differs between engines in the last bits).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.plans.oracle_sql import compare_round_sql
from shelfspark.plans.oracle_sql import with_stages


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    round_cols: Sequence[str | tuple[str, int]] = field(default_factory=tuple)
    digits: int = 9
    note: str = ""

    def _digits(self) -> dict[str, int]:
        out = {}
        for c in self.round_cols:
            if isinstance(c, tuple):
                out[c[0]] = c[1]
            else:
                out[c] = self.digits
        return out

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        rc = self._digits()
        if rc:
            df = df.select(*[compare_round(F.col(c), rc[c]).alias(c) if c in rc else F.col(c) for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        rc = self._digits()
        if not rc:
            return self.sql
        rep = ", ".join(f"{compare_round_sql(c, d)} AS {c}" for c, d in rc.items())
        return f"SELECT * REPLACE ({rep}) FROM ({self.sql}) AS q"


def compare_round(c, digits: int):
    """Comparison rounding: snap to ``digits + 3`` decimals, then round half-up to ``digits``.

    Summation order differs between engines by an ulp; the snap puts both engines'
    values on the same side of an exact decimal tie before the final rounding.  Away from a tie the scaled double rounds to the
    same integer as the decimal does, and only values near one (or too large to scale) take the decimal way."""
    scaled = c.cast("double") * F.lit(10.0**digits)
    whole = F.floor(scaled + 0.5).cast("double")  # off by an eighth at most below 2^49, and the snap by 0.0005
    plain = (F.abs(scaled) < 2.0**49) & (F.abs(scaled - whole) < 0.4)
    return F.when(plain, whole / F.lit(10.0**digits)).otherwise(_decimal_round(c, digits))


def _decimal_round(c, digits: int):
    snapped = F.round(c.cast("decimal(38,12)"), digits + 3)
    return F.round(snapped, digits).cast("double")


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, round_cols: Sequence = (), digits: int = 9, note: str = ""):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(round_cols), digits, note)
        return fn

    return deco


def stage_sql(body: str, extra: str = "") -> str:
    return with_stages(body, extra)


def all_queries() -> dict[str, Query]:
    # importing the modules registers their queries
    from shelfspark.plans import (  # noqa: F401
        q_acquire,
        q_clean_features,
        q_eda,
        q_quality,
        q_stats,
        q_model,
        q_extra,
    )

    return dict(REGISTRY)
