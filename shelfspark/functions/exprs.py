"""Row-wise column expressions: maps, bins, markdown aggregates, ratios."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark import config as C


def lookup(col: str | Column, mapping: Mapping) -> Column:
    """Dictionary map; unknown keys → NULL (pandas ``Series.map``)."""
    c = F.col(col) if isinstance(col, str) else col
    out: Column = F.lit(None)
    for k, v in reversed(list(mapping.items())):
        out = F.when(c == F.lit(k), F.lit(v)).otherwise(out)
    return out


def type_code(col: str = "Type") -> Column:
    """A→2, B→1, C→0, else NULL."""
    return lookup(col, C.TYPE_CODES).cast("int")


def right_closed_bins(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut`` with right-closed bins (−∞, e0], (e0, e1], … (e_n, ∞); NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    out: Column = F.when(c.isNotNull(), F.lit(labels[-1]))
    for e, lab in reversed(list(zip(edges, labels))):
        out = F.when(c <= F.lit(e), F.lit(lab)).otherwise(out)
    return out


def sales_bucket(col: str = "Weekly_Sales") -> Column:
    return right_closed_bins(col, C.SALES_BUCKET_EDGES, C.SALES_BUCKET_LABELS)


def markdown_columns(
    markdowns: Sequence[str] = C.MARKDOWN_COLUMNS,
    flags: Sequence[str] = C.MARKDOWN_FLAGS,
) -> dict[str, Column]:
    """TotalMarkDown, ActiveMarkDownCount, AvgMarkDownAmount, MaxMarkDown, HasAnyMarkDown.

    Sums treat NULL as 0 (pandas ``sum(axis=1)``); ``greatest`` skips NULLs like
    pandas ``max(axis=1)``; the average is guarded so no ANSI division by zero."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in markdowns), F.lit(0.0))
    active = sum((F.coalesce(F.col(c), F.lit(0)) for c in flags), F.lit(0))
    mx = F.greatest(*[F.col(c) for c in markdowns]) if len(markdowns) > 1 else F.col(markdowns[0])
    return {
        "TotalMarkDown": total,
        "ActiveMarkDownCount": active,
        "AvgMarkDownAmount": F.when(active > 0, total / active).otherwise(F.lit(0.0)),
        "MaxMarkDown": mx,
        "HasAnyMarkDown": (active > 0).cast("int"),
    }


def interaction_columns(eps: float = C.EPSILON) -> dict[str, Column]:
    """F17 (inputs: IsHoliday, Size, TypeEncoded, HasAnyMarkDown, Temperature, Quarter, TotalMarkDown)."""
    hol = F.col("IsHoliday").cast("int")
    return {
        "Holiday_Size": hol * F.col("Size"),
        "Holiday_Type": hol * F.col("TypeEncoded"),
        "Promo_Holiday": F.col("HasAnyMarkDown") * hol,
        "Temp_Season": F.col("Temperature") * F.col("Quarter"),
        "MarkDown_Intensity": F.col("TotalMarkDown") / (F.col("Size") + F.lit(eps)),
    }


def consumer_confidence_ratio(eps: float = C.EPSILON) -> Column:
    """UMCSENT / (Unemployment + 1e-6)."""
    return F.col("UMCSENT") / (F.col("Unemployment") + F.lit(eps))


def cyclical_columns(month: str = "Month", week: str = "Week") -> dict[str, Column]:
    """sin/cos of Month/12 and Week/52."""
    two_pi = 2 * math.pi
    return {
        "Month_sin": F.sin(F.lit(two_pi) * F.col(month) / 12),
        "Month_cos": F.cos(F.lit(two_pi) * F.col(month) / 12),
        "Week_sin": F.sin(F.lit(two_pi) * F.col(week) / 52),
        "Week_cos": F.cos(F.lit(two_pi) * F.col(week) / 52),
    }


def label_columns() -> dict[str, Column]:
    """Sales_Label, StoreTypeLabel, HolidayName (+ W3 SalesBucket)."""
    return {
        "Sales_Label": lookup(C.TARGET, C.SALES_LABELS),
        "StoreTypeLabel": lookup("Type", C.TYPE_LABELS),
        "SalesBucket": sales_bucket("Weekly_Sales"),
        "HolidayName": lookup("HolidayType", C.HOLIDAY_NAMES),
    }
