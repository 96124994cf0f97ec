"""DuckDB SQL mirrors of the stage tables, used by the oracle queries.

``with_stages(body, extra)`` prefixes a query with CTEs ``facts stores series
joined merged flagged bounds cleaned featured eda``.  The SQL restates each
stage declaratively; it is the independent check of the Spark plans.
"""

from __future__ import annotations

from shelfspark import config as C
from shelfspark.sources.retail_view import ORACLE_VIEWS

_MD = C.MARKDOWN_COLUMNS


def _clip_cols() -> str:
    parts = []
    for c in C.CLIP_COLUMNS:
        parts.append(f"quantile_cont({c}, {C.CLIP_LOWER}) AS lo_{c}, quantile_cont({c}, {C.CLIP_UPPER}) AS hi_{c}")
    return ",\n         ".join(parts)


def _clip_replace() -> str:
    return ",\n    ".join(
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}"
        for c in C.CLIP_COLUMNS
    )


def _holiday_type() -> str:
    whens = " ".join(f"WHEN Week BETWEEN {lo} AND {hi} THEN {i}" for i, (_, lo, hi) in reversed(list(enumerate(C.HOLIDAY_WINDOWS, 1))))
    return f"CASE {whens} ELSE 0 END"


def _proximity() -> str:
    return "LEAST(" + ", ".join(f"LEAST(abs(Week - {h}), 52 - abs(Week - {h}))" for h in _HOLIDAY_WEEKS) + ")"


# the weeks of the four windows, spelled out independently of the operators
_HOLIDAY_WEEKS = [5, 6, 7, 35, 36, 37, 46, 47, 48, 50, 51, 52]
_PRE = "4, 5, 6, 34, 35, 36, 45, 46, 47, 49, 50, 51"
_POST = "6, 7, 8, 36, 37, 38, 47, 48, 49, 51, 52"

STAGE_CTES = f"""
flagged AS (
  SELECT * REPLACE ({", ".join(f"COALESCE({c}, 0e0) AS {c}" for c in _MD)}),
         {", ".join(f"CAST({c} IS NOT NULL AS INTEGER) AS has_{c}" for c in _MD)},
         CAST(COALESCE(Weekly_Sales < 0, FALSE) AS INTEGER) AS is_return
  FROM merged
),
bounds AS (
  SELECT {_clip_cols()}
  FROM flagged
),
cleaned AS (
  SELECT f.* REPLACE (
    {_clip_replace()})
  FROM flagged f CROSS JOIN bounds
),
cal AS (
  SELECT *,
    CAST(year(Date) AS INTEGER) AS Year,
    CAST(month(Date) AS INTEGER) AS Month,
    CAST(weekofyear(Date) AS INTEGER) AS Week,
    CAST(quarter(Date) AS INTEGER) AS Quarter,
    CAST(dayofyear(Date) AS INTEGER) AS DayOfYear,
    CAST((day(Date) - 1) // 7 + 1 AS INTEGER) AS WeekOfMonth,
    CAST(day(Date) = 1 AS INTEGER) AS IsMonthStart,
    CAST(Date = last_day(Date) AS INTEGER) AS IsMonthEnd,
    CAST(month(Date) = 1 AS INTEGER) AS IsYearStart,
    CAST(month(Date) = 12 AS INTEGER) AS IsYearEnd,
    CAST(day(last_day(Date)) AS INTEGER) AS DaysInMonth,
    dayofyear(Date) / 365e0 AS YearProgress
  FROM cleaned
),
hol AS (
  SELECT *,
    CAST({_holiday_type()} AS INTEGER) AS HolidayType,
    CAST(Week IN ({_PRE}) AS INTEGER) AS IsPreHoliday,
    CAST(Week IN ({_POST}) AS INTEGER) AS IsPostHoliday,
    CAST({_proximity()} AS INTEGER) AS HolidayProximity,
    CAST(Month IN (11, 12) AS INTEGER) AS IsPeakSeason,
    CAST(Month IN (7, 8) AS INTEGER) AS IsBackToSchool,
    {" + ".join(_MD)} AS TotalMarkDown,
    CAST({" + ".join("has_" + c for c in _MD)} AS INTEGER) AS ActiveMarkDownCount,
    GREATEST({", ".join(_MD)}) AS MaxMarkDown,
    CASE Type WHEN 'A' THEN 2 WHEN 'B' THEN 1 WHEN 'C' THEN 0 END AS TypeEncoded
  FROM cal
),
qedges AS (
  SELECT quantile_cont(Size, 0.25) AS q1, quantile_cont(Size, 0.5) AS q2, quantile_cont(Size, 0.75) AS q3 FROM hol
),
store_depts AS (SELECT Store, count(DISTINCT Dept) AS StoreDeptCount FROM hol WHERE Store IS NOT NULL GROUP BY Store),
dept_stores AS (SELECT Dept, count(DISTINCT Store) AS DeptFrequency FROM hol WHERE Dept IS NOT NULL GROUP BY Dept),
featured AS (
  SELECT h.*,
    CASE WHEN ActiveMarkDownCount > 0 THEN TotalMarkDown / ActiveMarkDownCount ELSE 0e0 END AS AvgMarkDownAmount,
    CAST(ActiveMarkDownCount > 0 AS INTEGER) AS HasAnyMarkDown,
    Size / (TypeEncoded + 1) AS SizePerType,
    sd.StoreDeptCount, ds.DeptFrequency,
    CAST(CASE WHEN Size <= q1 THEN 1 WHEN Size <= q2 THEN 2 WHEN Size <= q3 THEN 3 WHEN Size IS NOT NULL THEN 4 END AS INTEGER) AS SizeQuartile,
    UMCSENT / (Unemployment + 1e-6) AS ConsumerConfRatio,
    CAST(IsHoliday AS INTEGER) * Size AS Holiday_Size,
    CAST(IsHoliday AS INTEGER) * TypeEncoded AS Holiday_Type,
    CAST(ActiveMarkDownCount > 0 AS INTEGER) * CAST(IsHoliday AS INTEGER) AS Promo_Holiday,
    Temperature * Quarter AS Temp_Season,
    TotalMarkDown / (Size + 1e-6) AS MarkDown_Intensity,
    sin(2 * pi() * Month / 12) AS Month_sin,
    cos(2 * pi() * Month / 12) AS Month_cos,
    sin(2 * pi() * Week / 52) AS Week_sin,
    cos(2 * pi() * Week / 52) AS Week_cos
  FROM hol h
  LEFT JOIN store_depts sd ON h.Store = sd.Store
  LEFT JOIN dept_stores ds ON h.Dept = ds.Dept
  CROSS JOIN qedges
),
eda AS (
  SELECT *,
    strftime(Date, '%Y-%m') AS YearMonth,
    CAST(isoyear(Date) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(Date) AS VARCHAR), 2, '0') AS YearWeek,
    CASE Sales_Class WHEN 0 THEN 'Low' WHEN 1 THEN 'High' END AS Sales_Label,
    CASE Type WHEN 'A' THEN 'Type A (Large)' WHEN 'B' THEN 'Type B (Medium)' WHEN 'C' THEN 'Type C (Small)' END AS StoreTypeLabel,
    CASE WHEN Weekly_Sales IS NULL THEN NULL WHEN Weekly_Sales <= 0 THEN 'Negative/Return' WHEN Weekly_Sales <= 5000 THEN 'Very Low'
         WHEN Weekly_Sales <= 15000 THEN 'Low' WHEN Weekly_Sales <= 30000 THEN 'Medium' WHEN Weekly_Sales <= 50000 THEN 'High'
         ELSE 'Very High' END AS SalesBucket,
    CASE HolidayType WHEN 0 THEN 'None' WHEN 1 THEN 'Super Bowl' WHEN 2 THEN 'Labor Day' WHEN 3 THEN 'Thanksgiving'
         WHEN 4 THEN 'Christmas' END AS HolidayName
  FROM featured
)
"""


def with_stages(body: str, extra: str = "") -> str:
    """Full oracle query: shared views, stage CTEs, optional extra CTEs, then ``body``."""
    ctes = ORACLE_VIEWS.strip() + ",\n" + STAGE_CTES.strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return "WITH " + ctes + "\n" + body


def r(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal value — the SQL twin of ``fixed_round``."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def compare_round_sql(expr: str, digits: int) -> str:
    """SQL twin of ``catalog.compare_round`` (snap to digits+3, then round to digits)."""
    return f"CAST(ROUND(ROUND(CAST({expr} AS DECIMAL(38,12)), {digits + 3}), {digits}) AS DOUBLE)"
