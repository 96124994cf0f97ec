"""Fixed values of the retail pipeline.

FIXED VALUES: these constants must equal the reference pipeline's for the
same results (column names, domains, thresholds, windows, maps).  They are
stated plainly and in natural order; every operator takes them as defaults
and accepts other values as arguments.
"""

from __future__ import annotations

# --- fixed values: merged-table schema -------------------------------------
REQUIRED_COLUMNS = [
    "Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "Type", "Size",
    "Temperature", "Fuel_Price", "MarkDown1", "MarkDown2", "MarkDown3",
    "MarkDown4", "MarkDown5", "CPI", "Unemployment", "UMCSENT", "RSXFS",
    "PCE", "Sales_Class",
]

DTYPE_EXPECTATIONS = {
    "Store": "integer", "Dept": "integer", "Date": "datetime",
    "Weekly_Sales": "numeric", "IsHoliday": "bool", "Type": "string",
    "Size": "integer", "Temperature": "numeric", "Fuel_Price": "numeric",
    "MarkDown1": "numeric", "MarkDown2": "numeric", "MarkDown3": "numeric",
    "MarkDown4": "numeric", "MarkDown5": "numeric", "CPI": "numeric",
    "Unemployment": "numeric", "UMCSENT": "numeric", "RSXFS": "numeric",
    "PCE": "numeric", "Sales_Class": "integer",
}

VALUE_RANGES = {
    "Store": (1, 45),
    "Dept": (1, 99),
    "Weekly_Sales": (-50_000, 700_000),
    "Temperature": (-10.0, 120.0),
    "Fuel_Price": (1.0, 6.0),
    "CPI": (100.0, 250.0),
    "Unemployment": (2.0, 20.0),
    "Size": (1_000, 300_000),
    "UMCSENT": (40.0, 120.0),
    "RSXFS": (200_000.0, 500_000.0),
    "PCE": (5_000.0, 20_000.0),
}

NULL_THRESHOLDS_PCT = {
    "Store": 0.0, "Dept": 0.0, "Date": 0.0, "Weekly_Sales": 0.0,
    "IsHoliday": 0.0, "Type": 0.0, "Size": 0.0, "Sales_Class": 0.0,
    "Temperature": 1.0, "Fuel_Price": 1.0, "CPI": 5.0, "Unemployment": 5.0,
    "UMCSENT": 5.0, "RSXFS": 5.0, "PCE": 5.0, "MarkDown1": 75.0,
    "MarkDown2": 75.0, "MarkDown3": 75.0, "MarkDown4": 75.0, "MarkDown5": 75.0,
}
DEFAULT_NULL_THRESHOLD_PCT = 20.0
SEVERE_COLUMN_MISSING_PCT = 40.0
SEVERE_ROW_MISSING_PCT = 30.0
# Largest NULL threshold (per cent) of each criticality level, in rising order.
CRITICALITY_LEVELS = [(0.0, "critical"), (5.0, "high"), (100.0, "medium")]
MIN_ROWS = 5_000

IQR_MULTIPLIER = 1.5
ZSCORE_THRESHOLD = 3.0
OUTLIER_THRESHOLD_PCT = 5.0

NUMERIC_COLUMNS = [
    "Weekly_Sales", "Temperature", "Fuel_Price", "CPI", "Unemployment", "Size",
    "UMCSENT", "RSXFS", "PCE", "MarkDown1", "MarkDown2", "MarkDown3",
    "MarkDown4", "MarkDown5",
]
OUTLIER_COLUMNS = [
    "Weekly_Sales", "Temperature", "Fuel_Price", "CPI", "Unemployment", "Size",
    "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5",
]
EXPECTED_POSITIVE = [("Size", "Weekly_Sales"), ("RSXFS", "PCE")]
EXPECTED_NEGATIVE = [("Unemployment", "Weekly_Sales")]

STORE_TYPES = ["A", "B", "C"]
STORE_ID_RANGE = (1, 45)
DEPT_ID_RANGE = (1, 99)
DATE_RANGE = ("2010-01-01", "2012-12-31")
SALES_MEDIAN_RANGE = (5_000, 30_000)
TEMPERATURE_MEDIAN_RANGE = (40, 80)
UNEMPLOYMENT_MEDIAN_RANGE = (4, 12)
MAX_IMBALANCE = 2.0
SALES_PER_SIZE_LIMIT = 100
SALES_PER_SIZE_MAX_PCT = 2.0
FINGERPRINT_MAX_PCT = 0.5
SUMMER_MONTHS = [6, 7, 8]

# --- fixed values: cleaning --------------------------------------------------
MARKDOWN_COLUMNS = ["MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5"]
MARKDOWN_FLAGS = ["has_MarkDown1", "has_MarkDown2", "has_MarkDown3", "has_MarkDown4", "has_MarkDown5"]
CLIP_COLUMNS = ["Weekly_Sales", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5"]
CLIP_LOWER = 0.01
CLIP_UPPER = 0.99
SERIES_COLUMNS = ["UMCSENT", "RSXFS", "PCE"]

# --- fixed values: features -------------------------------------------------
# Holiday windows as ISO-week ranges, in order; HolidayType = position (1-based).
HOLIDAY_WINDOWS = [
    ("SuperBowl", 5, 7),
    ("LaborDay", 35, 37),
    ("Thanksgiving", 46, 48),
    ("Christmas", 50, 52),
]
HOLIDAY_NAMES = {0: "None", 1: "Super Bowl", 2: "Labor Day", 3: "Thanksgiving", 4: "Christmas"}
PEAK_MONTHS = [11, 12]
BACK_TO_SCHOOL_MONTHS = [7, 8]
TYPE_CODES = {"A": 2, "B": 1, "C": 0}
TYPE_LABELS = {"A": "Type A (Large)", "B": "Type B (Medium)", "C": "Type C (Small)"}
SALES_LABELS = {0: "Low", 1: "High"}
# Right-closed bins (-inf,0], (0,5000], (5000,15000], (15000,30000], (30000,50000], (50000,inf)
SALES_BUCKET_EDGES = [0, 5000, 15000, 30000, 50000]
SALES_BUCKET_LABELS = ["Negative/Return", "Very Low", "Low", "Medium", "High", "Very High"]
EPSILON = 1e-6
CYCLICAL_COLUMNS = ["Month_sin", "Month_cos", "Week_sin", "Week_cos"]

# Every numeric column of the EDA table but the target and the two ids, in table order.
EDA_NUMERIC_COLUMNS = [
    "Weekly_Sales", "Size", "Temperature", "Fuel_Price", "MarkDown1",
    "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5", "CPI",
    "Unemployment", "UMCSENT", "RSXFS", "PCE", "has_MarkDown1",
    "has_MarkDown2", "has_MarkDown3", "has_MarkDown4", "has_MarkDown5",
    "is_return", "Year", "Month", "Week", "Quarter", "DayOfYear",
    "WeekOfMonth", "IsMonthStart", "IsMonthEnd", "IsYearStart", "IsYearEnd",
    "DaysInMonth", "YearProgress", "HolidayType", "IsPreHoliday",
    "IsPostHoliday", "HolidayProximity", "IsPeakSeason", "IsBackToSchool",
    "TotalMarkDown", "ActiveMarkDownCount", "AvgMarkDownAmount",
    "MaxMarkDown", "HasAnyMarkDown", "TypeEncoded", "SizePerType",
    "StoreDeptCount", "DeptFrequency", "SizeQuartile", "ConsumerConfRatio",
    "Holiday_Size", "Holiday_Type", "Promo_Holiday", "Temp_Season",
    "MarkDown_Intensity", "Month_sin", "Month_cos", "Week_sin", "Week_cos",
]

# --- fixed values: preprocessing --------------------------------------------
TARGET = "Sales_Class"
LEAKAGE_COLUMNS = ["Date", "Weekly_Sales"]
NO_SCALE_COLUMNS = [
    "Sales_Class", "Store", "Dept", "IsHoliday", "TypeEncoded", "SizeQuartile",
    "HolidayType", "IsPreHoliday", "IsPostHoliday", "IsPeakSeason",
    "IsBackToSchool", "IsMonthStart", "IsMonthEnd", "IsYearStart", "IsYearEnd",
    "HasAnyMarkDown", "has_MarkDown1", "has_MarkDown2", "has_MarkDown3",
    "has_MarkDown4", "has_MarkDown5", "is_return", "Promo_Holiday",
    "Holiday_Type", "ActiveMarkDownCount", "Year",
]
TEST_FRACTION = 0.2
SEED = 42
SELECTED_FEATURES = [
    "Size", "Store", "Dept", "CPI", "DeptFrequency", "Week_cos",
    "IsPreHoliday", "Week_sin", "Fuel_Price", "ConsumerConfRatio",
    "AvgMarkDownAmount",
]

BOOSTING_GRID = {
    "max_depth": [3, 5, 7],
    "learning_rate": [0.1, 0.01, 0.05],
    "gamma": [0.0, 0.25, 1.0],
    "reg_lambda": [0.0, 1.0, 10.0],
    "scale_pos_weight": [1.0, 3.0, 5.0],
}

# --- fixed values: model metrics --------------------------------------------
HOLIDAY_ERROR_WEIGHT = 5.0
REGULAR_ERROR_WEIGHT = 1.0
