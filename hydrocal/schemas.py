"""Canonical schemas, report column names and the fixed values that define the answers.

Internal frames use snake_case columns; report names (with spaces and brackets) appear only at
the sinks.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the calibrated behaviour; do not tune).
# ---------------------------------------------------------------------------
FEET_TO_METRES = 0.3048
HPA_TO_PSI = 0.0145038
SENSOR_FACTOR = 0.70307  # metres of water per (PSI / specific gravity)
WATER_DENSITY = 1000.0
REFERENCE_DENSITY = 1000.0
STALE_MONTHS = 2
AM_TIME = "12:00:00"
PM_TIME = "18:00:00"
AM_CELL = 15  # 0-based position of the morning hPa cell in a weather table row
PM_CELL = 21  # 0-based position of the afternoon hPa cell
SUMMARY_LABELS = ["Mean", "Lowest", "Highest", "Total"]
CONVERSION_DEFAULT = "default"
CONVERSION_DIVIDE_BY_100 = "divide_by_100"

# Source column names of the logger exports and the weather feed.
SRC_DATE = "Date"
SRC_TIME = "Time"
SRC_LEVEL = "Level(RAW)[Main Buffer] (ft)"
SRC_BARO = "Barometric Pressure(RAW)[Main Buffer] (hPa)"
SRC_COMMENT = "OTHER - Comments - Text"

# Report column names.
R_SITE = "Sample Point"
R_TS = "Date Time (dd/mm/yyyy hh24:mi:ss)"
R_BOM = "BomBaro"
R_BARO = SRC_BARO
R_RAW = "Depth(m)raw"
R_ADJ = "Depth(m)adjusted"
R_COMMENT = SRC_COMMENT
R_UPLOAD_DEPTH = "LEVEL - DEPTH TO WATER - m (INPUT)"
R_UPLOAD_MAHD = "LEVEL - WATER LEVEL - mAHD (INPUT)"
MAIN_REPORT_COLUMNS = [R_SITE, R_TS, R_BOM, R_BARO, R_RAW, R_ADJ, R_COMMENT]
UPLOAD_REPORT_COLUMNS = [R_SITE, R_TS, R_UPLOAD_DEPTH, R_UPLOAD_MAHD, R_COMMENT]
REPORT_TS_FORMAT = "dd/MM/yyyy hh:mm:ss a"

# Placeholder reasons, each followed by " on dd/MM/yyyy HH:mm:ss".
REASON_CSV_EMPTY = "CSV file was empty"
REASON_BAD_DATETIME = "No valid Date/Time entries found"
REASON_BAD_NUMERIC = "No valid numeric data found"
REASON_NEGATIVE = f"No data found with {SRC_LEVEL} >= 0"
REASON_EMPTY_FILE = "Empty file"
REASON_MISSING_FILE = "Site CSV file not found"
REASON_STALE_PREFIX = "No telemetry data received for"
PLACEHOLDER_PREFIX = "Placeholder:"
DRY_COMMENT = "There is an equipment issue or the pool is dry"

# Tokens the CSV reader treats as missing values.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Processing stages a raw reading can reach (C4). A file's placeholder reason is decided by the
# furthest stage any of its rows reached.
STAGE_NO_ROW = 0  # stands for a file, not for a reading
STAGE_BAD_DATETIME = 1
STAGE_BAD_NUMERIC = 2
STAGE_NEGATIVE = 3
STAGE_KEPT = 4

# ---------------------------------------------------------------------------
# Internal schemas.
# ---------------------------------------------------------------------------

def require_types(df, expected: dict, where: str) -> None:
    """static type guard at an operator's entry (raises before any job runs)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for name, dtype in expected.items():
        if name not in have:
            raise ValueError(f"{where}: missing column {name!r}")
        if have[name] != dtype:
            raise TypeError(f"{where}: column {name!r} is {have[name].simpleString()}, expected {dtype.simpleString()}")
