"""Column-level building blocks (all built-in Catalyst expressions, no UDFs)."""

from hydrocal.functions.depth import adjusted_depth, raw_depth, specific_gravity
from hydrocal.functions.numeric import round2, to_number
from hydrocal.functions.text import base_name, file_stem, reason_text, strip_tags
from hydrocal.functions.timeparse import (
    date_time_text,
    day_month_year_text,
    day_start,
    month_year,
    months_before,
    parse_date_time,
    parse_day_first,
    report_ts,
    stamp_text,
)

__all__ = [
    "adjusted_depth",
    "base_name",
    "date_time_text",
    "day_month_year_text",
    "day_start",
    "file_stem",
    "month_year",
    "months_before",
    "parse_date_time",
    "parse_day_first",
    "raw_depth",
    "reason_text",
    "report_ts",
    "round2",
    "specific_gravity",
    "stamp_text",
    "strip_tags",
    "to_number",
]
