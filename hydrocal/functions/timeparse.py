"""Date/time Column expressions.

All timestamps are TIMESTAMP_NTZ: the exports carry wall-clock time without a zone, so nothing here
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrocal.schemas import REPORT_TS_FORMAT

# Strict day-first "%d/%m/%Y %H:%M:%S": day and month may be one or two digits (a one-digit day may
# carry a leading space), the year has four digits within the range of nanosecond timestamps
# (1678-2261), any run of whitespace separates date and time, seconds stop at 59, no trailing text.
DAY_FIRST = (
    r"^(?: (?=[1-9]/))?(3[01]|[12][0-9]|0[1-9]|[1-9])/(1[0-2]|0[1-9]|[1-9])/"
    r"(167[89]|16[89][0-9]|1[7-9][0-9]{2}|20[0-9]{2}|21[0-9]{2}|22[0-5][0-9]|226[01])\s+"
    r"(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])$"
)
_ISO = "$3-$2-$1 $4:$5:$6"


def parse_day_first(text: Column) -> Column:
    """parse ``d/m/yyyy H:M:S`` text to TIMESTAMP_NTZ; anything invalid becomes NULL.

    The text is checked once and rewritten once to ``yyyy-m-d H:M:S``; ``try_cast`` to
    TIMESTAMP_NTZ then rejects impossible calendar dates (31/02). The text is referenced only twice,
    so the expression stays small when Catalyst substitutes it into pushed-down filters.
    """
    iso = F.regexp_replace(text, DAY_FIRST, _ISO)
    return F.when(text.rlike(DAY_FIRST), iso.try_cast("timestamp_ntz"))


def date_time_text(date_col: Column, time_col: Column) -> Column:
    """``Date + ' ' + Time``; NULL when either side is NULL (not ``concat_ws``)."""
    return F.concat(date_col, F.lit(" "), time_col)


def parse_date_time(date_col: Column, time_col: Column) -> Column:
    """F1 + F2."""
    return parse_day_first(date_time_text(date_col, time_col))


def report_ts(ts: Column) -> Column:
    """``dd/MM/yyyy hh:mm:ss AM`` as written in both reports."""
    return F.date_format(ts, REPORT_TS_FORMAT)


def day_start(ts: Column) -> Column:
    """midnight of the same day, still TIMESTAMP_NTZ."""
    return F.to_date(ts).cast("timestamp_ntz")


def stamp_text(ts: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` used inside placeholder comments."""
    return F.date_format(ts, "dd/MM/yyyy HH:mm:ss")


def month_year(ts: Column) -> Column:
    """``MMMM yyyy``, e.g. ``March 2026``."""
    return F.date_format(ts, "MMMM yyyy")


def months_before(ts: Column, months: int) -> Column:
    """calendar months back with month-end clamping (30 Apr - 2 months = 28/29 Feb)."""
    return ts - F.make_ym_interval(F.lit(0), F.lit(months))


def day_month_year_text(day_text: Column, month: int, year: int) -> Column:
    """``dd/MM/yyyy`` from a day number text and a fixed report month. Numbers outside 1 to 31 give
    NULL; days that the month does not have are left for the strict parser to reject."""
    day = day_text.try_cast("int")
    padded = F.when(day.between(1, 31), F.lpad(day.cast("string"), 2, "0"))
    return F.concat(padded, F.lit(f"/{month:02d}/{year}"))
