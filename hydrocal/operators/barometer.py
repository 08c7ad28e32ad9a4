"""External barometer: table rows -> AM/PM readings (C2, U4), daily series (C3, W1), join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrocal.functions import day_month_year_text, parse_date_time, to_number
from hydrocal.operators.dedup import first_per_day
from hydrocal.operators.joins import checked_join
from hydrocal.schemas import AM_CELL, AM_TIME, PM_CELL, PM_TIME, SUMMARY_LABELS
from hydrocal.sources.html_tables import picked_cells


def _reading(time_text: str, cells, idx: int):
    text = F.try_element_at(cells, F.lit(idx + 1))  # P14: NULL when the row is too short
    value = to_number(text)
    ok = value.isNotNull() & (value != 0)  # P13: must parse and be non-zero
    return F.named_struct(
        F.lit("time_text"), F.lit(time_text), F.lit("hpa_text"), text, F.lit("ok"), ok
    )


def unpivot_ampm(
    rows: DataFrame, month: int, year: int, cells_col: str = "cells", keys: list[str] | None = None, at: tuple[int, int, int] = (0, AM_CELL, PM_CELL)
) -> DataFrame:
    """U4: one table row -> up to two (date_text, time_text, hpa_text) readings.

    Day cells must be digits (P12, summary labels drop out); the date is the day number in the
    report month (F10); impossible days are rejected later by the strict parser. ``at``: places of the
    day, morning and afternoon cells.
    """
    keys = keys or []
    cells = F.col(cells_col)
    day = F.try_element_at(cells, F.lit(at[0] + 1))
    pairs = F.filter(
        F.array(_reading(AM_TIME, cells, at[1]), _reading(PM_TIME, cells, at[2])),
        lambda x: x["ok"],
    )
    return (
        rows.where(day.rlike(r"^[0-9]+$") & ~day.isin(SUMMARY_LABELS))
        .select(*keys, day_month_year_text(day, month, year).alias("date_text"), F.explode(pairs).alias("r"))
        .select(*keys, "date_text", F.col("r.time_text").alias("time_text"), F.col("r.hpa_text").alias("hpa_text"))
    )


def ampm_readings(pages: DataFrame, month: int, year: int, html_col: str = "html", keys: list[str] | None = None) -> DataFrame:
    """Weather pages -> (keys..., date_text, time_text, hpa_text) readings. Of each table row the three
    cells that count are made into text, no others."""
    cells = picked_cells(pages, [0, AM_CELL, PM_CELL], html_col, keys)
    return unpivot_ampm(cells, month, year, keys=keys, at=(0, 1, 2))


def daily_barometer(weather: DataFrame) -> DataFrame:
    """Readings (date_text, time_text, hpa_text) -> (day, bom_hpa), one row per day.

    Invalid timestamps and values are dropped (P6); the first reading of each day wins (W1). An
    absent or empty feed simply yields no rows (S10).
    """
    parsed = weather.select(
        parse_date_time(F.col("date_text"), F.col("time_text")).alias("ts"),
        to_number(F.col("hpa_text")).alias("bom_hpa"),
    ).where(F.col("ts").isNotNull() & F.col("bom_hpa").isNotNull())
    return first_per_day(parsed).select(F.to_date("ts").alias("day"), "bom_hpa")


def attach_baro(daily: DataFrame, daily_baro: DataFrame, small: bool | None = None) -> DataFrame:
    """Left join on calendar day; the right side is unique per day, so no fan-out.

    The daily series is bounded by the number of calendar days; it is broadcast after a size check
    (``small`` passes a check already made).
    """
    right = daily_baro.select(F.col("day").alias("_day"), F.col("bom_hpa").alias("_bom"))
    left = daily.drop("bom_hpa")
    out = checked_join(left.withColumn("_day", F.to_date("ts")), right, "_day", "left", small=small)
    return out.select(*left.columns, F.col("_bom").alias("bom_hpa"))
