"""Keep-first operators.

``row_number() == 1`` is planned as ``WindowGroupLimit`` on both sides of the exchange, so each
task ships at most one row per group: a hot group is reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reading_order(df: DataFrame) -> list[Column]:
    """Q6: deterministic order of readings: time, then file, then values (NULLs last)."""
    cols = ["ts", "src_file", "level_ft", "baro_hpa", "comment"]
    return [F.col(c).asc_nulls_last() for c in cols if c in df.columns]


def first_by(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """First row of each group of ``keys`` in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_per_site_day(df: DataFrame) -> DataFrame:
    """First reading of each (site, calendar day)."""
    return first_by(df, [F.col("site"), F.to_date("ts")], reading_order(df))


def first_per_day(df: DataFrame, ts: str = "ts", value: str = "bom_hpa") -> DataFrame:
    """First reading of each calendar day (the morning value when both exist)."""
    return first_by(df, [F.to_date(ts)], [F.col(ts).asc_nulls_last(), F.col(value).asc_nulls_last()])
