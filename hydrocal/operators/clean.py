"""Cleaning of raw logger rows (C4: F1, F2, F11, P6, P7) with per-row rejection stages.

Every raw row is tagged with the furthest stage it reached: 1 bad timestamp, 2 non-numeric level or
pressure, 3 negative level, 4 kept. A file's placeholder reason is the reason of its furthest stage,
which equals the first stage at which the file would have run out of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrocal.functions import parse_date_time, to_number
from hydrocal.schemas import require_types
from hydrocal.schemas import (
    REASON_BAD_DATETIME,
    REASON_BAD_NUMERIC,
    REASON_NEGATIVE,
    STAGE_BAD_DATETIME,
    STAGE_BAD_NUMERIC,
    STAGE_KEPT,
    STAGE_NEGATIVE,
    STAGE_NO_ROW,
)


def tag_stages(raw: DataFrame) -> DataFrame:
    """Parse a raw text reading and tag it with its stage.

    Input columns: site, date_text, time_text, level_text, baro_text, comment, src_file.
    Adds ts (TIMESTAMP_NTZ), level_ft, baro_hpa (DOUBLE, NULL when invalid) and stage (INT);
    ``malformed`` (row had more fields than its header) is carried, FALSE when absent. Rows with a
    ``file_state`` (folder sources: they stand for a file, not for a reading) have stage 0.
    """
    require_types(raw, {c: T.StringType() for c in ("date_text", "time_text", "level_text", "baro_text")}, "tag_stages")
    parsed = F.struct(
        parse_date_time(F.col("date_text"), F.col("time_text")).alias("ts"),
        to_number(F.col("level_text")).alias("level_ft"),
        to_number(F.col("baro_text")).alias("baro_hpa"),
    )
    malformed = F.col("malformed") if "malformed" in raw.columns else F.lit(False)
    # Parsed once per row: a one-element inline is a plan barrier for filters on its outputs, so
    # a later filter (on stage, ts, ...) is not rewritten into repeated parsing of the raw text.
    states = [c for c in ("file_state",) if c in raw.columns]
    out = raw.select(
        "site",
        *states,
        F.col("comment"),
        "src_file",
        malformed.alias("malformed"),
        F.inline(F.array(parsed)),
    ).select("site", "ts", "level_ft", "baro_hpa", "comment", "src_file", "malformed", *states)
    stage = F.when(F.col("file_state").isNotNull(), F.lit(STAGE_NO_ROW)) if states else F
    stage = (
        stage.when(F.col("ts").isNull(), F.lit(STAGE_BAD_DATETIME))
        .when(F.col("level_ft").isNull() | F.col("baro_hpa").isNull(), F.lit(STAGE_BAD_NUMERIC))
        .when(F.col("level_ft") < 0, F.lit(STAGE_NEGATIVE))
        .otherwise(F.lit(STAGE_KEPT))
    )
    return out.withColumn("stage", stage)


def drop_invalid(tagged: DataFrame) -> DataFrame:
    """Drop rows with an invalid timestamp, level or pressure (negative levels are kept)."""
    return tagged.where(F.col("stage") > STAGE_BAD_NUMERIC)


def nonneg_filter(df: DataFrame, level: str = "level_ft") -> DataFrame:
    """``level >= 0``; NaN was already mapped to NULL, so it cannot pass."""
    return df.where(F.col(level) >= 0)


def stage_reason(max_stage):
    """Placeholder reason for a file whose furthest stage is ``max_stage`` (NULL when kept)."""
    return (
        F.when(max_stage == STAGE_BAD_DATETIME, F.lit(REASON_BAD_DATETIME))
        .when(max_stage == STAGE_BAD_NUMERIC, F.lit(REASON_BAD_NUMERIC))
        .when(max_stage == STAGE_NEGATIVE, F.lit(REASON_NEGATIVE))
    )


def stage_counts() -> list:
    """Aggregates counting rows per stage (A3), usable in any groupBy."""
    return [
        F.count_if(F.col("stage") == STAGE_BAD_DATETIME).alias("n_bad_datetime"),
        F.count_if(F.col("stage") == STAGE_BAD_NUMERIC).alias("n_bad_numeric"),
        F.count_if(F.col("stage") == STAGE_NEGATIVE).alias("n_negative"),
        F.count_if(F.col("stage") == STAGE_KEPT).alias("n_kept"),
    ]
