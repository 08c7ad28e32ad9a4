"""Depth conversion (J3, F12), dry flag (C9, P11) and pressure correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrocal.functions import adjusted_depth, raw_depth, specific_gravity
from hydrocal.operators.gaps import has_placeholder_prefix
from hydrocal.operators.joins import checked_join
from hydrocal.sources.site_config import lookup_table
from hydrocal.schemas import (
    CONVERSION_DEFAULT,
    CONVERSION_DIVIDE_BY_100,
    DRY_COMMENT,
    REFERENCE_DENSITY,
    WATER_DENSITY,
)


def convert_depth(
    readings: DataFrame,
    site_cfg: DataFrame | None = None,
    level: str = "level_ft",
    default_type: str = CONVERSION_DEFAULT,
    cfg_small: bool | None = None,
) -> DataFrame:
    """J3 + F12 + F13: look up each site's conversion type (``default_type`` when the site is not
    configured) and compute ``depth_raw_m``. Adds ``conversion_type`` and ``unknown_conversion``
    (type neither ``default`` nor ``divide_by_100``: converted as feet; the validation's quality
    table reports such sites). ``cfg_small`` passes a size check already made, of a table of one row a site."""
    if site_cfg is None:
        df, ctype = readings, F.lit(default_type)
    else:
        cfg = site_cfg if cfg_small is not None else lookup_table(site_cfg)
        cfg = cfg.select("site", F.col("depth_conversion_type").alias("_ctype"))
        df = checked_join(readings, cfg, "site", "left", small=cfg_small)
        ctype = F.coalesce(F.col("_ctype"), F.lit(default_type))
    keep = [c for c in df.columns if c not in ("_ctype", "conversion_type", "depth_raw_m", "unknown_conversion")]
    return df.select(
        *keep,
        ctype.alias("conversion_type"),
        raw_depth(F.col(level), ctype).alias("depth_raw_m"),
        (~ctype.isin(CONVERSION_DEFAULT, CONVERSION_DIVIDE_BY_100)).alias("unknown_conversion"),
    )


def flag_dry(daily: DataFrame) -> DataFrame:
    """``depth_raw_m <= 0`` with an empty comment gets the equipment/dry comment.

    Rows with a ``Placeholder:`` comment are skipped (P10); placeholders have NULL depth.
    """
    dry = (
        (F.col("depth_raw_m") <= 0)
        & F.col("depth_raw_m").isNotNull()
        & (F.coalesce(F.col("comment"), F.lit("")) == "")
        & ~has_placeholder_prefix(F.col("comment"))
    )
    updates = {"comment": F.when(dry, F.lit(DRY_COMMENT)).otherwise(F.col("comment"))}
    if "flag" in daily.columns:
        updates["flag"] = F.when(dry, F.lit("dry")).otherwise(F.col("flag"))
    return daily.withColumns(updates)


def adjust_depth(
    daily: DataFrame, water_density: float = WATER_DENSITY, reference_density: float = REFERENCE_DENSITY
) -> DataFrame:
    """``depth_adj_m`` from raw depth, logger and external pressure."""
    sg = specific_gravity(water_density, reference_density)
    return daily.withColumn(
        "depth_adj_m",
        adjusted_depth(F.col("depth_raw_m"), F.col("baro_hpa"), F.col("bom_hpa"), sg),
    )
