"""Depth formulas as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrocal.functions.numeric import round2
from hydrocal.schemas import (
    CONVERSION_DIVIDE_BY_100,
    FEET_TO_METRES,
    HPA_TO_PSI,
    SENSOR_FACTOR,
)


def raw_depth(level: Column, conversion_type: Column) -> Column:
    """F12 + F13: ``divide_by_100`` -> level/100, anything else -> feet to metres; rounded."""
    return round2(
        F.when(conversion_type == F.lit(CONVERSION_DIVIDE_BY_100), level / F.lit(100.0)).otherwise(
            level * F.lit(FEET_TO_METRES)
        )
    )


def specific_gravity(water_density: float, reference_density: float) -> float | None:
    """SG, or None when either density check fails (then every adjusted depth is NULL)."""
    if reference_density <= 0:
        return None
    sg = water_density / reference_density
    return sg if sg > 0 else None


def adjusted_depth(raw: Column, logger_hpa: Column, bom_hpa: Column, sg: float | None) -> Column:
    """F14 + F13: ``raw + 0.70307 * ((logger - bom) * 0.0145038) / SG`` rounded; NULL when any
    operand is NULL (P8 by NULL propagation) or when SG is invalid."""
    if sg is None:
        return F.lit(None).cast("double")
    delta_psi = (logger_hpa - bom_hpa) * F.lit(HPA_TO_PSI)
    return round2(raw + F.lit(SENSOR_FACTOR) * delta_psi / F.lit(float(sg)))
