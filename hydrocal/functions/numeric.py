"""Numeric Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Java-style float suffixes and hexadecimal floats that ``CAST AS DOUBLE`` accepts but the export
# validator rejects.
_JAVA_FLOAT = r"(?i)[0-9.][df]\s*$|^[+-]?0x"


def to_number(text: Column) -> Column:
    """text -> DOUBLE; errors, NaN and numbers too large for a double -> NULL, +-Infinity kept.

    Every missing-value token of the exports either fails the cast or reads as NaN, so both end as
    NULL. NaN is mapped to NULL straight away: Spark orders NaN above every number, so ``NaN >= 0``
    would be true, while the validated semantics treat NaN as missing.
    """
    trimmed = F.trim(text)
    num = F.when(~trimmed.rlike(_JAVA_FLOAT), trimmed.try_cast("double"))
    num = F.nanvl(num, F.lit(None).cast("double"))
    return F.when((F.abs(num) < float("inf")) | ~trimmed.rlike("[0-9]"), num)


def round2(x: Column) -> Column:
    """round to 2 decimals, half-to-even on the binary value (x*100 rounded, then /100).

    ``round``/``bround`` work on the decimal expansion and differ (0.575 -> 0.58 vs 0.57).
    """
    return F.rint(x * F.lit(100.0)) / F.lit(100.0)
