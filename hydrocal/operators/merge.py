"""Level/barometer merge (C1, J1) and union by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrocal.functions import to_number
from hydrocal.operators.dedup import first_by
from hydrocal.operators.joins import skew_join


def unique_baro(baro: DataFrame) -> DataFrame:
    """One barometer row per (site, date_text, time_text): the lowest valid pressure first, then
    the text. After this optional step duplicate keys no longer multiply level rows."""
    order = [to_number(F.col("baro_text")).asc_nulls_last(), F.col("baro_text").asc_nulls_last()]
    return first_by(baro, ["site", "date_text", "time_text"], order)


def merge_level_baro(level: DataFrame, baro: DataFrame) -> DataFrame:
    """Plain left join; every level row gets the logger pressure text of each barometer row of
    the same site, date text and time text (NULL keys match NULL keys, like the export merge).

    A pressure column already on the level side (a file merged before) is replaced, never
    suffixed. Keys are the raw strings: no parsing happens before the merge. Barometer rows that
    share a key multiply their level rows; ``unique_baro`` is the separate step that prevents it. Keys
    with many level rows (NULL keys among them) are salted (``skew_join``).
    """
    keys = ["site", "date_text", "time_text"]
    return skew_join(level.drop("baro_text"), baro.select(*keys, "baro_text"), keys)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns absent from a frame are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
