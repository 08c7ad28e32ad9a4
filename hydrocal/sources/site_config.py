"""Site configuration and file-pair manifest sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.schemas import CONVERSION_DEFAULT

MANIFEST_SCHEMA = "array<struct<name:string,nav_option:string,main_csv:string,baro_csv:string>>"


def config_entries(doc: Column) -> Column:
    """array<struct<site, depth_conversion_type>> from a JSON object ``{site: {options}}``.

    Bad JSON or a non-object document gives no entries. The map is parsed with string values
    first, then each value on its own, so one malformed entry cannot void the whole document; a
    value that is not an object keeps its site with the default conversion.
    """
    parsed = F.coalesce(F.from_json(doc, "map<string,string>"), F.create_map().cast("map<string,string>"))
    return F.transform(
        F.map_entries(parsed),
        lambda e: F.named_struct(
            F.lit("site"),
            e["key"],
            F.lit("depth_conversion_type"),
            F.coalesce(F.get_json_object(e["value"], "$.depth_conversion_type"), F.lit(CONVERSION_DEFAULT)),
        ),
    )


def config_from_json(docs: DataFrame, json_col: str, keys: list[str] | None = None) -> DataFrame:
    """S7 over a column of JSON documents: one (site, depth_conversion_type) row per entry."""
    keys = keys or []
    return docs.select(*keys, F.inline(config_entries(F.col(json_col))))


def lookup_table(site_cfg: DataFrame) -> DataFrame:
    """One row per site, so that a config lookup (J3) matches at most once even when several
    documents name the same site (the largest type name wins, deterministically)."""
    return site_cfg.groupBy("site").agg(F.max("depth_conversion_type").alias("depth_conversion_type"))


def site_config(spark: SparkSession, json_text: str | None) -> DataFrame:
    """S7 for one configuration document held by the caller (the expected-site list)."""
    doc = spark.createDataFrame([(json_text,)], "doc string")
    return config_from_json(doc, "doc")


def manifest_from_json(docs: DataFrame, json_col: str, keys: list[str] | None = None) -> DataFrame:
    """``[{name, nav_option, main_csv, baro_csv}]`` -> one row per site pair (with ``keys`` of its
    document). Bad JSON gives no rows; a field that an entry lacks is NULL."""
    arr = F.coalesce(F.from_json(F.col(json_col), MANIFEST_SCHEMA), F.array().cast(MANIFEST_SCHEMA))
    return docs.select(*(keys or []), F.inline(arr))
