"""Placeholder rows for missing, failed and stale sites."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrocal.functions import day_start, month_year, months_before, reason_text
from hydrocal.schemas import (
    PLACEHOLDER_PREFIX,
    REASON_MISSING_FILE,
    REASON_STALE_PREFIX,
    STALE_MONTHS,
)

# Columns of a daily row (site-day table) before the barometer join.


def ts_lit(value: str | _dt.datetime | Column) -> Column:
    """A TIMESTAMP_NTZ literal from ``YYYY-MM-DD HH:MM:SS`` text or a naive datetime."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def placeholders(site_reasons: DataFrame, run_ts, src_file: Column | None = None) -> DataFrame:
    """One row per (site, reason): midnight of the run day, NULL values and the comment
    ``<reason> on dd/MM/yyyy HH:mm:ss`` (one select over the input, never a per-site loop)."""
    run = ts_lit(run_ts)
    return site_reasons.select(
        F.col("site"),
        day_start(run).alias("ts"),
        F.lit(None).cast("double").alias("level_ft"),
        F.lit(None).cast("double").alias("baro_hpa"),
        reason_text(F.col("reason"), run).alias("comment"),
        (src_file if src_file is not None else F.lit(None).cast("string")).alias("src_file"),
        F.lit("placeholder").alias("flag"),
    )


def missing_sites(expected: DataFrame, processed: DataFrame) -> DataFrame:
    """Expected sites without any file (left anti join on site)."""
    seen = processed.select("site").distinct()  # partial aggregate before any shuffle
    return expected.select("site").distinct().join(seen, "site", "left_anti")


def missing_site_placeholders(expected: DataFrame, processed: DataFrame, run_ts) -> DataFrame:
    """J4 + C5: ``Site CSV file not found`` rows for expected sites without a file."""
    reasons = missing_sites(expected, processed).withColumn("reason", F.lit(REASON_MISSING_FILE))
    return placeholders(reasons, run_ts)


def has_placeholder_prefix(comment: Column) -> Column:
    """P10: rows that arrived with a ``Placeholder:`` comment bypass the stale and dry checks."""
    return F.coalesce(comment, F.lit("")).startswith(PLACEHOLDER_PREFIX)


def latest_per_site(df: DataFrame, site: str = "site", ts: str = "ts") -> DataFrame:
    """A1: latest timestamp per site (partial + final hash aggregate)."""
    return df.groupBy(site).agg(F.max(ts).alias("latest_ts"))


def replace_stale(daily: DataFrame, run_ts, months: int = STALE_MONTHS) -> DataFrame:
    """A site whose latest reading is strictly older than ``run_ts - months`` loses all its
    rows and gets one ``No telemetry data received for <Month YYYY>`` row instead.

    ``daily`` must hold at most one row per site and calendar day (the output of W2), as in the
    validated flow; a window partition then holds at most one row per day, whatever the raw volume
    of the site. Rows with a ``Placeholder:`` comment neither count nor get removed (P10). One
    window over ``site`` (ordered so that the site's first counted row comes first) gives both the
    latest time and the row that turns into the placeholder, so the plan does not branch and, on
    input already hash-partitioned by site, adds no exchange.
    """
    run = ts_lit(run_ts)
    pref = has_placeholder_prefix(F.col("comment"))
    marked = daily.select("*", pref.alias("_pref"))
    w = Window.partitionBy("site").orderBy(F.col("_pref").asc(), F.col("ts").asc_nulls_last())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    latest = F.max(F.when(~F.col("_pref"), F.col("ts"))).over(whole)
    stale = F.coalesce(latest < months_before(run, months), F.lit(False)) & ~F.col("_pref")
    marked = marked.select("*", stale.alias("_stale"), F.row_number().over(w).alias("_rn"))
    out = marked.where(~F.col("_stale") | (F.col("_rn") == 1))
    turn = F.col("_stale")
    reason = F.concat(F.lit(REASON_STALE_PREFIX + " "), month_year(run))
    replaced = {
        "ts": F.when(turn, day_start(run)).otherwise(F.col("ts")),
        "comment": F.when(turn, reason_text(reason, run)).otherwise(F.col("comment")),
    }
    if "flag" in daily.columns:
        replaced["flag"] = F.when(turn, F.lit("placeholder")).otherwise(F.col("flag"))
    cols = []
    for c in daily.columns:
        if c == "site":
            cols.append(F.col(c))
        else:
            cols.append(replaced.get(c, F.when(~turn, F.col(c))).alias(c))  # other values -> NULL
    return out.select(*cols)
