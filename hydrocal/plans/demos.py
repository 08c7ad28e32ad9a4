"""Registered queries over the driver tables (``__spark_entry__.queries``).

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Inputs come from
``hydrocal.sources.standins`` (role mapping documented there); all work is done by the library's
operators over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrocal.functions import file_stem, parse_date_time, to_number
from hydrocal.operators.barometer import ampm_readings, attach_baro, daily_barometer, unpivot_ampm
from hydrocal.operators.clean import drop_invalid, nonneg_filter, tag_stages
from hydrocal.operators.dedup import first_per_site_day
from hydrocal.operators.depth import adjust_depth, convert_depth, flag_dry
from hydrocal.operators.gaps import latest_per_site, missing_site_placeholders, replace_stale
from hydrocal.operators.merge import merge_level_baro, union_by_name
from hydrocal.operators.quality import quality_counts, rows_per_site, run_metrics, run_summary, site_status
from hydrocal.plans.validate import Validation, file_day_summary, file_outcomes, listing_placeholders, validate
from hydrocal.schemas import MAIN_REPORT_COLUMNS, R_ADJ, R_COMMENT, R_SITE, R_TS, R_UPLOAD_DEPTH, REASON_EMPTY_FILE, UPLOAD_REPORT_COLUMNS
from hydrocal.session import scratch_path, table
from hydrocal.sinks.publish import Publication, current
from hydrocal.sinks.reports import MAIN_NAME, UPLOAD_NAME, report_main, report_upload, write_reports
from hydrocal.sources import standins as S
from hydrocal.sources.csv_folder import read_pairs, read_site_folder
from hydrocal.sources.html_tables import html_items
from hydrocal.sources.site_config import config_from_json, manifest_from_json

# Run parameters of the demonstrations (the events cover January 2024, orders 1995-2001).
EVENTS_RUN_TS = "2024-03-29 18:00:00"
EVENTS_MONTH, EVENTS_YEAR = 1, 2024
ORDERS_RUN_TS = "2001-08-01 00:00:00"
SEA_WATER_DENSITY = 1025.0

READING_COLS = ["site", "ts", "level_ft", "baro_hpa", "comment", "src_file"]


def _site_cfg(spark: SparkSession, sf: str) -> DataFrame:
    return config_from_json(S.config_docs(spark, sf), "doc")


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return first_per_site_day(S.logger_readings(spark, sf))


def _validation(spark: SparkSession, sf: str) -> Validation:
    return validate(
        S.logger_raw(spark, sf),
        EVENTS_RUN_TS,
        weather=S.weather_raw(spark, sf),
        site_cfg=_site_cfg(spark, sf),
    )


# --- W1 / W2 / J2 / S10 --------------------------------------------------------------------------


def q_first_per_site_day(spark, sf):
    """First reading per (site, day)."""
    return _daily(spark, sf).select(*READING_COLS)


def q_first_per_day(spark, sf):
    """Daily external barometer from the weather feed text."""
    return daily_barometer(S.weather_raw(spark, sf))


def q_join_daily_baro(spark, sf):
    """First readings joined with the daily barometer on calendar day."""
    out = attach_baro(_daily(spark, sf), daily_barometer(S.weather_raw(spark, sf)))
    return out.select("site", "ts", "level_ft", "baro_hpa", "bom_hpa")


def q_baro_absent(spark, sf):
    """The feed parsed from ``pages`` holds no data table, so every bom_hpa is NULL."""
    feed = daily_barometer(ampm_readings(table(spark, sf, "pages"), EVENTS_MONTH, EVENTS_YEAR))
    out = attach_baro(_daily(spark, sf), feed)
    return out.select("site", "ts", "level_ft", "baro_hpa", "bom_hpa")


# --- J1 / S7 / S2 / J3 / C10 ---------------------------------------------------------------------


def _hourly_text(ev: DataFrame) -> DataFrame:
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("site"),
        F.date_format("ts", "dd/MM/yyyy").alias("date_text"),
        F.date_format("ts", "HH:00:00").alias("time_text"),
        F.col("value").cast("string").alias("value_text"),
    )


def q_merge_level_baro(spark, sf):
    """Events of even id (level) left-joined with those of odd id (logger pressure) of the same site,
    date text and hour text; several pressures of one hour multiply the level row."""
    ev = table(spark, sf, "events")
    level = _hourly_text(ev.where(F.col("event_id") % 2 == 0)).withColumnRenamed("value_text", "level_text")
    baro = _hourly_text(ev.where(F.col("event_id") % 2 != 0)).withColumnRenamed("value_text", "baro_text")
    merged = merge_level_baro(level, baro)
    return merged.select(
        "event_id",
        "site",
        "date_text",
        "time_text",
        to_number(F.col("level_text")).alias("level_ft"),
        to_number(F.col("baro_text")).alias("baro_hpa"),
    )


def q_config_from_json(spark, sf):
    """Per-customer JSON documents -> (site, depth_conversion_type)."""
    return config_from_json(S.config_docs(spark, sf), "doc", keys=["c_custkey"])


def q_manifest_from_json(spark, sf):
    """Per-supplier manifests -> one row per level/barometer file pair."""
    return manifest_from_json(S.manifest_docs(spark, sf), "doc", keys=["s_suppkey"])


def q_site_from_path(spark, sf):
    """Site name = stem of the last path segment of each page URL."""
    return table(spark, sf, "pages").select("page_id", file_stem(F.col("url")).alias("site"))


def q_convert_depth(spark, sf):
    """J3 + F12: raw depth with each site's configured conversion (default when not configured)."""
    out = convert_depth(_daily(spark, sf), _site_cfg(spark, sf))
    return out.select("site", "ts", "level_ft", "conversion_type", "depth_raw_m", "unknown_conversion")


def q_adjust_depth(spark, sf):
    """W2 -> J3 -> J2 -> pressure-corrected depth."""
    daily = convert_depth(_daily(spark, sf), _site_cfg(spark, sf))
    daily = attach_baro(daily, daily_barometer(S.weather_raw(spark, sf)))
    out = adjust_depth(daily)
    return out.select("site", "ts", "depth_raw_m", "baro_hpa", "bom_hpa", "depth_adj_m")


def q_adjust_depth_density(spark, sf):
    """C10 in water of 1025, and with a reference density of 0, which leaves every depth unadjusted."""
    daily = convert_depth(_daily(spark, sf), _site_cfg(spark, sf))
    daily = attach_baro(daily, daily_barometer(S.weather_raw(spark, sf)))
    salt = adjust_depth(daily, water_density=SEA_WATER_DENSITY).withColumnRenamed("depth_adj_m", "depth_adj_sea_m")
    out = adjust_depth(salt, reference_density=0.0).withColumnRenamed("depth_adj_m", "depth_adj_invalid_m")
    return out.select("site", "ts", "depth_raw_m", "depth_adj_sea_m", "depth_adj_invalid_m")


# --- F1 / F2 / F11 / P6 / P7 ---------------------------------------------------------------------


def _raw_with_id(spark, sf):
    return S.logger_raw(spark, sf, keep_id=True)


def q_parse_datetime(spark, sf):
    """F1 + F2: strict day-first parse of every rendered Date/Time pair."""
    raw = _raw_with_id(spark, sf)
    return raw.select("event_id", "date_text", "time_text", parse_date_time(F.col("date_text"), F.col("time_text")).alias("ts"))


def q_parse_numeric(spark, sf):
    """numeric coercion of every rendered level and pressure text."""
    raw = _raw_with_id(spark, sf)
    return raw.select(
        "event_id",
        to_number(F.col("level_text")).alias("level_ft"),
        to_number(F.col("baro_text")).alias("baro_hpa"),
    )


def q_drop_invalid(spark, sf):
    """Rows with a valid timestamp, level and pressure (negative levels still present)."""
    tagged = tag_stages(_raw_with_id(spark, sf))
    return drop_invalid(tagged).select("src_file", "ts", "level_ft", "baro_hpa")


def q_nonneg_filter(spark, sf):
    """Readings with ``level - 5 >= 0``."""
    r = S.logger_readings(spark, sf).withColumn("level_ft", F.col("level_ft") - F.lit(5.0))
    return nonneg_filter(r).select(*READING_COLS)


# --- J4 / A1 / C8 / C9 / P10 ---------------------------------------------------------------------


def q_missing_sites(spark, sf):
    """J4 + C5: customers whose site has no logger event get a ``Site CSV file not found`` placeholder."""
    expected = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("site"))
    out = missing_site_placeholders(expected, S.logger_readings(spark, sf), ORDERS_RUN_TS)
    return out.select("site", "ts", "comment", "flag")


def q_latest_per_site(spark, sf):
    """A1: latest order time per customer site."""
    return latest_per_site(S.order_readings(spark, sf))


def q_stale_rows(spark, sf):
    """W2 + C8: first order per customer-day; customers without orders in the two months before the
    run collapse to one placeholder."""
    daily = first_per_site_day(S.order_readings(spark, sf).withColumn("flag", F.lit(None).cast("string")))
    out = replace_stale(daily, ORDERS_RUN_TS)
    return out.select("site", "ts", "level_ft", "comment", "src_file", "flag")


def q_flag_dry(spark, sf):
    """Every site divides by 100, so small levels round to 0.00 m and are flagged."""
    daily = _daily(spark, sf).withColumn("flag", F.lit(None).cast("string"))
    daily = convert_depth(daily, default_type="divide_by_100")
    return flag_dry(daily).select("site", "ts", "depth_raw_m", "comment", "flag")


def q_comment_split(spark, sf):
    """P10: rows arriving with a ``Placeholder:`` comment bypass the stale and dry checks."""
    ev = S.logger_events(spark, sf)
    readings = ev.select(
        F.col("user_id").cast("string").alias("site"),
        "ts",
        (F.col("value") / F.lit(100.0)).alias("level_ft"),
        F.lit(None).cast("double").alias("baro_hpa"),
        F.when(F.col("event_type") == "error", F.lit("Placeholder: logger reported an error"))
        .otherwise(F.lit(""))
        .alias("comment"),
        F.concat(F.col("user_id").cast("string"), F.lit(".csv")).alias("src_file"),
        F.lit(None).cast("string").alias("flag"),
    )
    daily = convert_depth(first_per_site_day(readings))
    out = flag_dry(replace_stale(daily, EVENTS_RUN_TS))
    return out.select("site", "ts", "depth_raw_m", "comment", "flag")


def q_stream_first_per_site_day(spark, sf):
    """§2.11: W2 as a Structured Streaming job (each micro-batch reduced to its first readings and
    appended to the shared checkpoint folder), settled into the batch answer."""
    from hydrocal.streaming.daily import run_first_per_site_day

    return run_first_per_site_day(spark, S.logger_readings_stream(spark, sf)).select(*READING_COLS)


# --- U1 / U4 / S9 --------------------------------------------------------------------------------


def q_union_by_name(spark, sf):
    """U1 + P2: suppliers and customers in one frame, absent columns NULL."""
    return union_by_name(table(spark, sf, "supplier"), table(spark, sf, "customer"))


def q_unpivot_ampm(spark, sf):
    """U4: weather-table rows rendered from events -> AM/PM readings."""
    rows = S.weather_table_rows(spark, sf)
    out = unpivot_ampm(rows, EVENTS_MONTH, EVENTS_YEAR, keys=["event_id"])
    return out.select("event_id", "date_text", "time_text", to_number(F.col("hpa_text")).alias("hpa"))


def q_weather_readings(spark, sf):
    """S9 + C2 + F10: station pages -> table rows -> AM/PM readings with their parsed time."""
    return _readings(S.weather_pages(spark, sf))


def _readings(pages):
    out = ampm_readings(pages, EVENTS_MONTH, EVENTS_YEAR, keys=["event_id"])
    ts = parse_date_time(F.col("date_text"), F.col("time_text"))
    return out.select("event_id", "date_text", "time_text", ts.alias("ts"), to_number(F.col("hpa_text")).alias("hpa"))


def q_weather_markup(spark, sf):
    """S9 + F18 + C2: readings from pages with commented-out and nested tables, missing end tags, scripts
    and character references."""
    return _readings(S.odd_weather_pages(spark, sf))


def q_weather_daily(spark, sf):
    """C2 + C3: station pages -> one pressure per day."""
    return daily_barometer(ampm_readings(S.weather_pages(spark, sf), EVENTS_MONTH, EVENTS_YEAR))


def q_html_items(spark, sf):
    """Text of every ``<li>`` element of every page."""
    return html_items(table(spark, sf, "pages"), "li", keys=["page_id"])


# --- C11 / A2 / A3 / A5 / A7 / C13 ---------------------------------------------------------------


def q_validate(spark, sf):
    """Full validation of the rendered logger exports."""
    return _validation(spark, sf).final


def q_report_main(spark, sf):
    """K1: main report rows."""
    return report_main(_validation(spark, sf).final)


def q_report_upload(spark, sf):
    """K2: upload report rows (adjusted depth present)."""
    return report_upload(_validation(spark, sf).final)


def q_report_files(spark, sf):
    """The report files of a published run, read back: each line, which report it is of,
    its place within its file (the files of a report together are in (site, time) order)."""
    pub = Publication(spark, scratch_path(spark, "reports"))
    final = pub.parquet("validated.parquet", _validation(spark, sf).final)
    write_reports(spark.read.parquet(final), pub.base, typed=False)
    pub.commit()
    out = None
    for name, schema in ((MAIN_NAME, MAIN_REPORT_COLUMNS), (UPLOAD_NAME, UPLOAD_REPORT_COLUMNS)):
        texts = ", ".join(f"`{c}` string" for c in schema)
        lines = spark.read.schema(texts).option("header", True).option("escape", '"').csv(f"{current(spark, pub.folder.root)}/{name}")
        ts = F.to_timestamp_ntz(F.col(f"`{R_TS}`"), F.lit("dd/MM/yyyy hh:mm:ss a"))
        own = Window.partitionBy("file").orderBy("line")
        lines = lines.withColumn("file", F.col("_metadata.file_name")).withColumn("line", F.monotonically_increasing_id()).withColumn("key", F.struct(F.col(f"`{R_SITE}`"), ts))
        lines = lines.withColumn("in_order", F.coalesce(F.lag("key").over(own) <= F.col("key"), F.lit(True)))
        kept = lines.select(F.lit(name).alias("report"), F.col(f"`{R_SITE}`").alias("site"), F.col(f"`{R_TS}`").alias("ts_text"), F.col(f"`{R_ADJ if name == MAIN_NAME else R_UPLOAD_DEPTH}`").cast("double").alias("depth"), F.coalesce(F.col(f"`{R_COMMENT}`"), F.lit("")).alias("comment"), "in_order")
        out = kept if out is None else out.unionByName(kept)
    return out


def q_rows_per_site(spark, sf):
    """A2: rows per site in the validated table."""
    return rows_per_site(_validation(spark, sf).final)


def q_quality_counts(spark, sf):
    """A3: per-site rows dropped at each stage and kept."""
    return quality_counts(tag_stages(S.logger_raw(spark, sf)).withColumn("site", file_stem(F.col("src_file"))))


def q_file_outcomes(spark, sf):
    """C4 outcome per file: furthest stage, counts and placeholder reason (tagging, the file-day
    summary and its per-file aggregate; no full validation needed)."""
    out = file_outcomes(file_day_summary(tag_stages(S.logger_raw(spark, sf))))
    return out.select("src_file", "site", "max_stage", "n_bad_datetime", "n_bad_numeric", "n_negative", "n_kept", "reason")


def q_listing_placeholders(spark, sf):
    """Files without bytes, and readable files that gave no row, among the customers' files."""
    outcomes = file_outcomes(file_day_summary(tag_stages(S.logger_raw(spark, sf))))
    out = listing_placeholders(S.customer_files(spark, sf), outcomes, EVENTS_RUN_TS)
    return out.select("site", "ts", "comment", "src_file", "flag")


def q_folder_outcomes(spark, sf):
    """Outcome of each file of a landing folder that Spark writes from the events: comments over
    several lines, a missing column, a surplus field, a header alone, no bytes."""
    inp = read_site_folder(spark, S.site_folder(spark, sf))
    out = file_outcomes(file_day_summary(tag_stages(inp.rows)))
    counts = ["n_bad_datetime", "n_bad_numeric", "n_negative", "n_kept"]
    out = inp.listing.join(out.drop("site"), "src_file", "left")
    reason = F.when(F.col("status") == "zero_bytes", F.lit(REASON_EMPTY_FILE)).otherwise(F.col("reason"))
    return out.select(S.file_number().alias("file"), *[F.when(~F.col("rejected"), F.col(c)).otherwise(0).alias(c) for c in counts], F.coalesce("rejected", F.lit(False)).alias("rejected"), reason.alias("reason"))


def q_folder_pairs(spark, sf):
    """Level files merged with their barometer files, from a folder and manifest that Spark
    writes from the events; hours without a date are equal keys, and comments have line breaks."""
    rows = read_pairs(spark, *S.pair_folder(spark, sf)).raw
    return rows.select(S.file_number().alias("file"), "date_text", "time_text", "level_text", "baro_text", "comment")


def q_site_status(spark, sf):
    """Typed status per site of the validated table."""
    v = _validation(spark, sf)
    return site_status(v.final, v.rejected_files)


def q_run_summary(spark, sf):
    """One row of site counts by status (names stay in the per-site table)."""
    return run_summary(q_site_status(spark, sf))


def q_run_metrics(spark, sf):
    """Run counters of the validated table (merged, dry, adjusted, placeholder rows)."""
    return run_metrics(_validation(spark, sf).final)


QUERIES = {
    "listing_placeholders": q_listing_placeholders,
    "folder_outcomes": q_folder_outcomes,
    "folder_pairs": q_folder_pairs,
    "first_per_site_day": q_first_per_site_day,
    "first_per_day": q_first_per_day,
    "stream_first_per_site_day": q_stream_first_per_site_day,
    "join_daily_baro": q_join_daily_baro,
    "baro_absent": q_baro_absent,
    "merge_level_baro": q_merge_level_baro,
    "config_from_json": q_config_from_json,
    "manifest_from_json": q_manifest_from_json,
    "site_from_path": q_site_from_path,
    "convert_depth": q_convert_depth,
    "adjust_depth": q_adjust_depth,
    "adjust_depth_density": q_adjust_depth_density,
    "parse_datetime": q_parse_datetime,
    "parse_numeric": q_parse_numeric,
    "drop_invalid": q_drop_invalid,
    "nonneg_filter": q_nonneg_filter,
    "missing_sites": q_missing_sites,
    "latest_per_site": q_latest_per_site,
    "stale_rows": q_stale_rows,
    "flag_dry": q_flag_dry,
    "comment_split": q_comment_split,
    "union_by_name": q_union_by_name,
    "unpivot_ampm": q_unpivot_ampm,
    "weather_readings": q_weather_readings,
    "weather_markup": q_weather_markup,
    "weather_daily": q_weather_daily,
    "html_items": q_html_items,
    "validate": q_validate,
    "report_main": q_report_main,
    "report_upload": q_report_upload,
    "report_files": q_report_files,
    "rows_per_site": q_rows_per_site,
    "quality_counts": q_quality_counts,
    "file_outcomes": q_file_outcomes,
    "site_status": q_site_status,
    "run_summary": q_run_summary,
    "run_metrics": q_run_metrics,
}
