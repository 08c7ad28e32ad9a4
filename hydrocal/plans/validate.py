"""Full validation (C13). Building it writes the file-day summary and the two dimensions and measures
the dimensions; everything after that is one lazy Catalyst plan.

Shape of the plan, designed for very large raw inputs with hot sites:

1. Raw rows are parsed and tagged with their stage (row-local, no shuffle).
2. One aggregation keyed on (file, day) computes per-stage counts and the first kept reading of
   the day; the site (stem of the file name) is derived afterwards, once per file-day. Partial
   aggregation runs before the exchange, so a site or file holding a third of all rows ships at
   most one row per day per task. Everything after this point works on at most one row per
   file-day.
3. That small summary is materialised once in the shared checkpoint folder (lineage cut, survives
   executor loss). File outcomes (placeholder reasons), quality counts and the daily candidates
   all read it, so the raw input is scanned exactly once.
4. Candidates (first readings + placeholders) are hash-partitioned once by ``site``; the keep-first
   per (site, day) window and the per-site staleness window both run on that partitioning, and the
   stale replacement does not branch the plan.
5. The site configuration and the daily barometer are each evaluated once, into small tables, and
   broadcast after a check of their size in bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrocal.operators.barometer import attach_baro, daily_barometer
from hydrocal.functions.text import file_stem
from hydrocal.operators.clean import stage_counts, stage_reason, tag_stages
from hydrocal.operators.dedup import first_per_site_day
from hydrocal.operators.depth import adjust_depth, convert_depth, flag_dry
from hydrocal.operators.gaps import missing_site_placeholders, placeholders, replace_stale
from hydrocal.operators.joins import fits_broadcast_all
from hydrocal.operators.merge import union_by_name
from hydrocal.session import cut_lineage
from hydrocal.sources.site_config import lookup_table
from hydrocal.schemas import require_types
from hydrocal.schemas import (
    CONVERSION_DEFAULT,
    CONVERSION_DIVIDE_BY_100,
    REASON_CSV_EMPTY,
    REASON_EMPTY_FILE,
    REFERENCE_DENSITY,
    STAGE_KEPT,
    STAGE_NO_ROW,
    WATER_DENSITY,
)

FINAL_COLUMNS = [
    "site",
    "ts",
    "bom_hpa",
    "baro_hpa",
    "depth_raw_m",
    "depth_adj_m",
    "comment",
    "flag",
    "level_ft",
    "src_file",
]


@dataclass
class Validation:
    """Result frames of one validation run: lazy, over the tables that ``validate`` has written."""

    final: DataFrame  # one row per site-day plus placeholder rows, FINAL_COLUMNS
    file_outcomes: DataFrame  # src_file, site, max_stage, per-stage counts, reason
    quality: DataFrame  # site, per-stage row counts, unknown_conversion
    rejected_files: DataFrame  # src_file, site: files unreadable as a whole (no rows, no placeholder)


def file_day_summary(tagged: DataFrame) -> DataFrame:
    """Step 2: per (file, day) stage counts and the first kept reading of the day; the site is
    the stem of the file name (S2)."""
    kept = F.col("stage") == STAGE_KEPT
    first = F.min(
        F.when(
            kept,
            F.struct(
                F.col("ts"),
                F.col("level_ft"),
                F.col("baro_hpa"),
                F.coalesce(F.col("comment"), F.lit("")).alias("comment"),
            ),
        )
    )
    # The site depends only on the file, so it is derived after the aggregation: once per
    # file-day instead of once per raw row.
    summary = tagged.groupBy("src_file", F.to_date("ts").alias("day")).agg(
        F.max("stage").alias("max_stage"),
        *stage_counts(),
        F.bool_or("malformed").alias("has_malformed"),
        *[F.max(c).alias(c) for c in tagged.columns if c == "file_state"],
        first.alias("first"),
    )
    return summary.select("src_file", file_stem(F.col("src_file")).alias("site"), *summary.columns[1:])


def file_outcomes(summary: DataFrame) -> DataFrame:
    """Step 3: furthest stage per file and its placeholder reason (NULL when the file has data).

    A file with a malformed row (more fields than its header) is unreadable as a whole: it is
    ``rejected``, yields no rows and gets no placeholder (S6, Q8). So is a file that lacks a required
    column; blank files and files of a header alone (S5) have their reasons from ``file_state``.
    """
    sums = [F.sum(c).alias(c) for c in ("n_bad_datetime", "n_bad_numeric", "n_negative", "n_kept")]
    out = summary.groupBy("src_file", "site").agg(
        F.max("max_stage").alias("max_stage"), *sums, F.bool_or("has_malformed").alias("rejected"),
        *[F.max(c).alias(c) for c in summary.columns if c == "file_state"],
    )
    reason = stage_reason(F.col("max_stage"))
    if "file_state" in summary.columns:
        no_rows, state = F.col("max_stage") == STAGE_NO_ROW, F.col("file_state")
        empty = F.when(state == "blank", F.lit(REASON_EMPTY_FILE)).when(state == "bare", F.lit(REASON_CSV_EMPTY))
        reason = F.when(no_rows, empty).otherwise(reason)
        out = out.withColumn("rejected", F.col("rejected") | (no_rows & (state == "rejected")))
    return out.withColumn("reason", F.when(~F.col("rejected"), reason)).drop("file_state")


def listing_placeholders(files: DataFrame, outcomes: DataFrame, run_ts) -> DataFrame:
    """Zero-byte files -> ``Empty file``; readable files that produced no row -> ``CSV file was
    empty``. ``files`` has src_file, site, status (ok | zero_bytes | rejected)."""
    zero = files.where(F.col("status") == "zero_bytes").select(
        "site", "src_file", F.lit(REASON_EMPTY_FILE).alias("reason")
    )
    header_only = (
        files.where(F.col("status") == "ok")
        .join(outcomes.select("src_file"), "src_file", "left_anti")
        .select("site", "src_file", F.lit(REASON_CSV_EMPTY).alias("reason"))
    )
    reasons = zero.unionByName(header_only)
    return placeholders(reasons, run_ts, src_file=F.col("src_file"))


def validate(
    raw: DataFrame,
    run_ts,
    weather: DataFrame | None = None,
    daily_baro: DataFrame | None = None,
    site_cfg: DataFrame | None = None,
    files: DataFrame | None = None,
    expected_sites: DataFrame | None = None,
    water_density: float = WATER_DENSITY,
    reference_density: float = REFERENCE_DENSITY,
    materialize: bool = True,
    observation: Observation | None = None,
) -> Validation:
    """Raw text readings -> validated daily table with placeholders, flags and depths.

    ``raw``: site (ignored; taken from the file name), date_text, time_text, level_text, baro_text,
    comment, src_file (and malformed, file_state from a folder source: ``FolderInput.rows``). ``weather``: date_text, time_text, hpa_text (or pass ``daily_baro``).
    ``site_cfg``: site, depth_conversion_type; its sites are the expected sites unless
    ``expected_sites`` is given. ``files``: the file listing of a folder source (see
    ``hydrocal.sources.csv_folder``). ``materialize=False`` skips writing the summary table
    (the raw input is then read once per consumer). ``observation`` counts the raw readings by the stage they
    reached (A3) while the pass over them runs; a task that Spark runs twice may count twice.
    """
    text_cols = ("date_text", "time_text", "level_text", "baro_text", "src_file")
    require_types(raw, {c: T.StringType() for c in text_cols}, "validate")
    tagged = tag_stages(raw)
    if observation is not None:
        tagged = tagged.observe(observation, *stage_counts())
    summary = file_day_summary(tagged)
    if materialize:
        summary = cut_lineage(summary, "file-day-summary")
    outcomes = file_outcomes(summary)

    failed = outcomes.where(F.col("reason").isNotNull()).select(
        "site", "src_file", "reason"
    )
    ph = [placeholders(failed, run_ts, src_file=F.col("src_file"))]
    if files is not None:
        ph.append(listing_placeholders(files, outcomes, run_ts))
        processed = files.select("site")
    else:
        processed = outcomes.select("site")
    if site_cfg is not None:  # one row per site, evaluated once for all of its uses below
        site_cfg = lookup_table(site_cfg)
        site_cfg = cut_lineage(site_cfg, "site-config") if materialize else site_cfg
    if expected_sites is None and site_cfg is not None:
        expected_sites = site_cfg.select("site")
    if expected_sites is not None:
        ph.append(missing_site_placeholders(expected_sites, processed, run_ts))

    kept_summary = summary
    if "malformed" in raw.columns:
        bad_files = outcomes.where(F.col("rejected")).select("src_file")
        kept_summary = summary.join(bad_files, "src_file", "left_anti")
    firsts = kept_summary.where(F.col("first").isNotNull()).select(
        "site",
        F.col("first.ts").alias("ts"),
        F.col("first.level_ft").alias("level_ft"),
        F.col("first.baro_hpa").alias("baro_hpa"),
        F.col("first.comment").alias("comment"),
        "src_file",
        F.lit(None).cast("string").alias("flag"),
    )
    if daily_baro is None and weather is not None:
        daily_baro = daily_barometer(weather)
    if daily_baro is not None and materialize:
        daily_baro = cut_lineage(daily_baro, "daily-barometer")
    # both broadcast size checks in one job
    dims = [d for d in (site_cfg, daily_baro) if d is not None]
    small = dict(zip([id(d) for d in dims], fits_broadcast_all(dims)))

    candidates = union_by_name(firsts, *ph).repartition("site")
    daily = first_per_site_day(candidates)
    daily = convert_depth(daily, site_cfg, cfg_small=small.get(id(site_cfg)))

    if daily_baro is not None:
        daily = attach_baro(daily, daily_baro, small=small[id(daily_baro)])
    else:
        daily = daily.withColumn("bom_hpa", F.lit(None).cast("double"))

    daily = replace_stale(daily, run_ts)
    daily = adjust_depth(flag_dry(daily), water_density, reference_density)
    final = daily.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) if c == "comment" else F.col(c) for c in FINAL_COLUMNS]
    )

    readings = summary.where(F.col("max_stage") > STAGE_NO_ROW) if "file_state" in summary.columns else summary
    quality = readings.groupBy("site").agg(
        *[F.sum(c).alias(c) for c in ("n_bad_datetime", "n_bad_numeric", "n_negative", "n_kept")]
    )
    if site_cfg is not None:
        known = F.col("depth_conversion_type").isin(CONVERSION_DEFAULT, CONVERSION_DIVIDE_BY_100)
        unknown = site_cfg.select("site", (~known).alias("_unknown"))
        quality = quality.join(unknown, "site", "left").select(
            *quality.columns, F.coalesce(F.col("_unknown"), F.lit(False)).alias("unknown_conversion")
        )
    else:
        quality = quality.withColumn("unknown_conversion", F.lit(False))
    rejected = outcomes.where(F.col("rejected")).select("src_file", "site")
    if files is not None:
        rejected = rejected.unionByName(files.where(F.col("status") == "rejected").select("src_file", "site")).distinct()
    return Validation(final=final, file_outcomes=outcomes, quality=quality, rejected_files=rejected)
