"""Report frames and writers (K1, K2, K4, K5, C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrocal.functions import report_ts
from hydrocal.schemas import require_types
from hydrocal.schemas import (
    R_ADJ,
    R_BARO,
    R_BOM,
    R_COMMENT,
    R_RAW,
    R_SITE,
    R_TS,
    R_UPLOAD_DEPTH,
    R_UPLOAD_MAHD,
)

MAIN_NAME, UPLOAD_NAME = "main_report", "upload_report"


def report_main(final: DataFrame) -> DataFrame:
    """K1: every row including placeholders, 7 report columns, timestamp as report text."""
    require_types(final, {"ts": T.TimestampNTZType()}, "report_main")
    return final.select(
        F.col("site").alias(R_SITE),
        report_ts(F.col("ts")).alias(R_TS),
        F.col("bom_hpa").alias(R_BOM),
        F.col("baro_hpa").alias(R_BARO),
        F.col("depth_raw_m").alias(R_RAW),
        F.col("depth_adj_m").alias(R_ADJ),
        F.coalesce(F.col("comment"), F.lit("")).alias(R_COMMENT),
    )


def report_upload(final: DataFrame) -> DataFrame:
    """K2: rows with an adjusted depth; the water-level column is always empty."""
    require_types(final, {"ts": T.TimestampNTZType()}, "report_upload")
    return final.where(F.col("depth_adj_m").isNotNull()).select(
        F.col("site").alias(R_SITE),
        report_ts(F.col("ts")).alias(R_TS),
        F.col("depth_adj_m").alias(R_UPLOAD_DEPTH),
        F.lit(None).cast("double").alias(R_UPLOAD_MAHD),
        F.coalesce(F.col("comment"), F.lit("")).alias(R_COMMENT),
    )


def sorted_for_report(final: DataFrame) -> DataFrame:
    """O2: global (site, ts) order, applied only at the sink (range-partitioned sort)."""
    return final.orderBy(F.col("site").asc_nulls_last(), F.col("ts").asc_nulls_last())


def write_csv(report: DataFrame, path: str, single_file: bool = False) -> None:
    """K1/K2 CSV export: header, NULL and empty both written as nothing, quotes doubled, blanks kept,
    overwrite.

    An empty frame still writes a header-only file (K4: a stale upload file never survives).
    ``single_file`` funnels the export through one task; leave it off for large outputs.
    """
    out = report.coalesce(1) if single_file else report
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_reports(
    final: DataFrame, out_dir: str, single_file: bool = False, main_name: str = MAIN_NAME, upload_name: str = UPLOAD_NAME,
    typed: bool = True,
) -> bool:
    """K5: main and upload reports under ``out_dir`` (one folder each, names as given), plus the typed table as
    Parquet unless ``typed`` is false. ``final`` should be materialised first (see ``hydrocal.session.cut_lineage``).

    S11: when nothing at all was consolidated (not even a placeholder) no file is written and
    False is returned. Otherwise both reports are written, the upload report header-only when no
    row has an adjusted depth (K4, Q12).
    """
    if final.isEmpty():
        return False
    ordered = sorted_for_report(final)
    if typed:
        final.write.mode("overwrite").parquet(f"{out_dir}/validated.parquet")
    write_csv(report_main(ordered), f"{out_dir}/{main_name}", single_file)
    write_csv(report_upload(ordered), f"{out_dir}/{upload_name}", single_file)
    return True
