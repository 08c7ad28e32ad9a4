"""Data-quality tables replacing the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrocal.operators.clean import stage_counts


def rows_per_site(df: DataFrame) -> DataFrame:
    """A2: rows per site in a report (sorted by site at the sink)."""
    return df.groupBy("site").agg(F.count(F.lit(1)).alias("n_rows"))


def quality_counts(tagged: DataFrame) -> DataFrame:
    """Per site, rows dropped at each stage and rows kept, in one aggregation pass."""
    return tagged.groupBy("site").agg(*stage_counts(), F.count(F.lit(1)).alias("n_rows"))


def site_status(final: DataFrame, failed_sites: DataFrame | None = None) -> DataFrame:
    """One row per site with a typed status, from one aggregation.

    ``flagged`` when any row is a placeholder or carries the dry comment, ``data`` otherwise, and
    ``failed`` for sites of ``failed_sites`` (rejected files) that have no row at all. Derived from
    the ``flag`` column, not from comment text matching. Final rows and failed-site markers are
    unioned and grouped once, so the final table is evaluated once (no join back).
    """
    rows = final.select("site", F.col("flag"), F.lit(True).alias("_row"))
    if failed_sites is not None:
        marks = failed_sites.select("site", F.lit(None).cast("string").alias("flag"), F.lit(False).alias("_row"))
        rows = rows.unionByName(marks)
    per_site = rows.groupBy("site").agg(
        F.count_if(F.col("_row") & F.col("flag").isNull()).alias("n_data_rows"),
        F.count_if(F.col("_row") & F.col("flag").isNotNull()).alias("n_flag_rows"),
    )
    status = (
        F.when((F.col("n_data_rows") + F.col("n_flag_rows")) == 0, F.lit("failed"))
        .when(F.col("n_flag_rows") > 0, F.lit("flagged"))
        .otherwise(F.lit("data"))
    )
    return per_site.withColumn("status", status)


def run_summary(status: DataFrame) -> DataFrame:
    """One row of counts (sites considered / with data / flagged / failed). Site names stay in
    the per-site table; they are never gathered into one row."""
    return status.agg(
        F.count(F.lit(1)).alias("n_sites"),
        F.count_if(F.col("status") == "data").alias("n_data_sites"),
        F.count_if(F.col("status") == "flagged").alias("n_flagged_sites"),
        F.count_if(F.col("status") == "failed").alias("n_failed_sites"),
    )


def run_metric_columns() -> list[Column]:
    """A3 / A6 run counters of the validated table: rows, rows with an external pressure (merged), rows
    flagged dry, rows with an adjusted depth (eligible), and placeholder rows. Aggregates for ``agg``, or
    for ``observe`` on the job that writes the table."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("bom_hpa").isNotNull()).alias("n_with_bom"),
        F.count_if(F.col("flag") == "dry").alias("n_dry"),
        F.count_if(F.col("depth_adj_m").isNotNull()).alias("n_adjusted"),
        F.count_if(F.col("flag") == "placeholder").alias("n_placeholders"),
    ]


def run_metrics(final: DataFrame) -> DataFrame:
    """The run counters in one aggregation."""
    return final.agg(*run_metric_columns())
