"""Command line: one monthly validation run.

    python -m hydrocal validate --input <folder> --out <folder> --run-ts "2026-03-28 17:00:00" \\
        [--config <site config JSON file>] [--manifest <file-pair JSON file>] \\
        [--pages <parquet with an html column>] [--water-density 1000] [--reference-density 1000] \\
        [--single-file]

Reads the landing folder (merged site files, or level/barometer pairs when a manifest is given),
parses the weather pages of the run's month, validates, and publishes the typed table, both CSV
reports and the quality tables under ``--out``: they are staged in a folder of the run, and one commit
file makes them the current outputs (``hydrocal.sinks.publish``). The counters of the run come from the
jobs that read and write its rows. Uses the session of the cluster it runs on; a local
session is created when none exists.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import Observation, SparkSession


def _read_text(spark: SparkSession, path: str) -> str:
    """A small text file, read by Spark, so that any path Spark knows will do."""
    return spark.read.text(path, wholetext=True).first()[0]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="hydrocal")
    sub = ap.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate", help="validate one landing folder and write the reports")
    v.add_argument("--input", required=True)
    v.add_argument("--out", required=True)
    v.add_argument("--run-ts", required=True, help="YYYY-MM-DD HH:MM:SS")
    v.add_argument("--config")
    v.add_argument("--manifest")
    v.add_argument("--pages")
    v.add_argument("--water-density", type=float, default=1000.0)
    v.add_argument("--reference-density", type=float, default=1000.0)
    v.add_argument("--single-file", action="store_true")
    a = ap.parse_args(argv)

    from hydrocal.operators.barometer import ampm_readings
    from hydrocal.operators.quality import rows_per_site, run_metric_columns, run_summary, site_status
    from hydrocal.plans.validate import validate
    from hydrocal.session import drop_scratch, local_session, scratch_mark, ship_package
    from hydrocal.sinks.publish import Publication
    from hydrocal.sinks.reports import MAIN_NAME, UPLOAD_NAME, write_reports
    from hydrocal.sources.csv_folder import read_pairs, read_site_folder
    from hydrocal.sources.site_config import manifest_from_json, site_config

    spark = SparkSession.getActiveSession() or local_session()
    ship_package(spark)
    mark = scratch_mark()
    run = dt.datetime.strptime(a.run_ts, "%Y-%m-%d %H:%M:%S")
    cfg = site_config(spark, _read_text(spark, a.config)) if a.config else None
    from hydrocal.sources.csv_folder import folder_exists

    if not folder_exists(spark, a.input):
        print(f"input folder not found: {a.input}; no output written", file=sys.stderr)
        return 1
    if a.manifest:
        docs = spark.createDataFrame([(_read_text(spark, a.manifest),)], "doc string")
        inp = read_pairs(spark, a.input, manifest_from_json(docs, "doc"))
    else:
        inp = read_site_folder(spark, a.input)
    readings = Observation()
    weather = ampm_readings(spark.read.parquet(a.pages), run.month, run.year) if a.pages else None
    res = validate(
        inp.rows,
        a.run_ts,
        weather=weather,
        site_cfg=cfg,
        files=inp.listing,
        water_density=a.water_density,
        reference_density=a.reference_density,
        observation=readings,
    )
    pub = Publication(spark, a.out)
    table, seen = pub.counted("validated.parquet", res.final, *run_metric_columns())
    table.write.parquet(f"{pub.base}/validated.parquet")
    final = spark.read.parquet(f"{pub.base}/validated.parquet")
    counts = {k: int(v) for k, v in seen.get.items()}
    if not write_reports(final, pub.base, single_file=a.single_file, typed=False):
        pub.abandon()
        drop_scratch(spark, mark)
        print("nothing consolidated; no output written", file=sys.stderr)
        return 1
    pub.add(MAIN_NAME, counts["rows"])
    pub.add(UPLOAD_NAME, counts["n_adjusted"])
    pub.parquet("quality.parquet", res.quality)
    pub.parquet("file_outcomes.parquet", res.file_outcomes)
    pub.parquet("rows_per_site.parquet", rows_per_site(final).orderBy("site"))
    pub.parquet("rejected_files.parquet", res.rejected_files)
    status = spark.read.parquet(pub.parquet("site_status.parquet", site_status(final, res.rejected_files)))
    summary = {**run_summary(status).first().asDict(), **{k: v for k, v in counts.items() if k != "rows"}}
    pub.commit({"summary": summary, "readings": {k: int(v) for k, v in readings.get.items()}})
    drop_scratch(spark, mark)
    print(json.dumps(summary))
    return 0


if __name__ == "__main__":
    sys.exit(main())
