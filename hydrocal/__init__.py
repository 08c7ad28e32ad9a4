"""hydrocal: Spark-native validation and calibration of water-level logger telemetry.

Every operator takes and returns Spark DataFrames and is built from Catalyst expressions.
The main entry points are re-exported here; the submodules hold the individual operators.
"""

__version__ = "0.1.0"

__all__ = [
    "ampm_readings",
    "cut_lineage",
    "local_session",
    "read_pairs",
    "read_site_folder",
    "report_main",
    "report_upload",
    "site_config",
    "validate",
    "write_reports",
]


def __getattr__(name):
    # Lazy re-exports: importing the package does not need an active SparkContext.
    if name == "validate":
        from hydrocal.plans.validate import validate

        return validate
    if name in ("local_session", "cut_lineage"):
        from hydrocal import session

        return getattr(session, name)
    if name in ("read_site_folder", "read_pairs"):
        from hydrocal.sources import csv_folder

        return getattr(csv_folder, name)
    if name == "site_config":
        from hydrocal.sources.site_config import site_config

        return site_config
    if name == "ampm_readings":
        from hydrocal.operators.barometer import ampm_readings

        return ampm_readings
    if name in ("report_main", "report_upload", "write_reports"):
        from hydrocal.sinks import reports

        return getattr(reports, name)
    raise AttributeError(name)
