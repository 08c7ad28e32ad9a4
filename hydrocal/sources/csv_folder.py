"""Folder-of-CSV sources (S1-S6, S8, S12) feeding the validation, as plans over tables.

* Listing (S1, S5): the names that Spark's file index holds, handed to a table in one call, and their
  sizes from a scan that opens no file. Names that begin with ``_`` or ``.`` are hidden from Spark's scans.
* Contents (S3, S4, S6): ``csv_text`` reads each file once; header, required columns and rows come out of
  the same row of a file, so files of any headers mix in one plan.
* File states: a file that gives no data rows says why in the ``file_state`` of its rows (one at least):
  ``blank``, ``bare`` (a header and nothing else) or ``rejected`` (a required column is missing). The
  validation takes the states from the pass that reads the rows. A chunk of a large file without a record
  is ``bare`` as well; that counts only where a file has no other rows.
* Malformed rows (S6): a row with more fields than its header, or with a quoted section that nothing
  closes, makes the whole file unreadable; such rows are marked ``malformed`` and the validation rejects
  their files.
* Level/barometer pairs (S8, S12, C1): a manifest names each site's level and barometer file; manifest,
  files and barometer rows meet in joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.functions.text import base_name, file_stem
from hydrocal.operators.joins import checked_join
from hydrocal.operators.merge import merge_level_baro, unique_baro
from hydrocal.schemas import NA_TOKENS, SRC_BARO, SRC_COMMENT, SRC_DATE, SRC_LEVEL, SRC_TIME
from hydrocal.session import cut_lineage
from hydrocal.sources.csv_text import WHOLE_BYTES, decoded, folder_contents, parsed

RAW_COLUMNS = ["site", "date_text", "time_text", "level_text", "baro_text", "comment", "src_file", "malformed"]
_TEXTS = {"date_text": SRC_DATE, "time_text": SRC_TIME, "level_text": SRC_LEVEL, "baro_text": SRC_BARO, "comment": SRC_COMMENT}
_REQUIRED = [SRC_DATE, SRC_TIME, SRC_LEVEL, SRC_BARO]


@dataclass
class FolderInput:
    """What the validation needs of a folder: ``validate(raw=inp.rows, files=inp.listing)`` reads it once."""

    rows: DataFrame  # RAW_COLUMNS and file_state: data rows (file_state NULL) and rows of files that give none
    listing: DataFrame  # src_file, site, status (zero_bytes | ok) by size alone

    @property
    def raw(self) -> DataFrame:
        """The data rows alone (RAW_COLUMNS)."""
        return self.rows.where(F.col("file_state").isNull()).select(*RAW_COLUMNS)

    @property
    def files(self) -> DataFrame:
        """src_file, site, status (ok | zero_bytes | rejected). Evaluating it reads the files."""
        states = self.rows.groupBy("src_file").agg(F.max("file_state").alias("file_state"))
        status = F.when(F.col("file_state") == "rejected", "rejected").when(F.col("file_state") == "blank", "zero_bytes").otherwise(F.col("status"))
        return self.listing.join(states, "src_file", "left").select("src_file", "site", status.alias("status"))


def folder_exists(spark: SparkSession, folder: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.getFileStatus(path).isDirectory())


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """src_file, name, size of the files of a folder (not of its subfolders).

    The names pass from the file index into a table inside the JVM, in as many calls for a million files
    as for one. Scans leave files without bytes out, so a file that the scan of sizes lacks has none.
    """
    scan = spark.read.format("binaryFile").load(folder)
    names = Column(spark.sparkContext._jvm.org.apache.spark.sql.functions.lit(scan._jdf.inputFiles()))
    names = spark.range(1, numPartitions=1).select(F.explode(names.cast("array<string>")).alias("url")).select(decoded(F.col("url")).alias("src_file"))
    sizes = scan.select(F.regexp_replace("path", "^file:/+", "file:/").alias("src_file"), "length")
    listed = names.join(sizes, "src_file", "left")
    return listed.select("src_file", base_name(F.col("src_file")).alias("name"), F.coalesce("length", F.lit(0)).alias("size"))


def is_site_file(name: Column) -> Column:
    """Name ends with ``.csv`` and does not start with ``baro`` (both case-insensitive)."""
    return F.lower(name).endswith(".csv") & ~F.lower(name).startswith("baro")


def _listing(files: DataFrame) -> DataFrame:
    status = F.when(F.col("size") == 0, "zero_bytes").otherwise("ok")
    return files.select("src_file", file_stem(F.col("src_file")).alias("site"), status.alias("status"))


def _texts() -> list[Column]:
    """The NA tokens of the exports become NULL (S3); values keep their text otherwise."""
    return [F.when(~F.col(c).isin(NA_TOKENS), F.col(c)).alias(c) for c in _TEXTS]


def read_site_folder(spark: SparkSession, folder: str, required: list[str] | None = None, whole_bytes: int = WHOLE_BYTES) -> FolderInput:
    """The validation input of a folder of merged site files.

    Files missing a required column are ``rejected`` (no placeholder, Q8); files without bytes or of blank
    lines are ``zero_bytes`` (``Empty file`` placeholder); the others are ``ok``. A folder that does not
    exist raises ``FileNotFoundError`` (S11: the run stops without output).
    """
    if not folder_exists(spark, folder):
        raise FileNotFoundError(f"input folder not found: {folder}")  # S11: no run, no output
    required = required or _REQUIRED
    names = _TEXTS | {f"need_{i}": c for i, c in enumerate(required)}
    rows = parsed(folder_contents(spark, folder, is_site_file, whole_bytes), names)
    complete = F.lit(True)
    for i in range(len(required)):
        complete &= F.col(f"has_need_{i}")
    state = (
        F.when(F.col("n_columns") == 0, "blank")
        .when(F.col("record").isNull(), "bare")  # a file without rows is empty before its columns matter
        .when(~complete, "rejected")
    )
    rows = rows.select(F.lit(None).cast("string").alias("site"), *_texts(), "src_file", (F.col("malformed") & state.isNull()).alias("malformed"), state.alias("file_state"))
    files = folder_files(spark, folder).where(is_site_file(F.col("name")))
    return FolderInput(rows=rows, listing=_listing(files))


def read_pairs(spark: SparkSession, folder: str, manifest: DataFrame, whole_bytes: int = WHOLE_BYTES) -> FolderInput:
    """S8 + S12 + C1: merge each site's level file with its barometer file (validation input).

    ``manifest``: main_csv, baro_csv (file names inside ``folder``; one row per configured site).
    A missing level file skips the pair. A missing, empty or unreadable barometer file leaves the
    level file unmerged: it is then rejected unless it already carries a pressure column. A
    pressure column already on a level file that is merged is replaced (Q11). Of several manifest rows
    for one level file the one with the smallest barometer name counts.

    The barometer files are read once, into a table of one row per key; the level files are read by the
    plan that is returned. Names meet files in joins that broadcast only what was measured.
    """
    if not folder_exists(spark, folder):
        raise FileNotFoundError(f"input folder not found: {folder}")  # S11: no run, no output
    pairs = manifest.where(F.col("main_csv").isNotNull()).groupBy(F.col("main_csv").alias("name")).agg(F.min("baro_csv").alias("pair"))
    pairs = cut_lineage(pairs, "pairs")
    any_file = lambda name: F.lit(True)

    def named(wanted: DataFrame) -> DataFrame:
        found = folder_contents(spark, folder, any_file, whole_bytes).withColumn("name", base_name(F.col("src_file")))
        return checked_join(found, wanted, "name", "inner")

    baro = parsed(named(pairs.where("pair is not null").select(F.col("pair").alias("name")).distinct()), _TEXTS)
    readable = F.col("has_date_text") & F.col("has_time_text") & F.col("has_baro_text")
    baro = baro.where(readable).select(F.col("name").alias("site"), *_texts(), "malformed", F.col("record").isNull().alias("bare"))
    # Of several barometer rows with one key, the later keep-first would choose the lowest valid pressure,
    # so only that one is merged. One row per file without key says that the file can be merged.
    kept = unique_baro(baro.where("not bare").select("site", "date_text", "time_text", "baro_text"))
    whole = baro.groupBy("site").agg(F.bool_or("malformed").alias("malformed"))
    table = cut_lineage(kept.withColumn("good", F.lit(None).cast("boolean")).unionByName(
        whole.select("site", (~F.col("malformed")).alias("good")), allowMissingColumns=True), "barometers")
    good = table.where("good").select(F.col("site").alias("pair"), F.lit(True).alias("has_pair"))

    level = checked_join(parsed(named(pairs), _TEXTS), good, "pair", "left")
    merged = F.coalesce(F.col("has_pair"), F.lit(False)) & F.col("has_date_text") & F.col("has_time_text")
    complete = F.col("has_date_text") & F.col("has_time_text") & F.col("has_level_text") & (merged | F.col("has_baro_text"))
    state = F.when(F.col("n_columns") == 0, "blank").when(F.col("record").isNull(), "bare").when(~complete, "rejected")
    rows = level.select(
        F.when(merged & state.isNull(), F.col("pair")).alias("site"), *_texts(), "src_file",
        (F.col("malformed") & state.isNull()).alias("malformed"), state.alias("file_state"),
    ).withColumn("own_baro", F.col("baro_text"))
    # Rows that stay unmerged have no site, which no barometer row has: they keep their own pressure.
    pressures = table.where("good is null").select("site", "date_text", "time_text", "baro_text")
    out = merge_level_baro(rows, pressures)
    out = out.withColumn("baro_text", F.when(F.col("site").isNull(), F.col("own_baro")).otherwise(F.col("baro_text")))
    out = out.withColumn("site", F.lit(None).cast("string"))
    files = checked_join(folder_files(spark, folder), pairs.select("name"), "name", "inner")
    return FolderInput(rows=out.select(*RAW_COLUMNS, "file_state"), listing=_listing(files))
