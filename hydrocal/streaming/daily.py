"""Structured Streaming form of the daily keep-first (C6/W2) and barometer join.

The reference is a monthly batch whose exports overlap, so readings of old days arrive late as a
matter of course. This incremental re-aim of SURVEY §2.11 therefore keeps no event-time state and no
watermark: nothing is ever too late.

* Readings arrive as files (``readStream``); each micro-batch is reduced to the first reading per
  (site, day) and written as a segment of a log, a folder named by the batch: a batch replayed after a
  failure writes its own segment again.
* Every ``compact_every`` segments the next batch first merges them into a snapshot, which is kept by day:
  only days that the segments touch are written anew, under a new version, and a manifest names each
  day's version. A marker, written last, commits the manifest; without it nothing has happened. As the
  merge is done before a batch writes, it takes in committed batches alone.
* The settle step takes the minimum per (site, day) over the snapshot that the last marker names and the
  segments after it. A minimum does not depend on order or repeats, so the result equals the batch answer
  for any arrival order, and settling reads each (site, day) once and not the whole log.
* When a daily barometer is given, the settled rows are joined to it (C7, checked broadcast).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.operators.barometer import attach_baro
from hydrocal.session import scratch_path

ORDER_FIELDS = ["ts", "src_file", "level_ft", "baro_hpa", "comment"]
_TYPES = ["timestamp_ntz", "string", "double", "double", "string"]
FIRSTS_SCHEMA = "site string, day date, first struct<" + ", ".join(f"no_{c}: boolean, {c}: {t}" for c, t in zip(ORDER_FIELDS, _TYPES)) + ">"
MANIFEST_SCHEMA = "day date, version long"
COMPACT_EVERY = 8


def _ordered() -> Column:
    """The reading as a struct whose order is the batch tie-break: time, file, values, each with NULLs last."""
    return F.struct(*[x for c in ORDER_FIELDS for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])


def firsts_of(readings: DataFrame) -> DataFrame:
    """(site, day, first) of a set of readings."""
    return readings.groupBy("site", F.to_date("ts").alias("day")).agg(F.min(_ordered()).alias("first"))


def merged(firsts: DataFrame) -> DataFrame:
    """The smallest struct per key."""
    return firsts.groupBy("site", "day").agg(F.min("first").alias("first"))


def flatten_firsts(firsts: DataFrame) -> DataFrame:
    """Final (site, day) rows."""
    return merged(firsts).select("site", *[F.col(f"first.{c}").alias(c) for c in ORDER_FIELDS])


class FirstsLog:
    """The log, its snapshot and its markers, in the folder ``base`` (shared, any file system of Spark's).

    ``log/<batch>``, ``snapshot/version=<version>/day=<day>``, ``manifest/<version>``, ``marker/<version>``.
    Driver and file system exchange names of segments and versions (few, as compaction goes on) and one
    small file; the manifest has a row per calendar day.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        folder = self._path(f"{self.base}/{kind}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def committed(self) -> tuple[int, int]:
        """Version of the last snapshot and the last batch in it; (-1, -1) before the first."""
        for version in reversed(self._numbers("marker")):
            text = self.spark.read.text(f"{self.base}/marker/{version}", wholetext=True).first()
            if text and text[0].endswith("}"):  # else its writer was stopped
                return version, json.loads(text[0])["upto"]
        return -1, -1

    def segments(self, after: int) -> list[int]:
        return [n for n in self._numbers("log") if n > after]

    def write_segment(self, batch: DataFrame, batch_id: int) -> None:
        firsts_of(batch).write.mode("overwrite").parquet(f"{self.base}/log/{batch_id}")

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], FIRSTS_SCHEMA)
        return self.spark.read.schema(FIRSTS_SCHEMA).parquet(*paths)

    def _manifest(self, version: int) -> DataFrame:
        if version < 0:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.base}/manifest/{version}")

    def _snapshot(self, manifest: DataFrame) -> DataFrame:
        """Rows of the days that ``manifest`` lists, each from its version. NULL days have a folder too."""
        day = F.coalesce(F.col("day").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        rows = manifest.select(F.concat(F.lit("version="), F.col("version").cast("string"), F.lit("/day="), day).alias("p")).collect()
        if not rows:
            return self._read([])
        read = self.spark.read.option("basePath", f"{self.base}/snapshot")
        frames = read.schema("site string, " + FIRSTS_SCHEMA.split(", ", 2)[2] + ", version long, day date").parquet(*[f"{self.base}/snapshot/{r.p}" for r in rows])
        return frames.select("site", "day", "first")

    def settled(self) -> DataFrame:
        version, upto = self.committed()
        log = self._read([f"{self.base}/log/{n}" for n in self.segments(upto)])
        return flatten_firsts(self._snapshot(self._manifest(version)).unionByName(log))

    def compact(self, before: int) -> None:
        """Merge the segments of batches below ``before`` into a new version of the days they touch."""
        version, upto = self.committed()
        fresh = [n for n in self.segments(upto) if n < before]
        if not fresh:
            return
        log, old, new = self._read([f"{self.base}/log/{n}" for n in fresh]), self._manifest(version), version + 1
        days = log.select(F.col("day"), F.lit(new).cast("long").alias("now")).distinct()
        on = old["day"].eqNullSafe(days["day"])
        manifest = old.join(days, on, "full").select(F.coalesce(old["day"], days["day"]).alias("day"), F.coalesce("now", "version").alias("version"))
        touched = self._snapshot(old.join(days, on, "left_semi"))
        rows = merged(touched.unionByName(log)).select("site", "first", "day")
        rows.write.mode("overwrite").partitionBy("day").parquet(f"{self.base}/snapshot/version={new}")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/manifest/{new}")
        self.mark(new, fresh[-1])
        self.tidy()

    def mark(self, version: int, upto: int) -> None:
        out = self._fs.create(self._path(f"{self.base}/marker/{version}"), True)
        out.write(bytearray(json.dumps({"version": version, "upto": upto}).encode()))
        out.close()

    def tidy(self) -> None:
        """Delete segments that the snapshot before the last one already held: readers of either go on."""
        markers = self._numbers("marker")
        if len(markers) < 2:
            return
        text = self.spark.read.text(f"{self.base}/marker/{markers[-2]}", wholetext=True).first()[0]
        for n in self._numbers("log"):
            if text.endswith("}") and n <= json.loads(text)["upto"]:
                self._fs.delete(self._path(f"{self.base}/log/{n}"), True)


def run_first_per_site_day(
    spark: SparkSession,
    source: DataFrame,
    work_dir: str | None = None,
    daily_baro: DataFrame | None = None,
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Run the streaming keep-first over ``source`` (a streaming DataFrame of readings) until all
    available input is processed, and return the settled batch result (with ``bom_hpa`` when
    ``daily_baro`` is given).

    Log and snapshot lie under ``work_dir`` (default: a fresh folder inside the shared checkpoint folder)
    with the stream's own checkpoint next to them, so a restarted job resumes from its last committed
    batch.
    """
    base = work_dir or scratch_path(spark, "stream")
    log = FirstsLog(spark, base)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _, upto = log.committed()
        if len([n for n in log.segments(upto) if n < batch_id]) >= compact_every:
            log.compact(batch_id)
        log.write_segment(batch, batch_id)

    q = (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    settled = log.settled()
    if daily_baro is not None:
        settled = attach_baro(settled, daily_baro)
    return settled
