"""Session helpers: a configured SparkSession for local runs, table loading and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. ANSI is the Spark 4 default; AQE re-plans joins and coalesces
# shuffle partitions with measured sizes. The static planner does not broadcast on estimated sizes
# (compressed file sizes can understate a table); broadcasts happen only after an explicit size
# check (operators/joins.py) or when AQE has measured a materialised side below 10 MB.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "hydrocal") -> SparkSession:
    """A local session for tests and benchmarks (the cluster provides its own session)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HYDROCAL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the steps that run Python there (large
    CSV files, the training-data operators). Needed where the executors do not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or spark.sparkContext.master.startswith("local["):
        return
    root = Path(__file__).resolve().parent
    path = f"{tempfile.mkdtemp(prefix='hydrocal-ship-')}/{root.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)  # the driver serves it to every executor, later ones included
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is used as is. Only when it
    is unset (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local"):
            conf_dir = tempfile.mkdtemp(prefix="hydrocal-ckpt-")
        else:
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, recorded for ``drop_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hydrocal-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark to give to ``drop_scratch``: scratch made before it stays."""
    return len(_SCRATCH)


def drop_scratch(spark: SparkSession, mark: int = 0) -> None:
    """Delete the scratch tables this process has made since ``mark``. Frames that read them are void afterwards, so
    this is for the end of a run, when its results are written."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_SCRATCH) > mark:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One write job; the table survives executor loss (never a machine-local checkpoint), and the
    read-back plan gets Parquet column pruning, filter pushdown and real size statistics, which an
    RDD checkpoint would not give.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver-provided parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
