"""Helpers shared by the operators: words, hashing, scratch tables, Arrow batches.

A *word* is a maximal run of characters other than space and U+0009..U+000D; on UTF-8 bytes that
is exactly ``bytes.split()``. Null texts have no words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.session import ensure_checkpoint_dir, table  # noqa: F401  (re-exported)

U64 = np.uint64
WORD = "[^\\x20\\x09-\\x0D]+"
#: Texts are handled in slices of about so many characters, whatever an Arrow batch holds.
SLICE_CHARS = 4_000_000


_RECORDERS: list[list[str]] = []


def lazily_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once (Parquet, zstd) to the shared folder and read back: survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    for paths in _RECORDERS:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Collects the scratch folders that ``lazily_once`` writes inside the block, to drop them later."""
    _RECORDERS.append(paths)
    try:
        yield
    finally:
        _RECORDERS.remove(paths)


def n_words(text: Column) -> Column:
    """Number of words of a text column (null text: 0), as a JVM expression."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut into row slices of about ``size`` bytes of ``text`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.nan_to_num(
            pc.binary_length(batch.column(text)).cast(pa.float64()).to_numpy(zero_copy_only=False)
        )
        group = (np.cumsum(lengths) // size).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.uint64(0xD1342543DE82EF95)


def hash_words(buf: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``buf``, in which single spaces separate the words."""
    if not buf:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(buf, np.uint8)
    gap = np.flatnonzero(raw == 32)
    start = np.concatenate([[0], gap + 1])
    size = np.append(gap, len(raw)) - start
    at = np.arange(len(raw)) - np.repeat(start, np.append(np.diff(start), len(raw) - start[-1]))
    power = np.full(int(size.max()) + 1, _POWER, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    part = _BYTE[raw] * power[at]
    part[gap] = 0
    h = np.add.reduceat(part, start) + size.astype(np.uint64)
    return mix(h, h)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive 64-bit combination of two hash arrays (multiply, rotate, finalise)."""
    x = a * U64(0x9E3779B97F4A7C15)
    x ^= (b << U64(29)) | (b >> U64(35))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def spans(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` consecutive elements of ``h`` (by doubling)."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    size, cur = 1, h
    while size * 2 <= length:
        cur = mix(cur[:-size], cur[size:])
        size *= 2
    return cur[:n] if size == length else mix(cur[:n], cur[length - size : length - size + n])


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the Hadoop FileSystem API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def hashed_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """The ``size`` rows with the lowest hashes of ``key`` (all, if there are fewer), in that order.

    A bound on the hash, from the row count, leaves about a fifth more rows than are asked for before
    anything is ordered, so the tasks together send few rows on, whatever their number.
    """
    h, n = F.xxhash64(key), df.count()
    if n > 2 * size:
        bound = int((1.2 * size + 1000) / n * 2**64) - 2**63
        few = df.where(h < F.lit(min(bound, 2**63 - 1)))
        if few.count() >= size:  # else one key has very many rows
            df = few
    return df.orderBy(h, key).limit(size)


def input_bytes(df: DataFrame) -> int:
    """Size of the plan's input as Spark estimates it (file sizes for plain scans)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def parts_for(df: DataFrame, unit: int, least: int = 8, most: int = 100_000) -> int:
    """Partitions so that each holds about ``unit`` bytes of the plan's estimated input."""
    return int(min(most, max(least, input_bytes(df) // unit)))
