"""Join helpers: broadcast only sides whose size has been measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrocal.session import cut_lineage

# Upper bound on the uncompressed bytes of a dimension that may be broadcast.
BROADCAST_MAX_BYTES = 64 << 20

# Bytes of a row beside its text: row and hash-table overhead, and one word per column.
_ROW_BYTES, _WORD_BYTES = 32, 16


def row_bytes(df: DataFrame) -> Column:
    """Uncompressed size of one row: its text and binary columns at their length, others at their fixed
    width (the columns of a dimension are not nested)."""
    parts = [F.lit(_ROW_BYTES + _WORD_BYTES * len(df.columns)).cast("long")]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long"))
    return reduce(Column.__add__, parts)


def fits_broadcast_all(frames: list[DataFrame], max_bytes: int = BROADCAST_MAX_BYTES) -> list[bool]:
    """True for each frame of at most ``max_bytes`` uncompressed bytes: one job of map-side sums, of
    which one number per frame reaches the driver."""
    if not frames:
        return []
    sizes = [df.select(F.lit(i).alias("i"), row_bytes(df).alias("b")) for i, df in enumerate(frames)]
    total = {r["i"]: r["b"] for r in reduce(DataFrame.unionAll, sizes).groupBy("i").agg(F.sum("b").alias("b")).collect()}
    return [total.get(i, 0) <= max_bytes for i in range(len(frames))]


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """``fits_broadcast_all`` for one frame."""
    return fits_broadcast_all([df], max_bytes)[0]


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "left",
    max_bytes: int = BROADCAST_MAX_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join with ``right`` broadcast when its size check passes; otherwise a plain shuffle join
    that AQE may still convert at run time from measured sizes. ``right`` is evaluated once, into a
    table in the shared folder that the check and the join read. ``small`` passes the result of a
    check already made (``fits_broadcast_all``), and ``right`` is then joined as it is."""
    if small is None:
        written = cut_lineage(right, "dimension")
        small = fits_broadcast(written, max_bytes)
        if not isinstance(on, (str, list)):
            raise TypeError("checked_join: an unchecked side is joined by column names")
        right = written
    if small:
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)


# Rows of one key that count as many, and salts at most of one key.
HEAVY_ROWS = 100_000
MAX_SALTS = 4096
_TRACKED, _HEAVY_KEYS = 10_000, 256


def heavy_hitters(df: DataFrame, keys: list[str], rows_a_task: int = HEAVY_ROWS) -> dict[int, int]:
    """Key hash -> salts, for keys with more than ``rows_a_task`` rows by a frequent-items sketch: one pass
    of mergeable sketches, of which at most ``_HEAVY_KEYS`` counts reach the driver. A sketch never counts
    too few rows of a key that holds a ten-thousandth of them or more, so each key with a large share is found."""
    sketch = f"approx_top_k(h, {_HEAVY_KEYS}, {_TRACKED})"
    top = df.select(F.xxhash64(*keys).alias("h")).selectExpr(f"{sketch} AS top").first().top or []
    return {t["item"]: min(MAX_SALTS, -(-t["count"] // rows_a_task)) for t in top if t["count"] > rows_a_task}


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], rows_a_task: int = HEAVY_ROWS) -> DataFrame:
    """Left join on equal ``keys`` (NULL equals NULL), spread also where one key, NULLs included, holds a
    large share of the left rows.

    Left rows of a heavy key get one of its salts in turn; right rows of the key are repeated once per
    salt. All other rows have salt 0. Every left row meets every right row of its key exactly once,
    whatever its salt, so the result is that of the plain join. Right columns other than the keys are
    added to the left ones.
    """
    salts = heavy_hitters(left, keys, rows_a_task)
    others = [c for c in right.columns if c not in keys]
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *others)
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    if salts:
        of = F.create_map(*[F.lit(x) for kv in salts.items() for x in kv])
        n = F.coalesce(F.try_element_at(of, F.xxhash64(*keys)), F.lit(1))
        left = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), n))
        n = F.coalesce(F.try_element_at(of, F.xxhash64(*[f"_r_{k}" for k in keys])), F.lit(1))
        right = right.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("_r_salt", F.col("_r_salt").cast("long"))
        on.append(F.col("_salt") == F.col("_r_salt"))
    out = left.join(right, reduce(Column.__and__, on), "left")
    return out.drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])
