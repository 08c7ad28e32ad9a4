"""Operator 3: sharding by a permutation-filled lookup table.

Every shard has a preference order over the ``size`` (a prime) slots of a table: offset, offset + skip,
... modulo the size, both from an MD5 of its name. Shards take turns; at its turn a shard claims the
first slot of its order that is still free. The table therefore splits almost evenly (slot counts
differ by one at most) and changes little when a shard is added or lost. ``size`` bounds what is built on the
driver and broadcast; it never depends on the data. Rows look their slot up by an MD5 of the key:
constant time, no shuffle of the data. Expressions are Spark's own.

Equal keys always share a shard. For a key that may hold much of the data, ``salt`` names a column
whose values spread the key over ``spread`` slots. A null key is a key of its own; an empty table gives
no rows; columns named like the results are refused.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import table

SIZE = 4099
MOST = 131_101  # the largest table allowed: what is broadcast stays below 2 MB
SHARDS = [f"shard-{i:02d}" for i in range(32)]


def _md5_int(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """slot -> index of its shard."""
    if size > MOST or size < max(2, len(shards)) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"size must be a prime from the number of shards to {MOST}")
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must have distinct names")
    offset = [_md5_int(f"offset:{s}") % size for s in shards]
    skip = [_md5_int(f"skip:{s}") % (size - 1) + 1 for s in shards]
    out, at = [-1] * size, [0] * len(shards)
    for turn in range(size):
        s = turn % len(shards)
        while out[slot := (offset[s] + at[s] * skip[s]) % size] >= 0:
            at[s] += 1
        out[slot] = s
    return out


def _hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def shard(df: DataFrame, key: str, shards: list[str] = SHARDS, size: int = SIZE, salt: str | None = None, spread: int = 1) -> DataFrame:
    """``df`` with its slot and shard."""
    if {"slot", "shard"} & {c.lower() for c in df.columns}:
        raise ValueError("the table has a column slot or shard")
    text = F.concat(F.lit("key:"), F.coalesce(F.col(key).cast("string"), F.lit("\0null")))
    if salt:
        text = F.concat(text, F.lit("#"), F.pmod(_hash(F.coalesce(F.col(salt).cast("string"), F.lit(""))), F.lit(spread)).cast("string"))
    rows = json.dumps([{"slot": i, "shard": shards[s]} for i, s in enumerate(lookup_table(shards, size))])
    # One constant of ``size`` entries, unfolded by Spark: never more than MOST rows are broadcast.
    places = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<slot:bigint,shard:string>>")))
    return df.withColumn("slot", F.pmod(_hash(text), F.lit(size))).join(F.broadcast(places), "slot").select(*df.columns, "slot", "shard")


def op3_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents placed by doc_id: doc_id, slot, shard."""
    return shard(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


_N = len(SHARDS)
ORACLE_SQL = f"""
WITH RECURSIVE names AS (
  SELECT list('shard-' || lpad(i::VARCHAR, 2, '0') ORDER BY i) AS n FROM range({_N}) t(i)
), params AS (
  SELECT n, list_transform(n, lambda x: ('0x' || substr(md5('offset:' || x), 1, 13))::BIGINT % {SIZE}) AS off,
         list_transform(n, lambda x: ('0x' || substr(md5('skip:' || x), 1, 13))::BIGINT % {SIZE - 1} + 1) AS skip
  FROM names
), fill AS (
  SELECT 0 AS turn, list_transform(range({SIZE}), lambda x: -1) AS taken FROM params
  UNION ALL
  SELECT turn + 1, list_concat(taken[1:slot], [turn % {_N}], taken[slot + 2:])
  FROM (SELECT turn, taken,
               list_filter(list_transform(range({SIZE}), lambda j: (off[turn % {_N} + 1] + j * skip[turn % {_N} + 1]) % {SIZE}), lambda x: taken[x + 1] < 0)[1] AS slot
        FROM fill, params WHERE turn < {SIZE})
), done AS (SELECT taken FROM fill WHERE turn = {SIZE}), placed AS (
  SELECT doc_id, ('0x' || substr(md5('key:' || coalesce(doc_id::VARCHAR, chr(0) || 'null')), 1, 13))::BIGINT % {SIZE} AS slot FROM documents
)
SELECT doc_id, slot, n[taken[slot + 1] + 1] AS shard FROM placed, done, names
"""
