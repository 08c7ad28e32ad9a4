"""Operator 6: best-fit packing by hierarchical residual packing.

Documents become token ids plus an end id; only longer ones than ``capacity`` are cut, into pieces of
exactly ``capacity`` tokens after a first, shorter one. ``pack`` places pieces into sequences:

1. Pieces are dealt out by hash into groups of about ``GROUP`` pieces; each group packs best-fit by
   decreasing length. Bins with at most ``slack`` free tokens are emitted.
2. The underfull bins of all groups become the items of the next round, dealt into fewer groups, and
   are packed best-fit again (a merged bin keeps its inner order). Rounds end when one merged nothing,
   or one group held everything.

No task holds more than a group; what a round did is written to the shared folder, so a lost executor
repeats one round at most. Null text counts as empty (one piece: the end id). Repeated rows are
separate documents; ids may be null. An empty table packs into nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import lazily_once, slices, table
from hydrocal.llm.tokens import default_tokenizer_path, encoder

CAPACITY = 2048
GROUP = 50_000
SLACK = 16
END_ID = 0
MAX_ROUNDS = 12


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item (unique), doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    tokenizer = tokenizer or default_tokenizer_path()

    def cut(batches):
        enc, n = encoder(tokenizer), TaskContext.get().partitionId() << 36
        for b in slices(batches, size=5_000_000):
            out = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text"))):
                ids = np.append(ids, end_id).astype("<u4")
                first = len(ids) % capacity or capacity
                ends = range(first, len(ids) + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    out.append((n, doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                    start, n = end, n + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["item", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item long, doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit by decreasing length: bin (index of its first item), offset in it, fill of each bin's first item."""
    by_free: dict[int, list[int]] = {}
    free_sizes = 0  # bit f is set when some bin has f free tokens
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = free_sizes >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            held = by_free[free]
            b = held.pop()
            if not held:
                free_sizes &= ~(1 << free)
            offsets[i] = capacity - free
        else:
            b, free = i, capacity
        bins[i] = b
        fill[b] = offsets[i] + size
        if left := free - size:
            by_free.setdefault(left, []).append(b)
            free_sizes |= 1 << left
    return bins, offsets, fill


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, slack: int = SLACK) -> DataFrame:
    """items: item (unique long), length (1..capacity). Returns item, sequence_id, offset."""
    full = items.where(F.col("length") >= capacity - slack).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = items.where(F.col("length") < capacity - slack).select(F.col("item").alias("bin"), "length")

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "bin"], ascending=[False, True], ignore_index=True)
        bins, offsets, fill = best_fit(pdf["length"].to_numpy(), capacity)
        ids = pdf["bin"].to_numpy()
        return pd.DataFrame({"bin": ids, "parent": ids[bins], "offset": offsets, "fill": fill[bins]})

    placed, n = None, loose.count()
    for r in range(MAX_ROUNDS):
        if not n:
            break
        groups = -(-n // group)
        dealt = loose.withColumn("g", F.pmod(F.xxhash64("bin", F.lit(r)), F.lit(groups)))
        done = lazily_once(dealt.groupBy("g").applyInPandas(local, "bin long, parent long, offset long, fill long"), "pack")
        if placed is None:
            placed = done.select(F.col("bin").alias("item"), F.col("parent").alias("sequence_id"), "offset")
        else:
            moved = done.where("bin != parent").select(F.col("bin").alias("sequence_id"), "parent", F.col("offset").alias("by"))
            placed = placed.join(moved, "sequence_id", "left").select(
                "item", F.coalesce("parent", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset")
            )
        loose = done.where((F.col("bin") == F.col("parent")) & (F.col("fill") < capacity - slack)).select("bin", F.col("fill").alias("length"))
        stats = done.agg(F.count_if(F.col("bin") != F.col("parent")).alias("merged"), F.count_if((F.col("bin") == F.col("parent")) & (F.col("fill") < capacity - slack)).alias("n")).first()
        n = stats.n
        if groups == 1 or not stats.merged:
            break
    return full if placed is None else full.unionByName(placed)


def packed(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = lazily_once(pieces(docs, capacity, end_id, tokenizer), "pieces")
    return cut.join(pack(cut, capacity), "item").drop("item")


def op6_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))
