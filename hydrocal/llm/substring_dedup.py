"""Operator 5: substring dedup by level-wise doubling.

A *window* is ``window`` consecutive words of one document; a word is removed when a window covering
it has a word sequence that starts at a second place, in the same document or another.

Level by level, for lengths ``first``, twice that, ... up to ``window``: each window still a candidate
is represented by its least-hashed stretch of that length (its anchor), and survives when the same
stretch is an anchor at two places or more. Equal windows have equal anchors at equal offsets, so no
repeated window is ever lost; at the last length the anchor is the window itself, so the survivors are
the repeated windows. Only survivors are extended, and anchors shared by neighbouring windows are sent
once, so the first level ships about two anchors per ``window - first + 2`` words.

Work is done on *chunks* (a few MB of normalised text, compressed, written once to the shared folder).
A chunk sends its distinct anchors, with a mark for those it holds twice itself, to hash ranges; a
range answers with one bit per anchor. A stretch that a third of all documents hold is one entry per
chunk, so no range is hot. Stretches are compared by 64-bit hashes, independent at each level.

Null texts and texts without words have no windows and stay as they are. Rows with equal (or null) ids
are separate documents. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import U64, hash_words, lazily_once, slices, spans, table

WINDOW = 35
FIRST = 18
RANGE_WORDS = 4_000_000  # words per hash range
CHUNK = "chunk long, doc_ids array<long>, sizes array<int>, words binary, carry binary"


def levels(window: int, first: int) -> list[int]:
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(window, 2 * out[-1]))
    return out


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Documents packed into chunk rows: words joined by single spaces, and the columns of ``carry``, zstd-compressed."""

    def cut(batches):
        n, zstd = TaskContext.get().partitionId() << 36, zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            words = [x.as_py().split() if x.is_valid else [] for x in b.column("text").cast(pa.binary())]
            body = zstd.compress(b" ".join(b" ".join(w) for w in words if w))
            more = b.select([f"carry_{c}" for c in carry or []])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, more.schema) as stream:
                stream.write_batch(more)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([[len(w) for w in words]], pa.list_(pa.int32())), pa.array([body], pa.binary()),
                 pa.array([zstd.compress(sink.getvalue()) if carry else None], pa.binary())],
                names=["chunk", "doc_ids", "sizes", "words", "carry"],
            )
            n += 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry or []])
    return lazily_once(rows.mapInArrow(cut, CHUNK), "chunks")


def sliding(a: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over a[i : i + width] for every full stretch."""
    size, cur, n = 1, a, len(a) - width + 1
    while size * 2 <= width:
        cur = pick(cur[:-size], cur[size:])
        size *= 2
    return cur[:n] if size == width else pick(cur[:n], cur[width - size : width - size + n])


class Chunk:
    """One chunk's windows: which still are candidates, level by level."""

    def __init__(self, words: bytes, sizes: list[int], window: int):
        self.sizes, self.window = np.array(sizes, np.int64), window
        self.hash = hash_words(words)
        ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        n = max(0, len(self.hash) - window + 1)
        self.open = (ends - np.arange(len(ends)))[:n] >= window

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Each candidate window's anchor; the distinct anchors with a mark for those at two places here."""
        g, width = spans(self.hash, length), self.window - length + 1
        if not self.open.any():
            return np.zeros(0, U64), np.zeros((2, 0), U64)
        least = sliding(g, width, np.minimum)
        shown = np.where(self.open, least, U64(0))
        pad = np.zeros(width - 1, U64)
        best = sliding(np.concatenate([pad, shown, pad]), width, np.maximum)
        distinct, n = np.unique(g[best == g], return_counts=True)
        return least[self.open], np.stack([distinct, (n > 1).astype(U64)])

    def keep(self, own: np.ndarray, distinct: np.ndarray, repeated: np.ndarray) -> None:
        """Narrow the candidates to windows whose anchor is repeated."""
        if len(own):
            self.open[np.flatnonzero(self.open)] = repeated[np.searchsorted(distinct, own)]

    def covered(self) -> np.ndarray:
        """True for words that a remaining window covers."""
        change = np.zeros(len(self.hash) + 1, np.int64)
        at = np.flatnonzero(self.open)
        change[at] += 1
        np.add.at(change, at + self.window, -1)
        return np.cumsum(change[:-1]) > 0


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    return ((values >> U64(32)) * U64(ranges)) >> U64(32)


def _bits(answers: list[dict], level: int) -> np.ndarray:
    """One chunk's answers of a level, in hash order."""
    own = sorted((a["range"], a["n"], a["bits"]) for a in answers if a["level"] == level)
    return np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for _, n, b in own)])


def _replayed(row: dict, window: int, lengths: list[int]) -> tuple[Chunk, bytes]:
    """The chunk after the levels of ``lengths``, from the ranges' answers."""
    words = zstandard.ZstdDecompressor().decompress(row["words"], max_output_size=1 << 31)
    c = Chunk(words, row["sizes"], window)
    for length in lengths:
        own, distinct = c.anchors(length)
        c.keep(own, distinct[0], _bits(row["answers"] or [], length))
    return c, words


def _rows(batches):
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """One hash range: per chunk row, a bit for each of its anchors that is repeated anywhere."""
    values = [np.frombuffer(v, np.uint64) for v in pdf["hashes"]]
    marks = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(v)).astype(bool) for m, v in zip(pdf["marks"], values)]
    distinct, at, n = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    repeated = n > 1
    repeated[at[np.concatenate(marks)]] = True
    cuts = np.cumsum([len(v) for v in values])[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(repeated[at], cuts)]
    return pd.DataFrame({"chunk": pdf["chunk"], "level": pdf["level"], "range": pdf["range"], "n": [len(v) for v in values], "bits": bits})


def repeated_windows(packed: DataFrame, window: int, first: int) -> DataFrame:
    """``packed`` with an ``answers`` column from which every level can be replayed."""
    total = packed.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).first().n or 0
    ranges = max(1, -(-total // RANGE_WORDS))
    answers, done = None, []
    for length in levels(window, first):
        with_answers = _attach(packed.drop("carry"), answers)

        def ask(batches, length=length, done=tuple(done)):
            for row in _rows(batches):
                c, _ = _replayed(row, window, list(done))
                distinct, marks = c.anchors(length)[1]
                if not len(distinct):
                    continue
                where = _range_of(distinct, ranges)
                cuts = np.flatnonzero(np.diff(where)) + 1
                yield pa.RecordBatch.from_pydict(
                    {"chunk": [row["chunk"]] * (len(cuts) + 1), "level": [length] * (len(cuts) + 1), "range": where[np.append(0, cuts)].astype(np.int64).tolist(),
                     "hashes": [x.tobytes() for x in np.split(distinct, cuts)], "marks": [np.packbits(x.astype(bool)).tobytes() for x in np.split(marks, cuts)]},
                    schema=pa.schema([("chunk", pa.int64()), ("level", pa.int32()), ("range", pa.int64()), ("hashes", pa.binary()), ("marks", pa.binary())]),
                )

        asked = with_answers.mapInArrow(ask, "chunk long, level int, range long, hashes binary, marks binary")
        # One partition a range: range numbers are dense, so dealing them by range keeps tasks even.
        got = asked.repartition(min(ranges, 50_000), "range").groupBy("range").applyInPandas(_count, "chunk long, level int, range long, n int, bits binary")
        got = lazily_once(got, f"answers{length}")
        answers = got if answers is None else answers.unionByName(got)
        done.append(length)
    return _attach(packed, answers)


def _attach(packed: DataFrame, answers: DataFrame | None) -> DataFrame:
    """The chunks with their answers; always a merge join, as the answers grow with the chunks."""
    if answers is None:
        return packed.withColumn("answers", F.lit(None).cast("array<struct<level:int,range:long,n:int,bits:binary>>"))
    by_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("level", "range", "n", "bits")).alias("answers"))
    return packed.hint("shuffle_merge").join(by_chunk, "chunk", "left")


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, first: int = FIRST, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[bytes], object] | None = None, digest_type: str = "string", carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space, or ``digest`` of their UTF-8),
    and ``carry``'s columns as carry_<name>."""
    digest = digest or (lambda kept: kept.decode())
    lengths = levels(window, first)
    answered = repeated_windows(chunks(docs, id_col, text_col, carry), window, first)

    def remove(batches):
        for row in _rows(batches):
            c, words = _replayed(row, window, lengths)
            covered = c.covered()
            ends = np.cumsum(c.sizes)
            gone = np.concatenate([[0], np.cumsum(covered)])
            gone = gone[ends] - gone[ends - c.sizes]
            raw = np.frombuffer(words, np.uint8)
            starts = np.concatenate([[0], np.flatnonzero(raw == 32) + 1, [len(raw) + 1]])
            kept = []
            for n, end, k in zip(c.sizes.tolist(), ends.tolist(), gone.tolist()):
                text = words[starts[end - n] : starts[end] - 1] if n else b""
                if k == n:
                    text = b""
                elif k:
                    text = b" ".join(w for w, g in zip(text.split(b" "), covered[end - n : end].tolist()) if not g)
                kept.append(digest(text))
            made = pa.RecordBatch.from_pandas(
                pd.DataFrame({"doc_id": pd.array(row["doc_ids"], dtype="Int64"), "n_words": c.sizes, "n_removed": gone, "kept": kept}), preserve_index=False
            )
            if carry:
                body = zstandard.ZstdDecompressor().decompress(row["carry"], max_output_size=1 << 31)
                more = pa.ipc.open_stream(body).read_all().combine_chunks().to_batches()[0]
                for name in more.schema.names:
                    made = made.append_column(name, more.column(name))
            yield made

    schema = docs.sparkSession.createDataFrame([], f"doc_id long, n_words long, n_removed long, kept {digest_type}")
    schema = schema.select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"carry_{c}") for c in carry or []]).schema
    return answered.mapInArrow(remove, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_words, n_removed, kept_sha256."""
    out = substring_dedup(table(spark, sf_dir, "documents"), digest=lambda kept: hashlib.sha256(kept).hexdigest())
    return out.withColumnRenamed("kept", "kept_sha256")
