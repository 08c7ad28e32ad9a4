"""Operator 1: token ids in a binary format, coded by a static range asymmetric numeral system.

``write_ids`` encodes every text with the tokenizers library, appends an end id and writes a folder:

* ``ids``     scratch, deleted after use: each document's raw ids and the range that its id lies in, and
  each task's token counts. Texts are read once and never shuffled; ids are, a fraction of their size;
* ``table``   token, freq: one frequency table for all blocks, from the counts of *all* ids, scaled to
  a power of two (at most one row per vocabulary entry, so shipping it to tasks is bounded);
* ``blocks``  part, block, n_tokens, doc_ids, sizes, lanes, check_steps, steps, states, word_at, words, crc;
  one file per range, in ascending order of ids by name.

A block is coded on its own: token ``i`` belongs to lane ``i mod lanes``; the lanes' 64-bit states
share one stream of 32-bit words. Every ``check_steps`` steps a checkpoint holds the lane states, the
place in the stream and the CRC-32 of the ids up to the next one, so all stretches of all blocks
decode side by side and each is verified. Every file is written by Spark's committers, so lost
executors only repeat tasks. ``read_ids`` decodes the blocks.

Null text counts as empty (only the end id). Rows with equal ids are separate documents, ordered by the
first 200 characters of their texts, then by token ids; null ids come first. An empty table gives an empty folder and no rows. Only the two named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hydrocal.llm.common import drop_path, parts_for, slices, table
from hydrocal.llm.tokens import default_tokenizer_path, encoder
from hydrocal.session import ensure_checkpoint_dir

LANES = 512
BLOCK_TOKENS = 1 << 18
CHECK_STEPS = 128  # steps between checkpoints: 65,536 tokens
LOW = 1 << 31  # states stay in [LOW, LOW << 32)
END_ID = 2
U = np.uint64

TIE_CHARS = 200
IDS_SCHEMA = "part int, doc_id long, head string, ids binary, token long, n long"
IDS_COLUMNS = ["part", "doc_id", "head", "ids", "token", "n"]
BLOCK_SCHEMA = (
    "part int, block int, n_tokens long, doc_ids array<long>, sizes array<int>, lanes int, check_steps int, steps int, "
    "states binary, word_at array<long>, words binary, crc array<long>"
)


def _raw(ids: np.ndarray) -> bytes:
    """A byte that gives the width, then the ids in two bytes each where they fit, else four."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def _from_raw(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def scaled(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """tokens, frequencies that sum to 2**bits with each at least 1, bits."""
    tokens = np.array(sorted(counts), np.int64)
    n = np.array([counts[t] for t in tokens.tolist()], np.float64)
    bits = max(16, int(np.ceil(np.log2(max(2, len(tokens))))) + 4)
    total = 1 << bits
    freq = np.maximum(1, np.floor(n / n.sum() * total)).astype(np.int64)
    rest = total - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest >= 0:
        freq[order[0]] += rest
    for i in order.tolist():  # too many ones were rounded up: take from the most frequent
        if rest >= 0:
            break
        take = min(-rest, int(freq[i]) // 2)
        freq[i] -= take
        rest += take
    return tokens, freq, bits


def encode_blocks(blocks: list[np.ndarray], tokens: np.ndarray, freq: np.ndarray, bits: int, lanes: int = LANES, check_steps: int = CHECK_STEPS) -> list[dict]:
    """Code id arrays side by side; each result holds lanes, check_steps, steps, states,
    word_at, words and crc."""
    size = int(tokens[-1]) + 2
    f_of, c_of = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
    f_of[tokens], c_of[tokens] = freq, np.cumsum(freq) - freq
    f_of[-1] = 1 << bits  # the padding symbol: it has the whole range, so it changes no state
    steps = [max(1, -(-len(b) // lanes)) for b in blocks]
    most = max(steps)
    padded = np.full((len(blocks), most * lanes), size - 1, np.int64)
    for row, b in zip(padded, blocks):
        row[: len(b)] = b
    padded = padded.reshape(len(blocks), most, lanes)
    x = np.full((len(blocks), lanes), LOW, np.uint64)
    words = np.zeros((len(blocks), most, lanes), np.uint32)
    used = np.zeros((len(blocks), most, lanes), bool)
    kept = {}
    top, shift, word = U((LOW >> bits) << 32), U(bits), U(32)
    for t in range(most - 1, -1, -1):
        s = padded[:, t, :]
        f = f_of[s]
        full = x >= f * top
        words[:, t, :] = x  # the low 32 bits
        used[:, t, :] = full
        x = np.where(full, x >> word, x)
        q = x // f
        x = (q << shift) + (x - q * f) + c_of[s]
        if t % check_steps == 0:
            kept[t] = x.copy()
    out = []
    for g, b in enumerate(blocks):
        at = np.concatenate([[0], np.cumsum(used[g, : steps[g]].sum(axis=1))])
        marks = range(0, steps[g], check_steps)
        raw = b.astype("<u4")
        out.append(
            {
                "lanes": lanes,
                "check_steps": check_steps,
                "steps": steps[g],
                "states": np.concatenate([kept[t][g] for t in marks]).astype("<u8").tobytes(),
                "word_at": [int(at[t]) for t in marks],
                "words": words[g, : steps[g]][used[g, : steps[g]]].astype("<u4").tobytes(),
                "crc": [zlib.crc32(raw[t * lanes : (t + check_steps) * lanes].tobytes()) for t in marks],
            }
        )
    return out


def decode_blocks(rows: list[dict], tokens: np.ndarray, freq: np.ndarray, bits: int) -> list[np.ndarray]:
    """The ids of blocks; all stretches between checkpoints decode side by side. Verifies checksums.
    Lanes and checkpoint distance are those that each block states."""
    kinds = {(r["lanes"], r["check_steps"]) for r in rows}
    if len(kinds) > 1:
        out: list = [None] * len(rows)
        for kind in kinds:
            own = [i for i, r in enumerate(rows) if (r["lanes"], r["check_steps"]) == kind]
            for i, ids in zip(own, decode_blocks([rows[i] for i in own], tokens, freq, bits)):
                out[i] = ids
        return out
    [(lanes, check_steps)] = kinds
    cum = np.cumsum(freq) - freq
    # one large table, of each slot's token by rank; what belongs to a token is looked up in small ones
    rank_at = np.repeat(np.arange(len(tokens)), freq).astype(np.uint16 if len(tokens) <= 1 << 16 else np.uint32)
    symbol, f_of, c_of = tokens.astype(np.uint32), freq.astype(np.uint64), cum.astype(np.uint64)
    streams = [np.frombuffer(r["words"], "<u4") for r in rows]
    base = np.cumsum([0, *map(len, streams)])
    words = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    x = np.concatenate([np.frombuffer(r["states"], "<u8") for r in rows]).astype(np.uint64).reshape(-1, lanes)
    at = np.concatenate([base[i] + np.array(r["word_at"], np.int64) for i, r in enumerate(rows)])
    stretch = check_steps * lanes
    left = np.concatenate(
        [np.minimum(stretch, r["n_tokens"] - stretch * np.arange(len(r["word_at"]))) for r in rows]
    ).astype(np.int64)
    out = np.zeros((len(x), stretch), np.uint32)
    low, shift, word, mask, lane = U(LOW), U(bits), U(32), U((1 << bits) - 1), np.arange(lanes)
    live = np.arange(len(x))
    for t in range(check_steps):
        if not len(live := live[left[live] > t * lanes]):
            break
        v = x[live]
        valid = (left[live] - t * lanes)[:, None] > lane
        slot = v & mask
        rank = rank_at[slot.astype(np.int64)]
        out[live, t * lanes : (t + 1) * lanes] = symbol[rank]
        v = np.where(valid, f_of[rank] * (v >> shift) + (slot - c_of[rank]), v)
        need = (v < low) & valid
        n = np.cumsum(need, axis=1)
        v = np.where(need, (v << word) | words[np.where(need, at[live][:, None] + n - 1, len(words) - 1)], v)
        at[live] += n[:, -1]
        x[live] = v
    result, k = [], 0
    for r in rows:
        marks = len(r["word_at"])
        ids = out[k : k + marks].reshape(-1)[: r["n_tokens"]]
        for i in range(marks):
            if zlib.crc32(ids[i * stretch : (i + 1) * stretch].astype("<u4").tobytes()) != r["crc"][i]:
                raise ValueError(f"damaged block: part {r['part']}, block {r['block']}, checkpoint {i}")
        if not (x[k + marks - 1] == low).all():
            raise ValueError(f"damaged block: part {r['part']}, block {r['block']}, final states")
        result.append(ids)
        k += marks
    return result


def _groups(rows: Iterator[pa.RecordBatch], most: int = 16) -> Iterator[list[dict]]:
    """Rows as dicts in lists of at most ``most`` blocks."""
    for batch in rows:
        for k in range(0, batch.num_rows, most):
            yield batch.slice(k, most).to_pylist()


def range_bounds(rows: DataFrame, parts: int) -> np.ndarray:
    """Ids that cut the rows into about equal ranges, at most ``parts``: quantiles of a sample of the ids
    alone, about 60 a part. They only decide how the work is dealt."""
    ids = rows.select("doc_id").where("doc_id is not null")
    n = ids.count()
    rate = min(1.0, 60 * parts / max(1, n))
    found = np.sort(np.array([r.doc_id for r in ids.sample(rate, seed=7).collect()], np.int64))
    return np.unique(found[np.arange(1, parts) * len(found) // parts]) if len(found) else found


def write_ids(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, end_id: int = END_ID,
) -> None:
    """Encode ``docs`` into the folder ``path`` (which must not exist)."""
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer_path()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bounds = range_bounds(rows, parts_for(rows, 6 << 20))

    def tokenise(batches):
        enc, seen = encoder(tokenizer), np.zeros(0, np.int64)
        for b in slices(batches, size=5_000_000):
            ids = [np.append(x, np.int32(end_id)) for x in enc.encode(b.column("text"))]
            n = np.bincount(np.concatenate(ids), minlength=len(seen))
            n[: len(seen)] += seen
            seen = n
            doc = b.column("doc_id")
            part = np.where(pc.is_null(doc).to_numpy(zero_copy_only=False), 0, np.searchsorted(bounds, pc.fill_null(doc, 0).to_numpy(), side="right"))
            head = pc.utf8_slice_codeunits(pc.fill_null(b.column("text"), ""), 0, TIE_CHARS)
            nothing = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), doc, head, pa.array([_raw(x) for x in ids], pa.binary()), nothing.cast(pa.int64()), nothing.cast(pa.int64())], names=IDS_COLUMNS)
        used = np.flatnonzero(seen)
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.string()), none.cast(pa.binary()), pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], names=IDS_COLUMNS)

    raw_path = f"{path}/ids"
    rows.mapInArrow(tokenise, IDS_SCHEMA).write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.schema(IDS_SCHEMA).parquet(raw_path)
    counts = raw.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    counts = {r.token: r.n for r in counts.collect()}  # at most one row per vocabulary entry
    tokens, freq, bits = scaled(counts) if counts else (np.array([end_id]), np.array([1 << 16]), 16)
    pairs = [(int(t), int(f), bits) for t, f in zip(tokens, freq)]
    spark.createDataFrame(pairs, "token int, freq long, bits int").coalesce(1).write.parquet(f"{path}/table")

    def code(batches):
        block, doc_ids, ids, size, part, full = 0, [], [], 0, None, []

        def close():
            nonlocal block, doc_ids, ids, size
            full.append({"part": part, "block": block, "n_tokens": size, "doc_ids": doc_ids, "sizes": [len(x) for x in ids], "ids": np.concatenate(ids)})
            block, doc_ids, ids, size = block + 1, [], [], 0

        def coded():
            out = encode_blocks([r.pop("ids").astype(np.int64) for r in full], tokens, freq, bits)
            batch = pa.RecordBatch.from_pylist([r | c for r, c in zip(full, out)], schema=BLOCK_ARROW)
            full.clear()
            return batch

        for b in batches:
            for p, doc, raw_ids in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "ids"))):
                part = p
                doc_ids.append(doc)
                ids.append(_from_raw(raw_ids))
                size += len(ids[-1])
                if size >= BLOCK_TOKENS:
                    close()
                    if len(full) == 16:
                        yield coded()
        if ids:
            close()
        if full:
            yield coded()

    # Partition and part are the same number, so the files' names are in the order of the ids.
    dealt = raw.where("token is null").select("part", "doc_id", "head", "ids").repartitionById(len(bounds) + 1, "part")
    dealt = dealt.sortWithinPartitions("doc_id", "head", "ids").drop("head")
    dealt.mapInArrow(code, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_path(spark, raw_path)


BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("sizes", pa.list_(pa.int32())), ("lanes", pa.int32()), ("check_steps", pa.int32()), ("steps", pa.int32()), ("states", pa.binary()),
     ("word_at", pa.list_(pa.int64())), ("words", pa.binary()), ("crc", pa.list_(pa.int64()))]
)


def read_ids(spark: SparkSession, path: str, digest: Callable[[np.ndarray], object] | None = None, digest_type: str = "array<int>") -> DataFrame:
    """Decode a folder: doc_id, start (ids of all documents before it), n_tokens, and ``ids``.

    ``digest`` maps a document's ids (uint32 array) to the value kept instead of the ids.
    """
    table_rows = spark.read.parquet(f"{path}/table").orderBy("token").collect()  # bounded by the vocabulary
    tokens, freq = (np.array([r[k] for r in table_rows], np.int64) for k in (0, 1))
    bits = table_rows[0].bits
    digest = digest or (lambda ids: ids.astype(np.int32))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")

    def decode(batches):
        import pandas as pd

        for group in _groups(batches):
            for r, ids in zip(group, decode_blocks(group, tokens, freq, bits)):
                ends = np.cumsum(r["sizes"])
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame({
                        "doc_id": pd.array(r["doc_ids"], dtype="Int64"), "part": np.int32(r["part"]), "block": np.int32(r["block"]),
                        "inside": ends - r["sizes"], "n_tokens": np.array(r["sizes"], np.int64),
                        "ids": [digest(ids[e - s : e]) for e, s in zip(ends.tolist(), r["sizes"])],
                    }), preserve_index=False)

    docs = blocks.mapInArrow(decode, f"doc_id long, part int, block int, inside long, n_tokens long, ids {digest_type}")
    # Starts: block sizes summed within parts, part sizes over the parts (one short row per part).
    meta = blocks.select("part", "block", "n_tokens")
    parts = meta.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_start"))
    before = W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    meta = meta.select("part", "block", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("block_start"))
    index = meta.join(parts, "part")
    start = F.col("part_start") + F.col("block_start") + F.col("inside")
    return docs.join(index, ["part", "block"]).select("doc_id", start.alias("start"), "n_tokens", "ids")


def op1_token_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through ``write_ids`` and ``read_ids``: doc_id, start, n_tokens, ids_crc32."""
    import uuid

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), path)
    out = read_ids(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "long")
    return out.select("doc_id", "start", "n_tokens", F.col("ids").alias("ids_crc32"))
