"""Operator 2: near-duplicate documents by SuperMinHash, banding, verification and union-find.

A document's set holds its distinct shingles of ``shingle`` words (A-Z lower-cased); fewer words make
one shingle of the whole sequence; without words the set is empty and links with nothing. Documents
with equal sets form one class, compared once. The steps:

1. One pass over the texts writes each document's text, set digest and band keys
   (``BANDS`` bands of ``ROWS`` SuperMinHash values; a pair at similarity 0.8 shares no band once in
   20 million).
2. A bucket (band key) links its members to its smallest one: candidates are stars, not pairs. Each
   distinct candidate is verified on the full sets, made again for the documents in a candidate only,
   in exact integer arithmetic.
3. In buckets where some members did not link to the smallest, those are compared with all other
   members too, inside a task, in blocks of at most ``BLOCK`` members; only a spanning forest of the
   links found is emitted. So no link between members of a bucket is lost, whatever its size, and no
   task holds more than two blocks.
4. Union-find over the links (``components``).

Both sides of these joins grow with the documents, so they are merge joins at every size.

Shingles are 64-bit hashes, compared whole. Null texts count
as having no words. Rows with equal ids are separate documents with equal sets or not; null ids never
become a component's id unless it has no other (then it is null and nothing is kept). Empty tables
give no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import U64, hash_words, lazily_once, mix, slices, spans, table
from hydrocal.llm.components import components
from hydrocal.llm.superminhash import signatures

SHINGLE = 5
BANDS, ROWS = 32, 4
BLOCK = 512
SIMILARITY = (80, 100)  # links have 100 * intersection >= 80 * union
SETS = "row long, doc_id long, n_shingles long, a long, b long, bands array<long>, text string"


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [x.lower().split() if x else [] for x in texts]
    h = hash_words(b" ".join(b" ".join(w) for w in words if w))
    s = spans(h, size)
    out, at = [], 0
    for w in words:
        n = len(w)
        if n >= size:
            out.append(np.unique(s[at : at + n - size + 1]))
        elif n:
            short = np.full(1, n, np.uint64)
            for k in range(n):
                short = mix(short, h[at + k : at + k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """int64[sets, BANDS]; rows of empty sets mean nothing."""
    sizes = [len(s) for s in sets]
    sig = signatures(np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes), len(sets), BANDS * ROWS)
    sig = sig.reshape(len(sets), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS))
    for r in range(ROWS):
        key = mix(key, sig[:, :, r])
    return key.view(np.int64)


def set_bytes(s: np.ndarray) -> bytes:
    """A set of hashes (sorted, distinct), all 64 bits of each."""
    return s.astype("<u8").tobytes()


def from_bytes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<i8")


def document_sets(docs: DataFrame, shingle: int, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    more = [F.col(f"`{c}`").alias(f"carry_{c}") for c in carry]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
    schema = docs.sparkSession.createDataFrame([], SETS).select("*", *[F.lit(None).cast(docs.schema[c].dataType).alias(f"carry_{c}") for c in carry]).schema

    def sets(batches):
        n = TaskContext.get().partitionId() << 36
        for b in slices(batches, size=1_000_000):
            own = shingle_sets([x.as_py() for x in b.column("text").cast(pa.binary())], shingle)
            with np.errstate(over="ignore"):
                a = [int(np.bitwise_xor.reduce(mix(s, s)).view(np.int64)) if len(s) else 0 for s in own]
                c = [int(np.sum(mix(s, s ^ U64(0x5DEECE66D))).view(np.int64)) if len(s) else 0 for s in own]
            made = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, n + len(own))), b.column("doc_id"), pa.array([len(s) for s in own], pa.int64()),
                 pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(list(band_keys(own)), pa.list_(pa.int64())), b.column("text")],
                names=["row", "doc_id", "n_shingles", "a", "b", "bands", "text"],
            )
            for c in carry:
                made = made.append_column(f"carry_{c}", b.column(f"carry_{c}"))
            yield made
            n += len(own)

    return lazily_once(rows.mapInArrow(sets, schema), "sets")


def shingles_of(sets: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """row, shingles (whole hashes) of the documents in ``rows`` (a column row), from their texts."""

    def again(batches):
        for b in slices(batches, size=1_000_000):
            own = shingle_sets([x.as_py() for x in b.column("text").cast(pa.binary())], size)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([set_bytes(s) for s in own], pa.binary())], names=["row", "shingles"])

    texts = sets.select("row", "text").hint("merge").join(rows.distinct(), "row")
    return lazily_once(texts.mapInArrow(again, "row long, shingles binary"), "shingles")


def _similar(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return SIMILARITY[1] * inter >= SIMILARITY[0] * (a + b - inter)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs: u, rep. Adds linked, from the full sets."""
    held = sets.select(F.col("row").alias("u"), F.col("shingles").alias("su"))
    both = pairs.hint("merge").join(held, "u").hint("merge").join(held.select(F.col("u").alias("rep"), F.col("su").alias("sr")), "rep")

    def check(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("su"), batch.column("sr")):
                x, y = from_bytes(x.as_py()), from_bytes(y.as_py())
                if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
                    ok.append(False)
                    continue
                v = np.sort(np.concatenate([x, y]))
                ok.append(bool(_similar(np.count_nonzero(v[1:] == v[:-1]), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("rep"), pa.array(ok)], names=["u", "rep", "linked"])

    return both.select("u", "rep", "su", "sr").mapInArrow(check, "u long, rep long, linked boolean")


def block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links among two blocks of a bucket (or within one) with a member that is still loose; a spanning forest."""
    pdf = pdf.sort_values("u", ignore_index=True)
    ids, block, loose = pdf["u"].to_numpy(), pdf["block"].to_numpy(), pdf["loose"].to_numpy()
    sets = [from_bytes(s) for s in pdf["shingles"]]
    sizes = np.array([len(s) for s in sets])
    values, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = n[at] > 1  # only shingles of two members or more can meet
    column = (np.cumsum(n > 1) - 1)[at[shared]]
    owner = owner[shared]
    inter = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for first in range(0, int((n > 1).sum()), 4096):
        lo, hi = np.searchsorted(column, (first, first + 4096))
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[lo:hi], column[lo:hi] - first] = 1
        inter += m @ m.T
    inter = inter.astype(np.int64)
    ok = _similar(inter, sizes[:, None], sizes[None, :]) & (loose[:, None] | loose[None, :])
    if block[0] != block[-1] or len(set(block.tolist())) > 1:
        ok &= block[:, None] != block[None, :]
    i, j = np.nonzero(np.triu(ok, 1))
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[ry] = rx
            out.append((ids[x], ids[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def grouped_classes(sets: DataFrame, shingle: int) -> DataFrame:
    """a, b, n_shingles, row, least, root of every class of equal sets: its first row, smallest doc_id and component."""
    key = ["a", "b", "n_shingles"]
    classes = sets.where("n_shingles > 0").groupBy(*key).agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    classes = lazily_once(classes, "classes")
    members = sets.select("row", "bands").hint("merge").join(classes.select("row"), "row").select(F.col("row").alias("u"), F.explode("bands").alias("key"))
    stars = members.groupBy("key").agg(F.min("u").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1")
    in_bucket = lazily_once(members.hint("merge").join(stars, "key").select("key", "u", "rep", "n"), "buckets")
    pairs = lazily_once(in_bucket.where("u != rep").select("u", "rep").distinct(), "pairs")
    full = shingles_of(sets, pairs.select(F.explode(F.array("u", "rep")).alias("row")), shingle)
    checked = lazily_once(verified(pairs, full), "stars")

    # Members not linked to their bucket's smallest: compared with all of the bucket but the smallest.
    rest = in_bucket.where("u != rep and n > 2").hint("merge").join(checked, ["u", "rep"])
    unsure = rest.groupBy("key").agg(F.count_if(~F.col("linked")).alias("loose"), F.count(F.lit(1)).alias("n")).where("loose > 0 and n > 1")
    rest = rest.drop("n").hint("merge").join(unsure.select("key", "n"), "key")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rest = rest.select("key", "u", (~F.col("linked")).alias("loose"), blocks.alias("blocks"), F.pmod(F.xxhash64("u", "key"), blocks).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rest = rest.select("key", "u", "loose", "block", other)
    rest = rest.select("key", "u", "loose", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rest = rest.hint("merge").join(full.withColumnRenamed("row", "u"), "u")
    more = rest.groupBy("key", "i", "j").applyInPandas(block_links, "a long, b long")

    links = checked.where("linked").select(F.col("u").alias("a"), F.col("rep").alias("b")).unionByName(more)
    grouped = components(links)
    return classes.join(grouped, classes["row"] == grouped["node"], "left").select(*key, "row", "least", F.coalesce("root", "row").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    sets = document_sets(docs, shingle, id_col, text_col, [])
    of_class = grouped_classes(sets, shingle).drop("row")
    least = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = of_class.drop("least").join(least, "root")
    key = ["a", "b", "n_shingles"]
    out = sets.select("doc_id", *key).hint("merge").join(of_class, key, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls last), then the first of
    equal ones. Rows without words all stay."""
    others = [c for c in docs.columns if c != text_col]
    sets = document_sets(docs, shingle, id_col, text_col, others)
    of_class, key = grouped_classes(sets, shingle), ["a", "b", "n_shingles"]
    rows = sets.where("n_shingles > 0").select(*key, "row", "doc_id").join(of_class.select(*key, "root"), key)
    stays = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row")).select("row")
    stays = stays.unionByName(sets.where("n_shingles = 0").select("row"))
    out = sets.select("row", "text", *[f"`carry_{c}`" for c in others]).hint("merge").join(stays, "row", "left_semi")
    return out.select(*[F.col("text" if c == text_col else f"`carry_{c}`").alias(c) for c in docs.columns])


def op2_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 4-word shingles: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
