"""Operator 10: near-duplicate embeddings by product quantisation.

Vectors link when their labels are equal and their cosine in double precision is at least ``COSINE``.
Equal vectors of a label form one class, indexed once. The index:

* a coarse quantiser (k-means, about the square root of the number of classes, ``MAX_LISTS`` at most)
  and residual codebooks (``SPACES`` subspaces of up to 256 codewords), fitted on the ``SAMPLE`` classes
  that come first by a hash; the driver holds nothing else. Their sizes are bounded by parameters;
* every class is indexed: its list, residual codes, and how far the code is from the vector.

Search loses no link. Let x lie in the list of centroid a and y in that of b. Linked unit vectors are at
most ``r = sqrt(2 - 2 COSINE)`` apart, and y is no farther from b than from a, so x is at most r beyond the
plane halfway between them: ``|x - b|^2 - |x - a|^2 <= 2 r |a - b|``. x asks every list for which that
holds (in many dimensions that is a large share of them). In lists with more members than a codebook has
codewords, asymmetric table distances drop members that cannot be near enough even if the code's error
points straight at the query; the others are reranked by exact cosine.

So that a vector is not copied once per list, neighbouring lists form cells of about ``BLOCK`` vectors of a
label, and a vector is sent once to each later cell in which it asks a list; a pair is met once, in the later of its
cells. A cell's members and askers meet in blocks of about ``BLOCK`` (fewer for long vectors), so no task holds
a hot list or group; a block returns each vector's number of links and a spanning forest of them, not
pairs. Components come from union-find.

Vectors that are null, zero, or hold null or non-finite components, and vectors without a label, link
with nothing. Vectors of different length never link. Rows with equal ids are separate vectors. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import hashed_sample, lazily_once, table
from hydrocal.llm.components import components

COSINE = 0.93
SAMPLE, MAX_LISTS, SPACES, CODEWORDS, ROUNDS = 20_000, 2048, 8, 256, 10
BLOCK, BLOCK_BYTES = 4096, 16 << 20
#: Askers compared at a time inside a block.
STEP = 128


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for k in range(0, len(x), 8192):
        out[k : k + 8192] = (x[k : k + 8192] @ centres.T * -2 + (centres * centres).sum(axis=1)).argmin(axis=1)
    return out


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances [x, centres]."""
    return np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1))


def _in_order(centres: np.ndarray) -> np.ndarray:
    """An order of the centres in which neighbours are near each other: halved again and again across their spread."""
    if len(centres) < 3:
        return np.arange(len(centres))
    off = centres - centres.mean(axis=0)
    rank = np.argsort(off @ off[(off * off).sum(axis=1).argmax()], kind="stable")
    halves = np.array_split(rank, 2)
    return np.concatenate([h[_in_order(centres[h])] for h in halves])


def reach(cosine: float) -> float:
    """How far apart linked unit vectors can be."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6


class Quantiser:
    """Coarse centroids and residual codebooks for unit vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.dim = sample.shape[1]
        centres = kmeans(sample, lists, 1)
        self.centres = centres[_in_order(centres)]
        residual = sample - self.centres[_nearest(sample, self.centres)]
        self.cuts = [c for c in np.array_split(np.arange(self.dim), min(SPACES, self.dim))]
        self.books = [kmeans(residual[:, c], CODEWORDS, 2 + i) for i, c in enumerate(self.cuts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """list, codes, and distance of code and vector, of unit vectors."""
        near = _nearest(x, self.centres)
        residual = x - self.centres[near]
        codes = np.stack([_nearest(residual[:, c], b) for c, b in zip(self.cuts, self.books)], axis=1)
        coded = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return near, codes.astype(np.uint8), np.linalg.norm(residual - coded, axis=1)

    def asks(self, x: np.ndarray, own: np.ndarray, lists: slice | np.ndarray, cosine: float) -> np.ndarray:
        """bool[x, lists]: whether a list can hold a vector linked to x, a unit vector of list ``own``."""
        there, here = self.centres[lists], self.centres[own]
        beyond = _squares(x, there) - ((x - here) ** 2).sum(axis=1)[:, None]
        return beyond <= 2 * reach(cosine) * np.sqrt(_squares(here, there)) + 1e-6

    def table_distance(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances [queries, members] within list ``at``, by table look-up."""
        out = np.zeros((len(queries), len(codes)))
        residual = queries - self.centres[at]
        for i, (c, book) in enumerate(zip(self.cuts, self.books)):
            part = residual[:, c]
            look = (part * part).sum(axis=1)[:, None] - 2 * part @ book.T + (book * book).sum(axis=1)
            out += look[:, codes[:, i]]
        return np.sqrt(np.maximum(out, 0))


def vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """row, vec_id, label, dim (0: links with nothing), vec (float64 bytes)."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))

    def check(batches):
        n = TaskContext.get().partitionId() << 36
        for b in batches:
            dims, raw = [], []
            for v, label in zip(b.column("v"), b.column("label")):
                ok = v.is_valid and label.is_valid and len(v) > 0 and v.values.null_count == 0
                x = v.values.to_numpy() if ok else np.zeros(0)
                with np.errstate(all="ignore"):
                    ok = ok and bool(np.isfinite(x).all()) and bool((x != 0).any())
                    if ok:  # scaled by a power of two, which is exact, so that squares stay finite
                        x = x * 2.0 ** -np.frexp(np.abs(x).max())[1] + 0.0
                dims.append(len(x) if ok else 0)
                raw.append(x.astype("<f8").tobytes() if ok else b"")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, n + len(b))), b.column("vec_id"), b.column("label"), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                names=["row", "vec_id", "label", "dim", "vec"],
            )
            n += len(b)

    return lazily_once(rows.mapInArrow(check, "row long, vec_id long, label string, dim int, vec binary"), "vectors")


def block_links(q: Quantiser, pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """One block: askers against members, or, if it is a block of a cell with itself, members against later ones."""
    pdf = pdf.sort_values(["side", "own", "row"])
    itself = bool(pdf["within"].iloc[0]) and pdf["i"].iloc[0] == pdf["j"].iloc[0]
    n_m = int((pdf["side"] == 0).sum())
    v = np.stack([np.frombuffer(x, "<f8") for x in pdf["vec"]])
    unit, norm = _unit(v), np.sqrt((v * v).sum(axis=1))
    row, own, copies, error = (pdf[c].to_numpy() for c in ("row", "own", "copies", "error"))
    codes = np.stack([np.frombuffer(c, np.uint8) for c in pdf["codes"]])
    first_asker, degree, group, forest = (0 if itself else n_m), np.zeros(len(v), np.int64), np.arange(len(v)), []
    cuts = np.searchsorted(own[:n_m], np.unique(own[:n_m])).tolist() + [n_m]
    for lo, hi in zip(cuts, cuts[1:]):  # the members of one list
        at, last = int(own[lo]), hi if itself else len(v)
        for k in range(first_asker, last, STEP):
            a = np.arange(k, min(k + STEP, last))
            a = a[q.asks(unit[a], own[a], np.array([at]), cosine)[:, 0]]
            if not len(a):
                continue
            if hi - lo > CODEWORDS:
                near = q.table_distance(unit[a], at, codes[lo:hi]) <= reach(cosine) + error[lo:hi]
            else:
                near = unit[a] @ unit[lo:hi].T >= cosine - 1e-9
            if itself:
                near &= a[:, None] < np.arange(lo, hi)
            x, y = np.nonzero(near)
            x, y = a[x], y + lo
            keep, some = np.zeros(len(x), bool), max(1, (4 << 20) // v.shape[1])
            for c in range(0, len(x), some):  # exact rerank
                f, g = x[c : c + some], y[c : c + some]
                keep[c : c + some] = np.einsum("nd,nd->n", v[f], v[g]) / (norm[f] * norm[g]) >= cosine
            x, y = x[keep], y[keep]
            np.add.at(degree, x, copies[y])
            np.add.at(degree, y, copies[x])
            start = np.flatnonzero(np.diff(x, prepend=-1)).tolist()
            for s, e in zip(start, start[1:] + [len(x)]):  # one asker joins the groups that it links to
                mine, theirs = group[x[s]], group[y[s:e]]
                if (theirs != mine).any():
                    other, where = np.unique(theirs, return_index=True)
                    where, other = where[other != mine], other[other != mine]
                    forest += [(int(row[x[s]]), int(row[y[s + w]]), 0) for w in where.tolist()]
                    group[np.isin(group, other)] = mine
    linked = np.flatnonzero(degree)
    deg = [(r, None, n) for r, n in zip(row[linked].tolist(), degree[linked].tolist())]
    out = pd.DataFrame(forest + deg, columns=["a", "b", "n"])
    return out.astype({"a": "int64", "b": "Int64", "n": "int64"})


def searcher(q: Quantiser, cosine: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda pdf: block_links(q, pdf, cosine)


def linked_vectors(df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    rows = vectors(df, id_col, vec_col, label_col)
    key = ["label", "dim", "h1", "h2"]
    rows = rows.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(11), F.col("vec")))
    classes = rows.where("dim > 0").groupBy(*key).agg(F.min("row").alias("row"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = lazily_once(classes, "classes")
    found = None
    for dim, n in [(r.dim, r.n) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()]:
        part = rows.where(F.col("dim") == dim).select("row", "vec").join(classes.select("row", "label", "copies"), "row")
        first = hashed_sample(part, "row", sample).select("vec").toPandas()["vec"]
        q = Quantiser(_unit(np.stack([np.frombuffer(v, "<f8") for v in first])), int(min(MAX_LISTS, max(1, n**0.5))))

        def index(batches, q=q):
            for b in batches:
                for k in range(0, b.num_rows, 4096):
                    s = b.slice(k, 4096)
                    near, codes, error = q.encode(_unit(np.stack([np.frombuffer(v.as_buffer(), "<f8") for v in s.column("vec")])))
                    for name, col in (("own", pa.array(near, pa.int64())), ("codes", pa.array([c.tobytes() for c in codes], pa.binary())), ("error", pa.array(error))):
                        s = s.append_column(name, col)
                    yield s

        indexed = lazily_once(part.mapInArrow(index, "row long, vec binary, label string, copies long, own long, codes binary, error double"), "index")
        size = max(1, min(BLOCK, BLOCK_BYTES // (8 * dim)))
        most = np.zeros(len(q.centres), np.int64)  # members of a list, of the label that has most there
        for r in indexed.groupBy("label", "own").count().groupBy("own").agg(F.max("count").alias("n")).collect():
            most[r.own] = r.n
        cell_of, full = np.zeros(len(most), np.int64), 0
        for k, n_k in enumerate(most.tolist()):
            over = full > 0 and full + n_k > size
            cell_of[k], full = (cell_of[k - 1] if k else 0) + over, n_k if over else full + n_k
        starts = np.flatnonzero(np.diff(cell_of, prepend=-1))

        def cells(batches, q=q, cell_of=cell_of, starts=starts):
            for b in batches:
                for k in range(0, b.num_rows, 1024):
                    s = b.slice(k, 1024)
                    own = s.column("own").to_numpy()
                    asked = q.asks(_unit(np.stack([np.frombuffer(v.as_buffer(), "<f8") for v in s.column("vec")])), own, slice(None), cosine)
                    asked = np.logical_or.reduceat(asked, starts, axis=1)
                    home = cell_of[own]
                    later = [(np.flatnonzero(a[h + 1 :]) + h + 1).tolist() for a, h in zip(asked, home.tolist())]
                    yield s.append_column("home", pa.array(home, pa.int64())).append_column("later", pa.array(later, pa.list_(pa.int64())))

        placed = indexed.mapInArrow(cells, "row long, vec binary, label string, copies long, own long, codes binary, error double, home long, later array<long>")
        placed = lazily_once(placed, "cells")
        blocks = lambda n: F.ceil(F.count(F.lit(1)) / size).cast("long").alias(n)
        sizes = placed.groupBy("label", F.col("home").alias("cell")).agg(blocks("mb"))
        asks = placed.select("label", F.explode("later").alias("cell")).groupBy("label", "cell").agg(blocks("ab"))
        sizes = sizes.join(asks, ["label", "cell"], "left").withColumn("ab", F.coalesce("ab", F.lit(0).cast("long")))
        block = lambda n: F.pmod(F.xxhash64("row", F.lit(3)), F.col(n))
        each = lambda n: F.filter(F.sequence(F.lit(0).cast("long"), F.col(n)), lambda x: x < F.col(n))
        what = ["label", "cell", "row", "vec", "copies", "own", "codes", "error"]
        # A member meets each block of its own cell (the lower block is side 0), and the blocks of askers from other cells.
        members = placed.withColumnRenamed("home", "cell").join(sizes, ["label", "cell"]).withColumn("b", block("mb"))
        inside = F.transform(each("mb"), lambda x: F.struct(F.lit(True).alias("within"), (x < F.col("b")).cast("int").alias("side"), F.least(x, "b").alias("i"), F.greatest(x, "b").alias("j")))
        outside = F.transform(each("ab"), lambda x: F.struct(F.lit(False).alias("within"), F.lit(0).alias("side"), F.col("b").alias("i"), x.alias("j")))
        members = members.select(*what, F.inline(F.concat(inside, outside)))
        askers = placed.withColumn("cell", F.explode("later")).join(sizes, ["label", "cell"])
        askers = askers.select(*what, F.lit(False).alias("within"), F.lit(1).alias("side"), F.explode(each("mb")).alias("i"), block("ab").alias("j"))
        met = members.unionByName(askers).groupBy("label", "cell", "within", "i", "j")
        got = met.applyInPandas(searcher(q, cosine), "a long, b long, n long")
        found = got if found is None else found.unionByName(got)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = lazily_once(found, "links")
    degree = found.where("b is null").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("links"))
    grouped = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "row")
    of_class = classes.join(grouped, "row", "left").join(degree, "row", "left").select(*key, F.coalesce("root", "row").alias("root"), "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    least = of_class.groupBy("root").agg(F.min("least").alias("component"))
    of_class = of_class.drop("least").join(least, "root")
    out = rows.select("vec_id", *key).join(of_class, key, "left")
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op10_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: vec_id, n_links, component_id, kept."""
    return linked_vectors(table(spark, sf_dir, "embeddings"))
