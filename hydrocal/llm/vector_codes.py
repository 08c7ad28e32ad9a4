"""Operator 11: vector code compression with adaptive distance bounds (Drake and Hamerly).

A vector becomes whole numbers, floor(scale * x), cut into equal consecutive parts; each part is
replaced by the index of its codebook's nearest entry. Codebooks start as the parts of the vectors with
the smallest ids and are improved by rounds of assignment and componentwise means (rounded down).

The first assignment measures all entries. It keeps, per part, the b closest entries in order, with a
lower bound on each distance and one outer bound on all other entries' distances. A later round lowers
each bound by what its entry moved (the outer one by the largest move), puts the bounds in order again,
measures the part's own entry and looks only at entries whose bound does not exceed that. Bounds are
whole sixteenths, rounded so that they hold, and decide only what is strictly nearer; all else is
measured in integers, so codes equal those of a full search, ties included. b begins at a quarter of the
entries and falls, to an eighth at least, as far as 99 % of the parts needed it in the round before.

Each round is one pass over a written table (bounds and vectors side by side, no shuffle); counts and
sums of entries come out of the same pass, one row per entry and task. Codebooks are all the driver
holds.

Rows whose vector is null, empty, or holds null or non-finite components are dropped, and so are
components of 2**18 or more (their squares would leave 64 bits) and vectors of another length than the
commonest (the longer of equally common ones). If that length is no multiple of ``parts``, no vector can
be cut and ValueError is raised. Null ids come last among the smallest ids; rows of equal ids are
ordered by their vectors, and each row gets its own result. Fewer rows than entries give as many
entries as rows. Rows without a label are one group. Empty tables give no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hydrocal.llm.common import drop_path, lazily_once, recorded, table
from hydrocal.operators.joins import fits_broadcast

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 18  # of a component
CAP = (1 << 16) - 1  # of a stored bound, in sixteenths
CELLS = 1 << 19  # numbers of a slice of vectors
HOT_ROWS = 1 << 20  # rows of a label that count as many, where the labels are too many to broadcast


def root_below(d: np.ndarray) -> np.ndarray:
    """floor(16 * sqrt(d)) of squared distances below 2**54, exactly."""
    x = d.astype(np.int64) * 256
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def root_above(d: np.ndarray) -> np.ndarray:
    """ceil(16 * sqrt(d)), exactly."""
    r = root_below(d)
    return r + (r * r < d.astype(np.int64) * 256)


def all_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (n, k) of integer vectors; by floats only where those are exact."""
    most = max(1, int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 52:
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return ((x[:, None, :] - entries) ** 2).sum(2)


def measured(x: np.ndarray, entries: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Full search: nearest entries in order (n, keep), the nearest first (of ties the lowest), their
    lower bounds, the outer bound, and the squared distance of the nearest."""
    d = all_distances(x, entries)
    rows, best = np.arange(len(x)), d.argmin(1)
    own = d[rows, best]
    d[rows, best] = -1
    if keep < len(entries):
        near = np.argpartition(d, keep, axis=1)[:, : keep + 1]
        outer = np.minimum(root_below(d[rows, near[:, keep]]), CAP)
        near = near[:, :keep]
    else:
        near, outer = np.tile(np.arange(len(entries)), (len(x), 1)), np.full(len(x), CAP, np.int64)
    at = np.take_along_axis(d, near, 1)
    order = at.argsort(1, kind="stable")
    near, at = np.take_along_axis(near, order, 1), np.take_along_axis(at, order, 1)
    at[:, 0] = own
    return near, np.minimum(root_below(at), CAP), outer, own


def reassigned(
    x: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray, entries: np.ndarray, moved: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same as ``measured`` from an earlier result and how far entries ``moved`` since (sixteenths,
    rounded up), and how many ranks each part needed (b + 1: all entries)."""
    n, b = near.shape
    near, low = near.astype(np.int64), low.astype(np.int64)
    low = np.maximum(low - moved[near], 0)
    outer = np.maximum(outer.astype(np.int64) - moved.max(initial=0), 0)
    order = np.concatenate([np.zeros((n, 1), np.int64), low[:, 1:].argsort(1, kind="stable") + 1], axis=1)
    near, low = np.take_along_axis(near, order, 1), np.take_along_axis(low, order, 1)
    own = ((x - entries[near[:, 0]]) ** 2).sum(1)
    reach = root_above(own)
    low[:, 0] = np.minimum(root_below(own), CAP)
    need = 1 + (low[:, 1:] <= reach[:, None]).sum(1)
    need[reach >= outer] = b + 1
    width = 2
    while width < 2 * b:
        sel = np.flatnonzero((need > max(1, width // 2)) & (need <= min(width, b)))
        width *= 2
        if not len(sel):
            continue
        w = int(need[sel].max())
        cand = near[sel, :w]
        d = ((x[sel, None, :] - entries[cand]) ** 2).sum(2)
        looked = np.arange(w) < need[sel, None]
        least = np.where(looked, d, np.iinfo(np.int64).max).min(1)
        best = np.where(looked & (d == least[:, None]), cand, len(entries)).min(1)
        own[sel] = least
        bound = low[sel]
        bound[:, :w] = np.where(looked, np.minimum(root_below(d), CAP), bound[:, :w])
        first = near[sel] == best[:, None]
        order = np.where(first, -1, bound).argsort(1, kind="stable")
        near[sel], low[sel] = np.take_along_axis(near[sel], order, 1), np.take_along_axis(bound, order, 1)
    if len(sel := np.flatnonzero(need > b)):
        near[sel], low[sel], outer[sel], own[sel] = measured(x[sel], entries, b)
    if keep < b:
        outer = np.minimum(outer, low[:, keep])
        near, low = near[:, :keep], low[:, :keep]
    return near, low, outer, own, need


def _binary(m: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    m = np.ascontiguousarray(m)
    size = m.itemsize * int(np.prod(m.shape[1:]))
    ends = np.arange(len(m) + 1, dtype=np.int32) * size
    return pa.BinaryArray.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(ends), pa.py_buffer(m)])


def _matrix(col: pa.Array, kind: str) -> np.ndarray:
    """The inverse of ``_binary``: (rows, numbers)."""
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(col), -1)


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, vector of the rows that take part, of any length."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vec_col}`").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float(LARGEST))))
    return rows.where((F.size("vector") > 0) & sound)


def first_rows(rows: DataFrame, n: int) -> np.ndarray:
    """The vectors of the n smallest ids (nulls last, then by vector). Ids alone are compared first, so
    that few vectors travel; the n rows are gathered by a shuffle, not in the driver."""
    ids = rows.select("vec_id").where("vec_id is not null").orderBy("vec_id").limit(n)
    top = ids.agg(F.count(F.lit(1)).alias("n"), F.max("vec_id").alias("top")).first()
    near = rows.where(F.col("vec_id") <= F.lit(top.top)) if top.n == n else rows
    best = lazily_once(near.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(n), "first")
    got = best.orderBy(F.asc_nulls_last("vec_id"), "vector").collect()
    return np.array([r.vector for r in got], np.float64)


class Codebooks:
    """Entries of every part position, (parts, k, width), and how far they moved last."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.moved = entries, np.zeros(entries.shape[:2], np.int64)

    def improved(self, sums: dict[tuple[int, int, int], int], counts: dict[tuple[int, int], int]) -> Codebooks:
        new = self.entries.copy()
        for (p, e, j), s in sums.items():
            new[p, e, j] = s // counts[p, e]
        out = Codebooks(new)
        out.moved = root_above(((new - self.entries) ** 2).sum(2))
        return out

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _sums(state: DataFrame) -> tuple[dict, dict, np.ndarray]:
    """Component sums and counts per entry, and parts per number of ranks needed: at most a codebook."""
    rows = state.where("part is not null").select("part", "entry", "n", F.posexplode_outer("sums").alias("j", "s"))
    got = rows.groupBy("part", "entry", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    sums = {(r.part, r.entry, r.j): r.s for r in got if r.part >= 0}
    need = np.zeros(1 + max([0, *(r.entry for r in got if r.part < 0)]), np.int64)
    for r in got:
        if r.part < 0:
            need[r.entry] = r.n
    return sums, {(r.part, r.entry): r.n for r in got if r.part >= 0}, need


def adapted(need: np.ndarray, b: int, k: int) -> int:
    """b for the next round: what 99 % of the parts needed, from an eighth of the entries to b."""
    inside = need[: b + 1]
    if not inside.sum():
        return b
    enough = int(np.searchsorted(np.cumsum(inside), 0.99 * inside.sum()))
    return max(min(b, enough), min(b, max(1, k // 8)))


def _pass(books: Codebooks, label: pa.DataType, b: int, keep: int, first: bool, last: bool, scale: int):
    """The Arrow function of one round. ``first``: vectors come in; ``last``: codes go out."""
    parts, k, width = books.entries.shape

    def run(batches):
        n_of = np.zeros((parts, k), np.int64)
        sum_of = np.zeros((parts, k, width), np.int64)
        need_of = np.zeros(b + 2, np.int64)
        for batch in batches:
            step = max(1, CELLS // (parts * max(width, k)))
            for at in range(0, batch.num_rows, step):
                s = batch.slice(at, step)
                if first:
                    x = np.floor(s.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).astype(np.int32)
                    x = x.reshape(s.num_rows, parts, width)
                else:
                    x = _matrix(s.column("vector"), "<i4").reshape(s.num_rows, parts, width)
                    near, low = (_matrix(s.column(c), t).reshape(s.num_rows, parts, b) for c, t in (("near", "u1"), ("low", "<u2")))
                    outer = _matrix(s.column("outer"), "<u2")
                nears, lows, outers = (np.zeros((s.num_rows, parts, *d), t) for d, t in (((keep,), "u1"), ((keep,), "<u2"), ((), "<u2")))
                error = np.zeros(s.num_rows, np.int64)
                for p in range(parts):
                    xp = x[:, p].astype(np.int64)
                    if first:
                        nears[:, p], lows[:, p], outers[:, p], own = measured(xp, books.entries[p], keep)
                    else:
                        nears[:, p], lows[:, p], outers[:, p], own, need = reassigned(xp, near[:, p], low[:, p], outer[:, p], books.entries[p], books.moved[p], keep)
                        need_of += np.bincount(need, minlength=b + 2)
                    error += own
                    if not last:
                        code = nears[:, p, 0]
                        n_of[p] += np.bincount(code, minlength=k)
                        for j in range(width):
                            sum_of[p, :, j] += np.bincount(code, weights=xp[:, j], minlength=k).astype(np.int64)
                if last:
                    codes = [c.tobytes().hex() for c in np.ascontiguousarray(nears[:, :, 0])]
                    yield pa.RecordBatch.from_arrays([s.column("vec_id"), s.column("label"), pa.array(codes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])
                    continue
                none = pa.nulls(s.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [s.column("vec_id"), s.column("label"), _binary(x.reshape(s.num_rows, -1).astype("<i4")), _binary(nears), _binary(lows), _binary(outers),
                     none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.list_(pa.int64()))], names=STATE)
        if not last:
            used = [(p, e, int(n_of[p, e]), sum_of[p, e].tolist()) for p, e in np.argwhere(n_of).tolist()]
            used += [(-1, z, int(n), None) for z, n in enumerate(need_of.tolist()) if n]
            if used:
                part, entry, n, sums = zip(*used)
                nothing = lambda t: pa.nulls(len(used)).cast(t)
                yield pa.RecordBatch.from_arrays(
                    [nothing(pa.int64()), nothing(label), *[nothing(pa.binary())] * 4, pa.array(part, pa.int32()), pa.array(entry, pa.int32()),
                     pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], names=STATE)

    return run


STATE = ["vec_id", "label", "vector", "near", "low", "outer", "part", "entry", "n", "sums"]


def _state_schema(label: T.DataType) -> T.StructType:
    kinds = [T.LongType(), label, *[T.BinaryType()] * 4, T.IntegerType(), T.IntegerType(), T.LongType(), T.ArrayType(T.LongType())]
    return T.StructType([T.StructField(c, t) for c, t in zip(STATE, kinds)])


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of equal labels summed (nulls together). The sums are broadcast if
    they fit; else only those of labels with very many rows are, and the others meet in a join in which
    no label has many rows."""
    total = coded.groupBy("label").agg(F.sum("error").cast("long").alias("label_error"), F.count(F.lit(1)).alias("rows"))
    total = lazily_once(total, "label-errors").withColumnRenamed("label", "of")
    same = F.col("label").eqNullSafe(F.col("of"))
    if fits_broadcast(total.drop("rows")):
        return coded.join(F.broadcast(total), same).drop("of", "rows")
    many = F.broadcast(total.where(F.col("rows") >= HOT_ROWS))
    hot = coded.join(many, same).drop("of", "rows")
    cold = coded.join(F.broadcast(many.select("of")), same, "left_anti").join(total, same).drop("of", "rows")
    return hot.unionByName(cold)


def vector_codes(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", log: list | None = None,
) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error, codebooks_sha256.

    ``log`` gets (b, parts by number of ranks needed) of each round that used bounds.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark, rows = df.sparkSession, kept_vectors(df, id_col, vec_col, label_col)
    label = rows.schema["label"].dataType
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, t) for c, t in (("vec_id", T.LongType()), ("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType()))]))
    if sizes.size % parts:
        raise ValueError(f"vectors of {sizes.size} components can't be cut into {parts} equal parts")
    rows = rows.where(F.size("vector") == sizes.size)
    start = np.floor(first_rows(rows, entries) * scale).astype(np.int64)
    books = Codebooks(start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy())
    k = len(start)
    b = keep = max(1, min(k, 255, k // 4))
    state, schema, kind = rows, _state_schema(label), to_arrow_type(label)
    for turn in range(rounds + 1):
        last = turn == rounds
        run = _pass(books, kind, b, keep, turn == 0, last, scale)
        out = T.StructType([*schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]) if last else schema
        got = (state if turn == 0 else state.where("part is null")).mapInArrow(run, out)
        before: list[str] = []
        with recorded(before):
            got = lazily_once(got, "codes")
        if turn:
            drop_path(spark, old)  # the round before, which nothing reads any more
        old, state = before[0], got
        if not last:
            sums, counts, need = _sums(state)
            books = books.improved(sums, counts)
            used, b = b, keep
            if turn:
                keep = min(b, adapted(need, used, k))
                if log is not None:
                    log.append((used, need.tolist()))
    return with_label_error(state).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op11_adaptive_bounds_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: 16 parts, 64 entries, 2 rounds."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"d{r} AS MATERIALIZED (SELECT x.r, x.p, c.e, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{r} c ON x.p = c.p AND x.j = c.j GROUP BY ALL),\n"
            f"a{r} AS MATERIALIZED (SELECT r, p, e, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"
        )
        if r < rounds:
            steps.append(
                f"m{r} AS (SELECT x.p, a.e, x.j, sum(x.x)::BIGINT AS s, count(*) AS n FROM x JOIN a{r} a USING (r, p) GROUP BY ALL),\n"
                f"c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, c.j, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x FROM c{r} c LEFT JOIN m{r} m ON c.p = m.p AND c.e = m.e AND c.j = m.j)"
            )
    last = rounds
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda t: t IS NULL OR NOT isfinite(t))) = 0),
u AS (SELECT r, unnest(v) AS t, unnest(range(len(v))) AS i, len(v) // {parts} AS w FROM k),
x AS MATERIALIZED (SELECT r, i // w AS p, i % w AS j, floor(256 * t::DOUBLE)::BIGINT AS x FROM u),
c0 AS MATERIALIZED (SELECT p, r AS e, j, x FROM x WHERE r < {entries}),
{(',' + chr(10)).join(steps)},
s AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM c{last}),
o AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY r)
SELECT k.vec_id, o.code, o.error, (sum(o.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, s.h AS codebooks_sha256
FROM k JOIN o USING (r) CROSS JOIN s
"""


ORACLE_SQL = _sql()
