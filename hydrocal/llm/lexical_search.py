"""Operator 12: ranked lexical search with MaxScore and pair bounds.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, only A-Z lower-cased. A
document's score is a whole number, a sum of term impacts (weights and saturation as in ``Statistics``).

The index is a written table of blocks of documents, made in two passes:

1. one scan of the texts counts all terms and stores, per block, the postings of the terms that some
   query holds; corpus statistics come out of the same pass, one row per task;
2. with the statistics known, each block gets impacts, each term's largest impact in the block, and for
   pairs of the commonest terms the list of documents that hold both, with the largest joint impact.
   The same pass gives, per term and pair, the k-th highest impact of a task: k documents reach it, so it
   is a floor under the k-th score of every query with that term or pair.

A query takes a block's terms in ascending order of their largest impacts. Two terms of a stored pair
count together at most the larger of both maxima and their joint maximum, which is less than the sum
unless some document holds both at their best; disjoint pairs are chosen by what they save. The longest
run of terms whose bound stays below the k-th score so far is not essential: only documents of the other
terms are scored, and they are dropped as soon as their score plus the bound of what is left (for
documents outside a pair's list, that of the better term alone) falls short. A block whose whole bound
falls short is not looked into. Bounds skip only what is strictly below, so results equal those of
scoring everything.

Queries are taken in groups of about ``GROUP`` items, whose terms go to the tasks; each group makes an index
of its own terms. No other side is broadcast. Each task hands on its best k rows per query.

Null and empty texts have no terms; documents without terms are no documents for N, and items without
terms, or that match nothing, have no result rows. Rows of equal item ids are one item with all their
terms; items without id are one item. Each document row is a document, also if ids repeat; of equal scores
and ids the rows are alike. Documents without id come after the others at equal scores. Empty tables give
no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrocal.llm.common import lazily_once, slices, table

TOP = 50
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 21
PAIR_TERMS = 48  # commonest query terms of which pairs get lists
GROUP = 4000  # items whose terms are held by a task
PIECE = 8 << 20  # bytes of a long text that are cut into terms at once
NO_ID = (1 << 63) - 1

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in lists, cut only between terms."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and _LOWER[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_LOWER).split()
        at = end


@dataclass
class Statistics:
    """N documents with a term, L terms in all, and df by term number."""

    docs: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * d + 1))) for d in self.df.tolist()], np.int64)

    def norms(self, n: np.ndarray) -> np.ndarray:
        """m of documents of n terms; exact also where 50 * n * N leaves 64 bits."""
        if int(n.max(initial=0)) * 50 * max(1, self.docs) < 1 << 62:
            return 50 + 50 * n.astype(np.int64) * self.docs // max(1, self.length)
        return np.array([50 + 50 * x * self.docs // self.length for x in n.tolist()], np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * norm))


BLOCKS = "ids binary, sizes binary, starts binary, docs binary, tfs binary, n_docs long, n_terms long, term int, df long"
_BLOCKS = pa.schema([*[(c, pa.binary()) for c in ("ids", "sizes", "starts", "docs", "tfs")], ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("term", pa.int32()), ("df", pa.int64())])


def counted(vocabulary: dict[bytes, int]):
    """Arrow function: documents (doc_id, text) to blocks of postings, and at its end a task's statistics."""
    v = len(vocabulary)

    def run(batches):
        df, n_docs, n_terms = np.zeros(v, np.int64), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        docs = posts = 0

        def block():
            nonlocal held, docs, posts
            ids, sizes, at, term, tf = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(term, kind="stable")
            starts = np.searchsorted(term[order], np.arange(v + 1)).astype("<i4")
            held, docs, posts = [], 0, 0
            return pa.RecordBatch.from_pylist([{
                "ids": ids.astype("<i8").tobytes(), "sizes": sizes.astype("<i8").tobytes(), "starts": starts.tobytes(),
                "docs": at[order].astype("<i4").tobytes(), "tfs": tf[order].astype("<i4").tobytes()}], schema=_BLOCKS)

        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            words, sizes = [], []
            for t in texts:
                n = 0
                for part in terms(t or b""):
                    n += len(part)
                    words.append(np.fromiter(map(vocabulary.get, part, repeat(-1)), np.int32, len(part)))
                sizes.append(n)
            sizes = np.array(sizes, np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            term = np.concatenate(words) if words else np.zeros(0, np.int32)
            n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + int(sizes.sum())
            known = term >= 0
            pair, tf = np.unique(doc[known] * v + term[known], return_counts=True)
            doc, term = pair // max(1, v), pair % max(1, v)
            df += np.bincount(term, minlength=v)[:v]
            has, doc = np.unique(doc, return_inverse=True)
            if not len(has):
                continue
            ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy()[has]
            held.append((ids, sizes[has], doc + docs, term, tf))
            docs, posts = docs + len(has), posts + len(term)
            if docs >= BLOCK_DOCS or posts >= BLOCK_POSTINGS:
                yield block()
        if held:
            yield block()
        rows = [{"n_docs": n_docs, "n_terms": n_terms}, *({"term": t, "df": int(df[t])} for t in np.flatnonzero(df).tolist())]
        yield pa.RecordBatch.from_pylist(rows, schema=_BLOCKS)

    return run


INDEX = "ids binary, starts binary, docs binary, impacts binary, best binary, pairs array<struct<a: int, b: int, joint: long, docs: binary>>, a int, b int, floor long"
_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("joint", pa.int64()), ("docs", pa.binary())])
_INDEX = pa.schema([*[(c, pa.binary()) for c in ("ids", "starts", "docs", "impacts", "best")], ("pairs", pa.list_(_PAIR)), ("a", pa.int32()), ("b", pa.int32()), ("floor", pa.int64())])


def highest(held: np.ndarray, more: np.ndarray, k: int) -> np.ndarray:
    """The k highest of both, in no order."""
    both = np.concatenate([held, more])
    return both if len(both) <= k else np.partition(both, len(both) - k)[len(both) - k :]


def indexed(stats: Statistics, pairs: list[tuple[int, int]], k: int):
    """Arrow function: blocks to blocks with impacts, maxima and pair lists, and at its end floors."""
    weight = stats.weights()
    by_first: dict[int, list[int]] = {}
    for a, b in pairs:
        by_first.setdefault(a, []).append(b)

    def run(batches):
        tops: dict[tuple[int, int], np.ndarray] = {}
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                starts, docs = np.frombuffer(r["starts"], "<i4").astype(np.int64), np.frombuffer(r["docs"], "<i4").astype(np.int64)
                size, tf = np.frombuffer(r["sizes"], "<i8"), np.frombuffer(r["tfs"], "<i4").astype(np.int64)
                term = np.repeat(np.arange(len(weight)), np.diff(starts))
                score = impacts(weight[term], tf, stats.norms(size)[docs])
                best = np.zeros(len(weight), np.int64)
                used = np.flatnonzero(np.diff(starts))
                if len(used):
                    best[used] = np.maximum.reduceat(score, starts[used])
                lists, place = [], np.full(len(size), -1, np.int64)
                for a, others in by_first.items():
                    own = docs[starts[a] : starts[a + 1]]
                    if not len(own):
                        continue
                    place[own] = np.arange(starts[a], starts[a + 1])
                    for b in others:
                        theirs = docs[starts[b] : starts[b + 1]]
                        at = place[theirs]
                        both = at >= 0
                        joint = score[at[both]] + score[starts[b] : starts[b + 1]][both]
                        lists.append({"a": a, "b": b, "joint": int(joint.max(initial=0)), "docs": theirs[both].astype("<i4").tobytes()})
                        tops[a, b] = highest(tops.get((a, b), nothing), joint, k)
                    place[own] = -1
                for t in used.tolist():
                    tops[t, t] = highest(tops.get((t, t), nothing), score[starts[t] : starts[t + 1]], k)
                yield pa.RecordBatch.from_pylist([{
                    "ids": r["ids"], "starts": r["starts"], "docs": r["docs"], "impacts": score.astype("<i8").tobytes(),
                    "best": best.astype("<i8").tobytes(), "pairs": lists}], schema=_INDEX)
        floors = [{"a": a, "b": b, "floor": int(x.min())} for (a, b), x in tops.items() if len(x) == k and x.min() > 0]
        if floors:
            yield pa.RecordBatch.from_pylist(floors, schema=_INDEX)

    return run


class Block:
    """One block of the index, and the search in it."""

    def __init__(self, row: dict):
        number = lambda c, kind: np.frombuffer(row[c], kind)
        self.ids, self.starts = number("ids", "<i8"), number("starts", "<i4")
        self.docs, self.impacts, self.best = number("docs", "<i4"), number("impacts", "<i8"), number("best", "<i8")
        self.pairs = {(p["a"], p["b"]): (p["joint"], np.frombuffer(p["docs"], "<i4")) for p in row["pairs"] or []}

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[t], self.starts[t + 1]
        return self.docs[a:b], self.impacts[a:b]

    def matched(self, query: list[int]) -> dict[int, tuple[int, int]]:
        """Disjoint pairs of the query's terms, those that save most first: term to (other term, bound)."""
        saves = []
        for a, b in combinations(sorted(query), 2):
            if (a, b) in self.pairs:
                both = max(int(self.best[a]), int(self.best[b]), self.pairs[a, b][0])
                if (saved := int(self.best[a] + self.best[b]) - both) > 0:
                    saves.append((saved, a, b, both))
        out: dict[int, tuple[int, int]] = {}
        for _, a, b, both in sorted(saves, reverse=True):
            if a not in out and b not in out:
                out[a], out[b] = (b, both), (a, both)
        return out

    def search(self, query: np.ndarray, floor: int, use_pairs: bool = True, seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of at least ``floor`` (1 or more), by place in the block; none of those is
        missing. ``seen`` gets the number of postings read."""
        order = query[self.best[query] > 0]
        order = order[np.argsort(self.best[order], kind="stable")].tolist()
        mates = self.matched(order) if use_pairs else {}
        bound, bounds, inside = 0, [0], set()  # bounds[i]: of the first i terms
        for t in order:
            mate, both = mates.get(t, (None, 0))
            bound += both - int(self.best[mate]) if mate in inside else int(self.best[t])
            inside.add(t)
            bounds.append(bound)
        none = np.zeros(0, np.int64)
        if bound < floor:
            return none, none
        rest = sum(b < floor for b in bounds) - 1  # bounds ascend
        score = np.zeros(len(self.ids), np.int64)
        read = 0
        for t in order[rest:]:
            d, x = self.postings(t)
            score[d] += x
            read += len(d)
        docs = np.flatnonzero(score >= max(1, floor - bounds[rest]))
        score = score[docs]
        low = set(order[:rest])
        spare = np.zeros(len(docs), np.int64)  # by how much a document outside pair lists stays below the bound
        for t in low:
            mate, both = mates.get(t, (None, 0))
            if mate in low and t < mate and both > (alone := max(int(self.best[t]), int(self.best[mate]))):
                listed = self.pairs[t, mate][1]
                at = np.minimum(np.searchsorted(listed, docs), max(0, len(listed) - 1))
                spare += (both - alone) * (listed[at] != docs if len(listed) else np.ones(len(docs), bool))
        live = score + bounds[rest] - spare >= floor
        docs, score = docs[live], score[live]
        for i in range(rest - 1, -1, -1):
            if not len(docs):
                break
            d, x = self.postings(order[i])
            if len(d):
                at = np.minimum(np.searchsorted(d, docs), len(d) - 1)
                score = score + np.where(d[at] == docs, x[at], 0)
                read += min(len(d), len(docs))
            live = score + bounds[i] >= floor
            docs, score = docs[live], score[live]
        if seen is not None:
            seen.append(read)
        return docs, score


def best_of(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best rows: by score from the highest, then by id."""
    if len(ids) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        ids, score = ids[score >= least], score[score >= least]
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def searched(queries: list[np.ndarray], floors: list[int], k: int):
    """Arrow function: blocks of the index to a task's best k rows of each query."""

    def run(batches):
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0])
                for q, query in enumerate(queries):
                    ids, score = best[q]
                    floor = max(floors[q], int(score[-1]) if len(score) == k else 1)
                    docs, more = block.search(query, floor)
                    if len(docs):
                        best[q] = best_of(np.concatenate([ids, block.ids[docs]]), np.concatenate([score, more]), k)
        for q, (ids, score) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int32)), pa.array(ids), pa.array(score)], names=["q", "doc_id", "score"])

    return run


def _group(docs: DataFrame, items: list, k: int) -> DataFrame:
    """q (place in ``items``), doc_id, score: the best rows of the tasks, of one group of items."""
    vocabulary: dict[bytes, int] = {}
    queries = [np.array(sorted({vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms}), np.int64) for r in items]
    blocks = lazily_once(docs.mapInArrow(counted(vocabulary), BLOCKS), "blocks")
    total = blocks.where("n_docs is not null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in blocks.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect():  # the group's terms
        df[r.term] = r.df
    stats = Statistics(int(total.n or 0), int(total.l or 0), df)
    common = set(np.argsort(-df, kind="stable")[:PAIR_TERMS].tolist())
    pairs = sorted({p for q in queries for p in combinations([t for t in q.tolist() if t in common], 2)})
    index = lazily_once(blocks.where("ids is not null").select("ids", "sizes", "starts", "docs", "tfs").mapInArrow(indexed(stats, pairs, k), INDEX), "index")
    floor = {(r.a, r.b): r.floor for r in index.where("floor is not null").groupBy("a", "b").agg(F.max("floor").alias("floor")).collect()}
    floors = []
    for q in queries:
        near = [t for t in q.tolist() if t in common]
        floors.append(max([1, *(floor.get((t, t), 0) for t in q.tolist()), *(floor.get(p, 0) for p in combinations(near, 2))]))
    return index.where("ids is not null").drop("a", "b", "floor").mapInArrow(searched(queries, floors, k), "q int, doc_id long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", group: int = GROUP,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def cut(batches):
        for b in slices(batches):
            found = [sorted({t for part in terms(x or b"") for t in part}) for x in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "found"])

    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    asked = asked.mapInArrow(cut, "item_id long, found array<binary>")
    asked = asked.select("item_id", F.explode("found").alias("t")).groupBy("item_id").agg(F.collect_set("t").alias("terms"))
    asked = lazily_once(asked, "items")
    groups = max(1, -(-asked.count() // group))
    out = None
    for g in range(groups):
        # about ``group`` items at a time: all that the driver and the tasks hold of the queries
        part = sorted(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect(), key=lambda r: (r.item_id is None, r.item_id))
        if not part:
            continue
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(part)], "q int, item_id long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
        best = _group(docs, part, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = best.join(F.broadcast(names), "q").select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
        best = lazily_once(best, "ranked") if groups > 1 else best
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out


def op12_pair_bound_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, ranked for each benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS ts FROM documents WHERE text IS NOT NULL),
n AS MATERIALIZED (SELECT r, doc_id, len(ts)::BIGINT AS n, ts FROM d WHERE len(ts) > 0),
g AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
q AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS t FROM benchmark WHERE text IS NOT NULL),
p AS MATERIALIZED (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM n) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY t, nn),
i AS MATERIALIZED (SELECT p.r, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n.n * nn) // ll))) AS x
  FROM p JOIN w USING (t) JOIN n ON p.r = n.r CROSS JOIN g),
s AS (SELECT q.item_id, i.r, sum(i.x)::BIGINT AS score FROM q JOIN i USING (t) GROUP BY ALL HAVING sum(i.x) > 0)
SELECT item_id, (row_number() OVER o)::INTEGER AS rank, doc_id, score FROM s JOIN n ON s.r = n.r
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY rank <= {TOP}
"""
