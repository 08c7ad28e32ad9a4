"""Operator 8: quality classifier by positive-unlabelled learning.

A small network scores documents from counts of their text (no labels, ids, languages or sources). It
is trained to least non-negative unbiased risk: with class prior p, loss l, trusted positives P and
unlabelled web text U, the risk is p * E_P[l(+)] + max(0, E_U[l(-)] - p * E_P[l(-)]); where the second
term falls below zero its gradient is reversed. Positives are labelled 1 outside the held-out fold;
U are documents of that side of the fold, labelled or not, whose labels are not used. The prior is
estimated as the share of label 1 among the labelled rows outside the held-out fold.

Training uses bounded samples: the ``SAMPLE`` positives and ``SAMPLE`` unlabelled documents that come
first by a hash of their id (parameters); they are all the driver ever holds. Features of all documents
are computed in one pass and written to the shared folder; scoring reads them back.

Null and empty texts have all counts zero and a score like any other. A document with contradicting or
null labels counts as unlabelled. Without any positive, or without documents, every score is the
estimated prior (0.5 without labels). Repeated rows each get a row. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import hashed_sample, lazily_once, slices, table

SAMPLE, EPOCHS, BATCH, HIDDEN, SEED = 20_000, 60, 512, 24, 7
THRESHOLD, FOLDS = 0.3, 5
PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]


def features(texts: list[bytes | None]) -> np.ndarray:
    """float32[n, FEATURES] of UTF-8 texts: scale-free counts, squashed to a few units."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, x in zip(out, texts):
        words = x.split() if x else []
        if not words:
            continue
        n = len(words)
        c = np.bincount(np.frombuffer(x, np.uint8), minlength=256)
        letters = int(c[65:91].sum() + c[97:123].sum())
        high = int(c[192:].sum())  # characters beyond ASCII
        chars = letters + high + int(c[48:58].sum()) + int(c[PUNCTUATION].sum())
        lines = [y for y in x.split(b"\n") if y.strip()]
        row[:13] = (
            np.log1p(n) / 4, min(chars / n, 40) / 6, letters / chars if chars else 0, high / chars if chars else 0,
            c[65:91].sum() / max(1, letters), c[48:58].sum() / max(1, chars), len(set(words)) / n, len(set(lines)) / len(lines),
            np.log1p(n / len(lines)) / 3, np.sqrt(c[PUNCTUATION].sum() / max(1, chars)),
            np.sqrt(sum(w.isalpha() for w in words) / n),
            np.sqrt(sum(len(w) == 1 for w in words) / n), np.sqrt(sum(w.isupper() for w in words) / n),
        )
        row[13:] = np.sqrt(c[PUNCTUATION] / n)
    return out


FEATURES = 13 + len(PUNCTUATION)


class Network:
    """One hidden layer; logistic loss; Adam."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, prior: float):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale, self.prior = mean, scale, prior
        self.w = [rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.m = [[np.zeros_like(w), np.zeros_like(w)] for w in self.w]
        self.t = 0

    def margin(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ self.w[0] + self.w[1])
        return h, h @ self.w[2] + self.w[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x.astype(np.float64))[1], -30, 30)))

    def step(self, pos: np.ndarray, unl: np.ndarray, rate: float) -> None:
        """One step on the non-negative risk."""
        x = np.concatenate([pos, unl])
        h, g = self.margin(x)
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        k, soft = len(pos), np.logaddexp(0, g)  # soft: the loss of calling a row positive when it is not
        negative = soft[k:].mean() - self.prior * soft[:k].mean()
        d_plus = np.concatenate([self.prior * (s[:k] - 1) / k, np.zeros(len(unl))])
        d_minus = np.concatenate([-self.prior * s[:k] / k, s[k:] / len(unl)])
        d = d_plus + d_minus if negative >= 0 else -d_minus
        dh = np.outer(d, self.w[2]) * (1 - h * h)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        grads = [z.T @ dh, dh.sum(axis=0), h.T @ d, np.array([d.sum()])]
        self.t += 1
        for w, (m, v), grad in zip(self.w, self.m, grads):
            grad = grad + 1e-4 * w
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad * grad
            w -= rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def train(pos: np.ndarray, unl: np.ndarray, prior: float) -> Network:
    rng = np.random.default_rng(SEED)
    both = np.concatenate([pos, unl]).astype(np.float64)
    pos, unl = pos.astype(np.float64), unl.astype(np.float64)
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-2, prior)
    steps = max(300, EPOCHS * -(-len(unl) // BATCH))
    steps = min(steps, 3000)
    for i in range(steps):
        p = pos[rng.integers(0, len(pos), min(BATCH, len(pos)))]
        u = unl[rng.integers(0, len(unl), min(BATCH, len(unl)))]
        net.step(p, u, 0.01 * (1 - i / steps) + 1e-4)
    return net


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, carry: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, and ``carry``'s columns as carry_<name>."""
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"), *[F.col(f"`{c}`").alias(f"carry_{c}") for c in carry or []])

    def compute(batches):
        for b in slices(batches):
            x = features([t.as_py() for t in b.column("text").cast(pa.binary())])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float32()))
            yield b.drop_columns(["text"]).append_column("x", flat)

    f = lazily_once(rows.mapInArrow(compute, rows.drop("text").withColumn("x", F.array().cast("array<float>")).schema), "features")
    lab = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi")
    lab = lab.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0).select("doc_id", F.col("hi").alias("quality"))
    seen = lab.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    prior = min(0.99, max(0.01, seen)) if seen is not None else 0.5

    def first(df: DataFrame) -> np.ndarray:
        got = hashed_sample(df, "doc_id", sample).select("x").toPandas()["x"]
        return np.stack(got.to_list()) if len(got) else np.zeros((0, FEATURES), np.float32)

    side = f.where("not held_out").select("doc_id", "x")
    pos, unl = first(side.join(lab.where("quality = 1").select("doc_id"), "doc_id", "left_semi")), first(side)
    net = train(pos, unl, prior) if len(pos) else None

    def score(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            s = net.score(x) if net else np.full(len(x), prior)
            yield b.drop_columns(["x"]).append_column("score", pa.array(s, pa.float64()))

    out = f.mapInArrow(score, f.drop("x").withColumn("score", F.lit(0.0)).schema)
    out = out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    return out.select("doc_id", "held_out", "score", "predicted", *[f"`carry_{c}`" for c in carry or []])


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
