"""A training corpus from the documents table, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet
to the shared folder and rereads it as the next stage's docs. All but the last return the columns of
documents.

A stage's result is lazy, so its scratch tables must outlive the call. As a stage's result is written
before the next stage begins, each stage first drops the scratch of the stages before it, but for what
its own ``docs`` read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import drop_path, lazily_once, recorded, table
from hydrocal.llm.minhash_dedup import without_near_duplicates
from hydrocal.llm.mixing import mixture
from hydrocal.llm.packing import packed
from hydrocal.llm.pu_quality import scored
from hydrocal.llm.substring_dedup import substring_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    out = scored(docs, table(spark, sf_dir, "labels"), carry=docs.columns)
    return out.where("predicted = 1").select(*[F.col(f"`carry_{c}`").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows. A changed text has its words joined by
    one space and a new n_chars; a document that loses all of its words goes."""
    out = substring_dedup(docs, carry=docs.columns)
    out = out.where("n_removed = 0 or n_removed < n_words")
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("kept")}
    return out.select(*[F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"`carry_{c}`")).alias(c) if c in changed else F.col(f"`carry_{c}`").alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    out = mixture(docs, carry=docs.columns).where("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*[F.col(f"`carry_{c}`").alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed into sequences of 2048 tokens."""
    return packed(docs)


_SCRATCH: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, which drops the scratch of earlier ones when it begins and records its own. Columns whose
    names hold a dot or backtick, which Spark's Arrow functions can't take in, have plain names inside."""

    @wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {f.rpartition("/")[0] for f in docs.inputFiles()}
        for path in [p for p in _SCRATCH if not any(r.endswith(p.rpartition("/")[2]) for r in read)]:
            drop_path(spark, path)
            _SCRATCH.remove(path)
        names = docs.columns
        plain = [c if c.isidentifier() else f"column_{i}_" for i, c in enumerate(names)]
        with recorded(_SCRATCH):
            out = stage(spark, docs.toDF(*plain), sf_dir)
        return out.toDF(*names) if out.columns == plain else out

    return call


STAGES = [
    ("quality_classifier", _tidy(quality_classifier)),
    ("near_dedup", _tidy(near_dedup)),
    ("substring_dedup", _tidy(repeated_passages)),
    ("source_mixing", _tidy(source_mixing)),
    ("best_fit_packing", _tidy(best_fit_packing)),
]

#: The stages use a trained classifier, a tokenizer and sketches, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        with recorded(_SCRATCH if name != STAGES[-1][0] else []):
            docs = lazily_once(result, name)
    return docs
