"""The pipeline: contracts of its stages on real and odd inputs, and reruns."""

from collections import Counter

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import DOCS, SF, texts


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.lazily_once(stage(spark, docs, SF), "test")
        before, rows = rows, out.collect()
        assert rows
        if name != "best_fit_packing":
            assert out.columns == columns
        if name == "near_dedup":
            pairs = [(r.doc_id, r.text) for r in before]
            expected = {i for i, n, c, kept in brute.near_duplicates(pairs, 5) if kept}
            assert {r.doc_id for r in rows} == expected
        if name == "substring_dedup":
            gone = {i: (n, g) for i, n, g, _ in brute.without_repeats([(r.doc_id, r.text) for r in before], 35)}
            assert {r.doc_id: len(r.text.split()) for r in rows} == {i: n - g for i, (n, g) in gone.items() if not g or g < n}
        if name == "source_mixing":
            copies = Counter(r.doc_id for r in rows)
            assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 2
        docs = out
    assert {r.doc_id for r in rows} == set(copies)


def test_run_agrees_with_itself(spark):
    a, b = (corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect() for _ in range(2))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "en", None, None, n, "x") for n, (i, t) in enumerate(texts())], DOCS)
    for start in (docs, docs.limit(0)):
        here = corpus_pipeline.lazily_once(start, "odd")
        for name, stage in corpus_pipeline.STAGES[1:]:
            here = corpus_pipeline.lazily_once(stage(spark, here, SF), "odd")
        assert (here.count() > 0) == (start is docs)


def test_all_stages_on_odd_rows_and_column_names(spark):
    """The classifier too; a column with a dot and one named like an inner column pass through all stages."""
    rows = [(i, t, "en", None, None, n, "x", n, "y") for n, (i, t) in enumerate(texts())]
    docs = spark.createDataFrame(rows, DOCS + ", `a.b` long, kept string")
    for start in (docs, docs.limit(0)):
        first = corpus_pipeline.lazily_once(corpus_pipeline.STAGES[0][1](spark, start, SF), "odd")
        assert first.columns == docs.columns and first.count() <= start.count()
        here = corpus_pipeline.lazily_once(start, "odd")
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = corpus_pipeline.lazily_once(stage(spark, here, SF), "odd")
            assert name == "best_fit_packing" or out.columns == docs.columns
            here = out
        assert (here.count() > 0) == (start is docs)
