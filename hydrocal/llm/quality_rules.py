"""Operator 7: quality rules with cross-document line frequency.

Per document (whole text): word, symbol, repeated-line and repeated-window counts, and the base rule on
them. Then, over all documents: lines are normalised (words joined by one space, A-Z lower-cased) and
hashed; a line found in more than ``max_docs`` distinct documents of one host is boilerplate and its
words do not count; a document that keeps fewer than ``min_words`` words or less than ``min_share`` of
them is depleted and rejected.

All expressions are Spark's own; nothing runs in Python. Texts are scanned once, and per document only
its counts and line hashes are written on. Line counts are pre-aggregated, so a line that a third of
all documents share is a few rows per task. Repeated windows are found by sorting a document's window
hashes, all 64 bits of them, with their positions.

Null texts have no words and no lines (and fail the base rule). A null host is a host of its own.
Rows with equal ids are one document when documents of a line are counted, but each gets a row; rows
without an id count one each. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import lazily_once, table

MAX_DOCS, MIN_WORDS, MIN_SHARE = 100, 50, 0.5
WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"  # as written inside a SQL string literal
GAP = "[\\\\x20\\\\x09-\\\\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _step(df: DataFrame, **columns: str) -> DataFrame:
    """Adds columns behind a one-row generator, so that later steps read them instead of computing them again."""
    fields = ", ".join(f"'{k}', {v}" for k, v in columns.items())
    return df.select("*", F.expr(f"inline(array(named_struct({fields})))"))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines (hash, words)."""
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    df = _step(
        df, w=f"regexp_extract_all(t, '{WORD}', 0)",
        l=f"filter(split(t, '\\\\n'), x -> x rlike '{WORD}')",
        word_chars=f"cast(length(t) - regexp_count(t, '{GAP}') as bigint)",
        n_symbols="cast(regexp_count(t, '[#*$%&|<>]') as bigint)",
    ).drop("t")
    normal = f"translate(trim(regexp_replace(x, '{GAP}+', ' ')), '{UPPER}', '{LOWER}')"
    df = _step(
        df, n_words="cast(size(w) as bigint)", n_dup_lines="cast(size(l) - size(array_distinct(l)) as bigint)",
        lines=f"transform(l, x -> named_struct('h', xxhash64({normal}), 'words', regexp_count(x, '{WORD}')))",
        h="if(size(w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))",
    ).drop("w", "l")
    df = _step(df, s="if(size(array_distinct(h)) = size(h), cast(array() as array<struct<x: bigint, i: int>>), sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i))))").drop("h")
    again = "(j > 0 and s[j].x = s[j - 1].x) or (j < size(s) - 1 and s[j].x = s[j + 1].x)"
    places = f"transform(filter(sequence(0, size(s) - 1), j -> {again}), j -> s[j].i)"
    repeat = f"if(size(s) = 0, 0L, cast(size(array_distinct(flatten(transform({places}, p -> array(p, p + 1, p + 2))))) as bigint))"
    df = _step(df, n_repeat_words=repeat).drop("s")
    return df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def quality_rules(
    docs: DataFrame, max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE,
    id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """doc_id, the counts of ``base_counts``, base_failed, kept, n_kept_words (outside boilerplate lines)."""
    base = base_counts(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id())
    base = lazily_once(base, "quality")  # written once, so that row numbers stay
    document = F.coalesce("doc_id", -1 - F.col("row"))
    seen = base.select("host", document.alias("d"), F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    common = seen.groupBy("host", "h").agg(F.count_distinct("d").alias("docs")).where(F.col("docs") > max_docs)
    lines = base.select("row", "host", F.inline("lines"))
    hit = (F.col("l.h") == F.col("c.h")) & F.col("l.host").eqNullSafe(F.col("c.host"))
    gone = lines.alias("l").join(common.alias("c"), hit).groupBy("row").agg(F.sum("words").cast("long").alias("gone"))
    out = base.drop("lines").join(gone, "row", "left").withColumn("n_kept_words", F.col("n_words") - F.coalesce("gone", F.lit(0)))
    depleted = (F.col("n_kept_words") < min_words) | (F.col("n_kept_words") < min_share * F.col("n_words"))
    out = out.withColumn("kept", ~F.col("base_failed") & ~depleted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words")


def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the host of a document is its source."""
    return quality_rules(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, {_WORDS.format('t')} AS ws FROM d),
tri AS (SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(3) x(k) GROUP BY r),
ln AS (SELECT r, source, doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
good AS (SELECT r, source, coalesce(doc_id::VARCHAR, 'row' || r) AS doc, line, len({_WORDS.format('line')}) AS words,
  translate(array_to_string({_WORDS.format('line')}, ' '), '{UPPER}', '{LOWER}') AS norm
  FROM ln WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM good GROUP BY r),
common AS (SELECT source, norm FROM good GROUP BY ALL HAVING count(DISTINCT doc) > {MAX_DOCS}),
gone AS (SELECT r, sum(words)::BIGINT AS n FROM good JOIN common ON good.norm = common.norm AND good.source IS NOT DISTINCT FROM common.source GROUP BY r),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
  (len(ws) - coalesce(gone.n, 0))::BIGINT AS n_kept_words
  FROM d JOIN w USING (r) LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT * EXCLUDE (n_kept_words), (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_kept_words >= {MIN_WORDS} AND n_kept_words >= {MIN_SHARE} * n_words AS kept, n_kept_words
FROM m
"""
