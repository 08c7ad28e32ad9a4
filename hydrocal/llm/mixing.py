"""Operator 4: mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, ordered by code point with null last, get the weights of a repeating cycle and share a
budget of ``factor`` times all words. No source's target exceeds ``most`` times its size; what that
leaves is shared among the others by weight: a target is min(most * size, level * weight), with the
one level at which the targets use up the budget.

A target becomes complete epochs (every document once each) and a rest. For the rest each document
draws ``u ** (1 / w)`` with a uniform ``u`` from an MD5 of seed and id (so reruns agree) and its quality
weight ``w``; documents are taken by decreasing key while that brings the sum nearer to the rest.

The sums run over ``BINS`` equal stretches of the key first: sizes are pre-aggregated by (source, bin),
prefix-summed over at most ``BINS`` rows a source, and only the one bin in which a source's rest ends
is sorted document by document, which gives one last document per source; every row then decides for
itself. A source with a third of all documents is thus no hot group.

Null texts have size 0; documents of size 0 are returned with taken 0. Rows with equal ids draw equal
keys and are ordered by size. Null ids draw by their text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hydrocal.llm.common import lazily_once, n_words, table

CYCLE = (3, 1, 2)
FACTOR, MOST, SEED, BINS = 1.5, 2, "mix-1", 4096


def targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, factor: float = FACTOR, most: int = MOST) -> DataFrame:
    """sizes: source, source_size (one row a source). Adds target."""
    everything = W.partitionBy()  # one short row per source
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(cycle))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = W.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    capped, light = F.coalesce(F.sum("cap").over(upto), F.lit(0)), F.coalesce(F.sum("weight").over(upto), F.lit(0))
    level = (factor * F.sum("source_size").over(everything) - capped) / (F.sum("weight").over(everything) - light)
    s = s.withColumn("level", level)
    s = s.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def mixture(
    docs: DataFrame, weight: Column | None = None, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    cycle: tuple[int, ...] = CYCLE, factor: float = FACTOR, most: int = MOST, carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, copies, and ``carry``'s columns as carry_<name>."""
    size = n_words(F.col(text_col))
    if weight is None:  # a cheap quality weight: mean length of a word with its gap, against 6
        weight = F.when(size > 0, F.greatest(F.lit(0.25), F.least(F.lit(4.0), F.length(text_col) / (6.0 * size)))).otherwise(1.0)
    drawn = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null"), F.coalesce(F.col(text_col), F.lit(""))))
    x = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), drawn)), 1, 12), 16, 10).cast("double")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
        (F.log((x + 0.5) / float(1 << 48)) / weight).alias("key"), F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"carry_{c}") for c in carry or []],
    )
    rows = lazily_once(rows, "sized")  # written once, so that row numbers stay
    narrow = rows.select("source", "size", "key", "row", F.floor(F.exp("key") * BINS).cast("int").alias("bin"))
    plan = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, factor, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = lazily_once(plan, "targets")

    def with_plan(df: DataFrame, plan: DataFrame) -> DataFrame:
        return df.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    # The bin in which a source's rest ends, and in that bin alone the last document taken.
    down = W.partitionBy("source").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = narrow.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
    bins = with_plan(bins.withColumn("before", F.coalesce(F.sum("in_bin").over(down), F.lit(0))), plan.select("source", "rest"))
    ends = bins.where("before < rest and before + in_bin >= rest").select(F.col("source").alias("of"), F.col("bin").alias("end"), "before", "rest")
    edge = narrow.join(ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("bin") == F.col("end")))
    order = W.partitionBy("source").orderBy(F.desc("key"), "size", "row").rowsBetween(W.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = edge.withColumn("taken", ahead + F.col("size") / 2.0 < F.col("rest"))
    last = F.max(F.when(F.col("taken"), F.struct(-F.col("key"), "size", "row")))
    cut = edge.groupBy("source", "end").agg(last.alias("last")).select(F.col("source").alias("of"), "end", "last")
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    both = with_plan(rows, lazily_once(plan, "cuts"))
    above = F.floor(F.exp("key") * BINS) > F.col("end")
    in_edge = F.coalesce((F.floor(F.exp("key") * BINS) == F.col("end")) & (F.struct(-F.col("key"), "size", "row") <= F.col("last")), F.lit(False))
    more = F.when((F.col("rest") > 0) & (above | in_edge), 1).otherwise(0)
    out = both.withColumn("copies", F.col("epochs") + more)
    return out.select("doc_id", "size", "source", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *[F.col(f"carry_{c}").alias(f"carry_{c}") for c in carry or []])


def op4_weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, size, source_size, target, taken."""
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'null' || coalesce(text, '')) AS drawn, coalesce(length(text), 0) AS chars, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), k AS (
  SELECT *, ln((('0x' || substr(md5('{SEED}:' || drawn), 1, 12))::BIGINT + 0.5::DOUBLE) / {1 << 48}::DOUBLE)
    / (CASE WHEN size > 0 THEN greatest(0.25::DOUBLE, least(4::DOUBLE, chars / (6::DOUBLE * size))) ELSE 1::DOUBLE END) AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source
), v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS lv,
    2 * source_size / weight::DOUBLE AS ratio
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(2::DOUBLE * source_size, weight * (SELECT arg_min(lv, ratio) FROM v WHERE lv <= ratio)) AS target FROM v
), e AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
), p AS (
  SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key DESC, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN ahead + size / 2::DOUBLE < rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""
