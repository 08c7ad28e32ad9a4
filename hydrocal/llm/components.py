"""Connected components of a link table, for the near-duplicate operators.

Union-find in alternating large-star and small-star rounds: every round hooks each node's neighbours
to the smallest node among them, so trees flatten to stars in about log(n) rounds. Minima are
pre-aggregated before the shuffle, so a node with a third of all links costs one row per task; the
join that hands the minimum back is an ordinary equi-join, which AQE splits at hot nodes. Each round
is written to the shared folder, which cuts the lineage. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrocal.llm.common import lazily_once


def components(links: DataFrame) -> DataFrame:
    """links: a, b (longs). Returns node, root: the smallest node reachable, for nodes with a link.

    Links may repeat and come in either direction; those with a null end or to itself are ignored.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = lazily_once(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(high.alias("u"), low.alias("v")).distinct(), "links",
    )
    before = None
    while True:
        # Large star: neighbours above a node hook to the least of the node and all its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its neighbours below hook to the least of those.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = lazily_once(small, "stars")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == before:
            break
        before = (state.n, state.h)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
