"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changewatch.llm.common import gathered, scratch, written


def summed(edges: DataFrame) -> tuple:
    """How many links there are and a sum that tells whether they have changed."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that each node with a link can reach. Links are pairs in any order, loops allowed.

    Rounds of large and small stars: every node hands its larger neighbours, then its smaller ones, to the smallest node that
    it knows, until nothing changes. A round is two counts of minima with map-side combining and two joins with both
    sides straight from tables, so that a node with very many links can be split; each round is written to the
    shared folder, so that lineage stays short. Rounds grow with the logarithm of the longest chain."""
    larger, smaller = F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    edges = written(links.select(larger, smaller).where("a <> b").distinct(), "edges")
    state, seen = summed(edges), None
    while True:
        n = 2 * state[0]  # rows at most, about: links in both directions

        def kept(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
            return written(gathered(df, n), name, keep)

        with scratch(links.sparkSession):
            both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
            least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
            large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            large = kept(large.distinct(), "large")
            least = kept(large.groupBy("a").agg(F.min("b").alias("m")), "least")
            small = large.join(least, "a").select(F.explode(F.array(
                F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            edges = kept(small.select("e.a", "e.b").where("a <> b").distinct(), "edges", keep=True)
        seen, state = state, summed(edges)
        if state == seen:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct())
