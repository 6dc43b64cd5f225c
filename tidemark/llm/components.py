"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.tables import materialized


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    edges: columns a, b. Alternates two star steps (Kiveris et al. 2014): each
    node hands its larger neighbours, then all its neighbours, to the smallest
    one. Rounds are written to the shared folder, so a lost executor costs one
    round. Minima are summed up before the shuffle; the join that hands them out meets
    all edges of a hub under its key, which is left to Spark's splitting of skewed joins.
    """
    stars = materialized(_oriented(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "stars")
    before = None
    while (now := _digest(stars)) != before:
        before = now
        stars = materialized(_small_star(_large_star(stars)), "stars")
    roots = stars.select(F.col("v").alias("node")).distinct().join(stars.select(F.col("u").alias("node")), "node", "left_anti")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _oriented(pairs: DataFrame) -> DataFrame:
    """Each edge once, from its larger node u to its smaller node v."""
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(stars: DataFrame) -> DataFrame:
    least = stars.groupBy("u").agg(F.min("v").alias("m"))
    handed = stars.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(handed.union(least.select("u", F.col("m").alias("v"))))
