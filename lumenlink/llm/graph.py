"""Connected components over a table of links, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least node among itself and its neighbours."""
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def _is_stars(e: DataFrame) -> bool:
    """Does every node that has a link have one only, to a node that has none?"""
    ends = e.select("a", F.lit(1).alias("links"), F.lit(0).alias("root")).unionByName(e.select(F.col("b").alias("a"), F.lit(0).alias("links"), F.lit(1).alias("root")))
    of = ends.groupBy("a").agg(F.sum("links").alias("links"), F.max("root").alias("root"))
    return not of.where("links > 1 or links = 1 and root = 1").limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every node but the roots: root is the least node that a reaches.

    ``edges`` has long columns a and b; order, repetitions and loops do not
    matter. Large-star and small-star steps alternate until there are stars
    only, which takes about log2(n) rounds; each round is written to the shared
    folder, so a lost executor costs one round at most. Hubs are split by
    adaptive skew joins.
    """
    e = common.materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not _is_stars(e):
        last, e = e, common.materialize(_small_star(_large_star(e)), "stars")
        common.drop(last)
    return e.select("a", F.col("b").alias("root"))
