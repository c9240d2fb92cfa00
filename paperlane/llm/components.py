"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.session import materialize


def stored_low(low: DataFrame) -> DataFrame:
    """The smallest node of each star, stored: both sides of the join that follows are then plain shuffles, and
    the edges of a star with most of them can be split."""
    return materialize(low, "low")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest node it knows, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = stored_low(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
    linked = both.filter("b > a").join(low.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    return linked.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them; here a > b."""
    low = stored_low(edges.groupBy("a").agg(F.min("b").alias("low")))
    linked = edges.join(low.withColumnRenamed("a", "node"), F.col("a") == F.col("node"))
    moved = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node (``root``) of every ``node`` that has a link ``a`` - ``b``; roots
    themselves are not listed.

    Rounds go on until every node has one link, to a node without a smaller one: about as many as the
    logarithm of the longest path. Every round is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "stars")
    while True:
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if not ends.filter("up > 1 OR (up = 1 AND down > 0)").limit(1).count():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = materialize(_small_star(_large_star(edges)), "stars")
