"""Connected components by alternating large-star and small-star steps, on the executors throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import growing
from ._shared import discard, materialize


def _settled(edges: DataFrame) -> bool:
    """Whether edges, src > dst, are stars around their smallest nodes: each node has one edge down at most, and none up if so."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("dst", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.agg(F.coalesce(F.max(F.col("down") + F.least("down", "up")), F.lit(0))).first()[0] < 2


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("src", "dst").union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    return both.join(growing(least), "src").filter(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(growing(least), "src").filter(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.union(least.select("src", F.col("m").alias("dst"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (src, dst; longs, undirected): the smallest node it can reach.

    Minima are combined on the map side before each shuffle, and the joins that hand them back are plain equi-joins,
    which adaptive execution splits where a node has very many edges. Edges that are stars already, as components found
    before are, need no step. Loops and repeated edges do no harm; no edges give no rows."""
    down = edges.filter(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = materialize(down.distinct(), "components")
    for _ in range(max_rounds):
        if _settled(now):
            roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
        last, now = now, materialize(_small_star(_large_star(now)), "components")
        discard(last)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
