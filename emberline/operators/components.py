"""Connected components of edge tables, and clusters of points by single linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import discard, growing, materialize


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
    """(node, component) for the nodes of edges (src, dst longs; undirected, loops allowed): the smallest node reachable.

    Large-star and small-star steps in turn, each with minima combined before the shuffle; edges are written to the shared
    folder between rounds, and a round that leaves them as they were is the last. A node whose only edge is a loop is its
    own component."""
    loops = materialize(edges.filter("src = dst").select("src").distinct(), "loops")
    now = materialize(edges.filter("src != dst").select("src", "dst").distinct(), "edges")
    mark = lambda t: tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first())
    before = mark(now)
    for _ in range(max_rounds):
        last, now = now, materialize(_small_star(_large_star(now)), "edges")
        discard(last)
        if (after := mark(now)) == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return found.union(roots).union(loops.select("src", "src")).groupBy("node").agg(F.min("component").alias("component"))


def linked_clusters(points: DataFrame, radius: int) -> DataFrame:
    """(id, cluster): single-linkage clusters of points (id, x, y) at distances of radius or less; cluster is the smallest id.

    Points are contracted to square cells whose diagonal is the radius at most, so all points of a cell belong together.
    Cells link where their nearest points do, which only cells at most two apart can. Most pairs of cells are decided by a
    row for each cell, the box of its points: boxes further apart than the radius never link, and boxes whose furthest
    corners are within it always do. Only what is left compares points, and only distinct places near the other's box."""
    side = int(radius / 2**0.5)
    p = points.select("id", "x", "y", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    box = {"x0": F.min("x"), "x1": F.max("x"), "y0": F.min("y"), "y1": F.max("y")}
    cells = materialize(p.groupBy("cx", "cy").agg(F.min("id").alias("node"), *[f.alias(n) for n, f in box.items()]), "cells")
    offsets = [(i, j) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0)]
    ahead = cells.select(*[F.col(c).alias(f"a_{c}") for c in cells.columns], F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets])).alias("o"))
    ahead = ahead.withColumns({"cx": F.col("a_cx") + F.col("o.i"), "cy": F.col("a_cy") + F.col("o.j")}).join(cells, ["cx", "cy"])
    apart = lambda d: F.greatest(F.lit(0), F.col(f"a_{d}0") - F.col(f"{d}1"), F.col(f"{d}0") - F.col(f"a_{d}1"))
    across = lambda d: F.greatest(F.col(f"a_{d}1") - F.col(f"{d}0"), F.col(f"{d}1") - F.col(f"a_{d}0"))
    near, far = (f("x") * f("x") + f("y") * f("y") for f in (apart, across))
    pairs = materialize(ahead.filter(near <= radius * radius).withColumn("sure", far <= radius * radius).select("a_cx", "a_cy", "cx", "cy", "a_node", "node", "sure", "x0", "x1", "y0", "y1"), "cell-pairs")
    places = p.select("cx", "cy", "x", "y").distinct()
    gap = lambda d: F.greatest(F.lit(0), F.col(f"{d}0") - F.col(d), F.col(d) - F.col(f"{d}1"))
    own = pairs.filter("NOT sure").join(places.select(F.col("cx").alias("a_cx"), F.col("cy").alias("a_cy"), "x", "y"), ["a_cx", "a_cy"])
    own = own.filter(gap("x") * gap("x") + gap("y") * gap("y") <= radius * radius).select("cx", "cy", "a_node", "node", "x", "y")
    other = places.select("cx", "cy", F.col("x").alias("x2"), F.col("y").alias("y2"))
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    # a semi join: a place stops at the first place it finds
    met = own.join(other, (own["cx"] == other["cx"]) & (own["cy"] == other["cy"]) & (dx * dx + dy * dy <= radius * radius), "left_semi")
    edges = pairs.filter("sure").select(F.col("a_node").alias("src"), F.col("node").alias("dst")).union(met.select("a_node", "node")).distinct()
    found = connected_components(edges)
    labelled = cells.join(found, "node", "left").select("cx", "cy", F.coalesce("component", "node").alias("cluster"))
    return p.join(labelled, ["cx", "cy"]).select("id", "cluster")
