"""Cumulative detection envelopes per fire: which points count, their running states, snapshots, and cluster identity."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.classify import by_instrument
from ..sources.tables import discard, materialize
from .neighbours import pairs_within, with_neighbours


def same_pass_supported(det: DataFrame, radius: int = 2000) -> DataFrame:
    """Rows of det with another detection of the same pass (slot) within radius, of any instrument."""
    return det.join(with_neighbours(det, radius, on="slot").filter("near").select("id"), "id", "left_semi")


def counted(points: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(cluster, id, m) of the points that count: those that their pass supports, and those within CONTINUITY_M of the
    footprint of a point of their cluster that counts and comes before them (by m, satellite, instrument, id).

    A point depends on earlier ones only, so that what a walk through the points in order would count is what can be
    reached from the supported ones: each round joins the points that are still open with those that were counted last.
    points: cluster, id, m, x, y, satellite, instrument, supported."""
    p = materialize(points.select("cluster", "id", "m", "x", "y", by_instrument(P.FOOTPRINT).alias("reach"), F.struct("m", "satellite", "instrument", "id").alias("place"), "supported"), "points")
    widest = int(P.CONTINUITY_M + max(P.FOOTPRINT.values()))
    done = [p.filter("supported")]
    todo = p.filter("NOT supported")
    for _ in range(max_rounds):
        near = pairs_within(todo.select("cluster", "id", "x", "y", "place"), done[-1].select("cluster", "id", "x", "y", "place", "reach"), F.lit(widest), widest, on="cluster")
        limit = F.col("r_reach") + P.CONTINUITY_M
        hit = near.filter((F.col("r_place") < F.col("place")) & (F.col("d2") <= limit * limit)).select("id").distinct()
        new = materialize(todo.join(hit, "id", "left_semi"), "counted")
        if new.isEmpty():
            break
        done.append(new)
        todo = materialize(todo.join(new.select("id"), "id", "left_anti"), "open")
    else:
        raise RuntimeError(f"continuity did not settle in {max_rounds} rounds")
    return reduce(DataFrame.unionByName, done).select("cluster", "id", "m", "place")


def states(points: DataFrame) -> DataFrame:
    """(cluster, id, m, n): counted points in order with their running number. points as for counted()."""
    n = F.row_number().over(Window.partitionBy("cluster").orderBy("place")).cast("long")
    return counted(points).select("cluster", "id", "m", n.alias("n"))


def snapshots(state: DataFrame, minutes: int = P.SNAPSHOT_HOURS * 60) -> DataFrame:
    """(cluster, target, m, n): state (cluster, m, n) as of the first time, every step after it and the last time; a state
    that was already taken is not taken again."""
    span = state.groupBy("cluster").agg(F.min("m").alias("a"), F.max("m").alias("b"))
    targets = span.select("cluster", F.explode(F.array_distinct(F.concat(F.filter(F.sequence("a", "b", F.lit(minutes).cast("long")), lambda t: t < F.col("b")), F.array("b")))).alias("target"))
    both = state.select("cluster", F.col("m").alias("at"), F.lit(0).alias("kind"), F.struct("m", "n").alias("s")).unionByName(targets.select("cluster", F.col("target").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("struct<m:long,n:long>").alias("s")))
    w = Window.partitionBy("cluster").orderBy("at", "kind")
    asof = both.withColumn("s", F.last("s", ignorenulls=True).over(w)).filter("kind = 1")
    changed = asof.withColumn("before", F.lag("s.m").over(Window.partitionBy("cluster").orderBy("at")))
    return changed.filter("before IS NULL OR before != s.m").select("cluster", F.col("at").alias("target"), "s.m", "s.n")


def overlaps(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old_cluster, new_cluster, cells, iou, apart) of clusters (cluster, r, c) that share cells; apart: squared distance
    between the centres of their bounds, in half cells."""
    a, b = (t.groupBy("cluster").agg(F.count("*").alias("n"), (F.min("r") + F.max("r")).alias("y"), (F.min("c") + F.max("c")).alias("x")) for t in (old, new))
    shared = old.select(F.col("cluster").alias("old_cluster"), "r", "c").join(new.select(F.col("cluster").alias("new_cluster"), "r", "c"), ["r", "c"]).groupBy("old_cluster", "new_cluster").agg(F.count("*").alias("cells"))
    met = shared.join(a.select(F.col("cluster").alias("old_cluster"), F.col("n").alias("na"), F.col("x").alias("xa"), F.col("y").alias("ya")), "old_cluster").join(b.select(F.col("cluster").alias("new_cluster"), "n", "x", "y"), "new_cluster")
    dx, dy = F.col("x") - F.col("xa"), F.col("y") - F.col("ya")
    return met.select("old_cluster", "new_cluster", "cells", (F.col("cells") / (F.col("na") + F.col("n") - F.col("cells"))).alias("iou"), (dx * dx + dy * dy).alias("apart"))


def best_match(shared: DataFrame) -> DataFrame:
    """(old_cluster, new_cluster, cells): for each old cluster the new one with the largest overlap, then the nearest, then
    the largest id. shared: overlaps()."""
    best = F.max(F.struct("cells", (-F.col("apart")).alias("near"), "new_cluster")).alias("b")
    return shared.groupBy("old_cluster").agg(best).select("old_cluster", "b.new_cluster", "b.cells")


def match_one_to_one(shared: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(new_cluster, old_cluster): pairs taken greedily by (cells, iou, old id, new id), the
    largest first, each side once. shared: overlaps().

    A pair that is the best of both its sides is what the greedy order takes before any other pair of theirs, so each round
    takes all such pairs at once, and what they used leaves the table."""
    left = materialize(shared.select("old_cluster", "new_cluster", F.struct("cells", "iou", F.col("old_cluster").alias("o"), F.col("new_cluster").alias("w")).alias("rank")), "overlaps")
    taken = []
    for _ in range(max_rounds):
        if left.isEmpty():
            break
        ranked = left
        for side in ("old_cluster", "new_cluster"):
            ranked = ranked.withColumn(f"top_{side}", F.max("rank").over(Window.partitionBy(side)))
        pairs = materialize(ranked.filter((F.col("rank") == F.col("top_old_cluster")) & (F.col("rank") == F.col("top_new_cluster"))).select("new_cluster", "old_cluster"), "matched")
        taken.append(pairs)
        last, left = left, materialize(left.join(pairs.select("old_cluster"), "old_cluster", "left_anti").join(pairs.select("new_cluster"), "new_cluster", "left_anti"), "overlaps")
        discard(last)
    else:
        raise RuntimeError(f"matching did not settle in {max_rounds} rounds")
    return reduce(DataFrame.union, taken) if taken else left.select("new_cluster", "old_cluster")


def _fallback(pdf: pd.DataFrame) -> pd.DataFrame:
    used = set(pdf.old_cluster.dropna().astype(int))
    rows, free = [], 1
    for new, old in sorted((int(n), None if pd.isna(o) else int(o)) for n, o in zip(pdf.new_cluster, pdf.old_cluster, strict=True)):
        if old is not None:
            rows.append((new, old, "matched"))
            continue
        how, chosen = "own", new
        if new in used:
            while free in used:
                free += 1
            how, chosen = "free", free
        used.add(chosen)
        rows.append((new, chosen, how))
    return pd.DataFrame(rows, columns=["new_cluster", "id", "how"])


def assign_ids(new: DataFrame, matched: DataFrame) -> DataFrame:
    """(new_cluster, id, how): a matched cluster gets the old id. The others follow in order: each keeps its own id if it is
    not used yet, and else gets the smallest from 1 on that is not. new: (cluster).

    Each choice depends on all before, so that the ids of one run, a row for each cluster, are one group."""
    named = new.select(F.col("cluster").alias("new_cluster")).join(matched, "new_cluster", "left").select("new_cluster", "old_cluster", F.lit(0).alias("run"))
    return named.groupBy("run").applyInPandas(_fallback, "new_cluster long, id long, how string")


def monotone_floor(new: DataFrame, old: DataFrame) -> DataFrame:
    """(cluster, r, c, m): new with all that an earlier run had, from the time it had it. Both say when cells join.

    A new run that ends before the old one is refused."""
    ends = [t.agg(F.max("m")).first()[0] for t in (old, new)]
    if ends[0] is not None and (ends[1] is None or ends[1] < ends[0]):
        raise ValueError(f"the new run ends at {ends[1]}, before the old one at {ends[0]}")
    return new.select("cluster", "r", "c", "m").unionByName(old.select("cluster", "r", "c", "m")).groupBy("cluster", "r", "c").agg(F.min("m").alias("m"))
