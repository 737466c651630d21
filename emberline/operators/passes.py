"""Satellite passes: sessions of detections, their nearest-neighbour distances and regularised distances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.classify import by_instrument, clip
from ..sources.tables import growing, materialize

#: How far nearest neighbours are looked for first at most and at least, and the mean number of places that crowds a cell.
REACH, LEAST_REACH, CROWDED = 2500, 10, 16


def sessionize(det: DataFrame, gap: int = P.PASS_GAP_MINUTES) -> DataFrame:
    """det with pass_id: a new pass of a satellite and instrument begins after more than gap minutes without a detection.

    Windows run over the distinct minutes of each satellite only, which detections are joined to."""
    minutes = det.select("satellite", "instrument", "m").distinct()
    w = Window.partitionBy("satellite", "instrument").orderBy("m")
    new = F.coalesce((F.col("m") - F.lag("m").over(w) > gap).cast("int"), F.lit(1))
    seq = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    named = minutes.withColumn("new", new).withColumn("seq", seq).withColumn("pass_id", F.concat_ws("_", "satellite", "instrument", F.format_string("%03d", "seq")))
    return det.join(growing(named.drop("new", "seq")), ["satellite", "instrument", "m"])


def summary(sessions: DataFrame) -> DataFrame:
    s = sessions.groupBy("pass_id").agg(F.min("satellite").alias("satellite"), F.min("instrument").alias("instrument"), F.min("m").cast("long").alias("first_m"), F.max("m").cast("long").alias("last_m"), F.count("*").alias("n"))
    return s.withColumn("mid", (F.col("first_m") + F.col("last_m")) / 2.0)


def with_midpoint(sessions: DataFrame) -> DataFrame:
    return sessions.join(summary(sessions).select("pass_id", "mid"), "pass_id")


def _first_reach(places: DataFrame) -> int:
    """REACH, or a quarter of it, or of that ..., until places have few others in their cells on average."""
    reach, n = REACH, places.count()
    while reach > LEAST_REACH:
        per = places.groupBy("pass_id", F.floor(F.col("x") / (2 * reach)), F.floor(F.col("y") / (2 * reach))).agg(F.count("*").alias("n"))
        if (per.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0) <= CROWDED * n:
            break
        reach //= 4
    return reach


def nearest(sessions: DataFrame) -> DataFrame:
    """(pass_id, id, d): distance to the nearest other point of the pass, null where there is none.

    Points that share their place with another are at 0. The others look for places in reach, first as far as their density
    suggests; those that find none look again four times as far, and so on until that is as wide as the widest pass. Places
    lie in cells twice as wide as the reach, of which a point's surroundings touch four."""
    p = materialize(sessions.select("id", "x", "y", "pass_id"), "nearest")
    span = p.groupBy("pass_id").agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"), F.min("id").alias("a"), F.max("id").alias("z"))
    widest = span.agg(F.max(F.greatest("dx", "dy"))).first()[0] or 0
    places = materialize(p.groupBy("pass_id", "x", "y").agg(F.min("id").alias("id"), (F.min("id") != F.max("id")).alias("shared")), "nearest-places")
    alone = span.filter("a = z").select("pass_id", F.col("a").alias("id"), F.lit(None).cast("double").alias("d2"))
    shared = p.join(growing(places.filter("shared").select("pass_id", "x", "y")), ["pass_id", "x", "y"], "left_semi").select("pass_id", "id", F.lit(0.0).alias("d2")).distinct()
    todo = places.filter("NOT shared").select("pass_id", "id", "x", "y").join(span.filter("a != z").select("pass_id"), "pass_id", "left_semi")
    found, reach = [alone, shared], _first_reach(places)
    while True:
        cell = lambda c: F.floor(c / (2 * reach))  # noqa: B023, E731
        sides = {f"c{c}": F.explode(F.array(cell(F.col(c) - reach), cell(F.col(c) + reach))) for c in "xy"}
        looking = todo.withColumn("cx", sides["cx"]).withColumn("cy", sides["cy"])
        there = places.select("pass_id", F.col("x").alias("r_x"), F.col("y").alias("r_y"), cell(F.col("x")).alias("cx"), cell(F.col("y")).alias("cy"))
        dx, dy = F.col("x") - F.col("r_x"), F.col("y") - F.col("r_y")
        close = looking.join(growing(there), ["pass_id", "cx", "cy"]).withColumn("d2", dx * dx + dy * dy).filter((F.col("d2") > 0) & (F.col("d2") <= reach * reach))
        close = materialize(close.groupBy("pass_id", "id").agg(F.min("d2").cast("double").alias("d2")), "nearest-found")
        found.append(close)
        if reach > widest * 2:
            break
        todo = materialize(todo.join(growing(close), ["pass_id", "id"], "left_anti"), "nearest-left")
        if todo.isEmpty():
            break
        reach *= 4
    return reduce(DataFrame.unionByName, found).select("pass_id", "id", F.sqrt("d2").alias("d"))


def even_subsample(rows: DataFrame, key: str, most: int = 16) -> DataFrame:
    """Rows at even steps of their order by key, from the first to the last; all of them if there are no more than most.
    rows: one for each pass, so that one window over all is small."""
    ranked = rows.select(key, (F.row_number().over(Window.orderBy(key)) - 1).alias("i"))
    ranked = ranked.crossJoin(F.broadcast(ranked.agg(F.count("*").alias("n"))))  # a single row
    steps = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.rint(k * ((F.col("n") - 1) / (most - 1))))
    return ranked.filter((F.col("n") <= most) | F.array_contains(steps, F.col("i").cast("double"))).select(key)


def nearest_stats(sessions: DataFrame) -> DataFrame:
    q = nearest(sessions).groupBy("pass_id").agg(F.avg("d").alias("mean"), F.percentile("d", F.array(F.lit(0.5), F.lit(0.75), F.lit(0.9))).alias("q"))
    q = q.select("pass_id", "mean", F.get("q", F.lit(0)).alias("med"), F.get("q", F.lit(1)).alias("p75"), F.get("q", F.lit(2)).alias("p90"))
    return summary(sessions).join(q, "pass_id")


def with_gap(passes: DataFrame) -> DataFrame:
    """Hours since the previous pass of any satellite; one row per pass, so a single window is small."""
    w = Window.orderBy("mid", "pass_id")
    return passes.withColumn("gap_h", (F.col("mid") - F.lag("mid").over(w)) / 60)


def regularize(stats: DataFrame) -> DataFrame:
    """The clipped upper-quartile distance, shrunk to the instrument's reference by the number of points."""
    lo, hi = ({k: v[i] for k, v in P.DISTANCE_BOUNDS.items()} for i in (0, 1))
    weight = F.when(F.col("p75").isNull(), 0.0).otherwise(F.col("n") / (F.col("n") + P.SHRINK))
    raw = F.coalesce(clip(clip(F.col("p75"), *P.P75_CLIP), by_instrument(lo), by_instrument(hi)), F.lit(0.0))
    s = stats.withColumn("weight", weight).withColumn("raw", raw)
    s = s.withColumn("distance", F.col("weight") * F.col("raw") + (1 - F.col("weight")) * by_instrument(P.REFERENCE_DISTANCE))
    return s.withColumn("distance_source", F.when(F.col("p75").isNull(), "instrument_fallback").otherwise("pass_shrunk"))
