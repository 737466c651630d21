"""Outlines of cell sets as polygons, and envelopes as sets of fine cells.

Envelopes: discs around points, closed by a dilation and an erosion, are kept as the time at which each fine cell joins.
The closing acts on times: a dilated cell joins with the earliest cell around it, an eroded one with the latest of those
that it needs. So one pass gives the envelope of every moment.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import geo
from ..functions.classify import by_instrument
from ..sources.tables import materialize
from .grid import disc, label_cells, offsets

Corner = tuple[int, int]


def rings(cells: set[tuple[int, int]]) -> list[list[Corner]]:
    """Closed outlines of one 4-connected set of (row, column), as (x, y) corners of cells where the direction changes:
    the outer one first and counter-clockwise, then the holes, clockwise. Holes that touch the outside at a corner stay holes."""
    after: dict[Corner, list[Corner]] = {}
    for r, c in cells:
        for (nr, nc), a, b in (((r - 1, c), (c, r), (c + 1, r)), ((r, c + 1), (c + 1, r), (c + 1, r + 1)), ((r + 1, c), (c + 1, r + 1), (c, r + 1)), ((r, c - 1), (c, r + 1), (c, r))):
            if (nr, nc) not in cells:
                after.setdefault(a, []).append(b)
    out = []
    for start in sorted(after):
        while after[start]:
            ring, at = [start], after[start].pop()
            while at != start:
                ring.append(at)
                dx, dy = at[0] - ring[-2][0], at[1] - ring[-2][1]
                right = (at[0] + dy, at[1] - dx)
                ends = after[at]
                at = ends.pop(ends.index(right) if right in ends else 0)
            n = len(ring)
            turns = [ring[i] for i in range(n) if (ring[i][0] - ring[i - 1][0], ring[i][1] - ring[i - 1][1]) != (ring[(i + 1) % n][0] - ring[i][0], ring[(i + 1) % n][1] - ring[i][1])]
            out.append([*turns, turns[0]])
    return sorted(out, key=lambda ring: area2(ring) < 0)


def area2(ring: list[Corner]) -> int:
    """Twice the signed area."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False))


def _trace(pdf: pd.DataFrame) -> pd.DataFrame:
    label, parts = label_cells(set(zip(pdf.r, pdf.c, strict=True))), {}
    for cell, root in label.items():
        parts.setdefault(root, set()).add(cell)
    rows = [(pdf.p.iloc[0], k, [[{"x": int(x), "y": int(y)} for x, y in ring] for ring in rings(parts[root])], len(parts[root])) for k, root in enumerate(sorted(parts))]
    return pd.DataFrame(rows, columns=["p", "part", "rings", "cells"])


def polygons(mask: DataFrame) -> DataFrame:
    """(p, part, rings, cells): a polygon for each 4-connected part of each pass's mask, in corners of cells. Corners lie a
    cell apart at least, so that a simplification below half a cell's diagonal would only remove points on straight lines;
    those are left out. A group is the cells of one pass, bounded by the grid."""
    return mask.select("p", "r", "c").groupBy("p").applyInPandas(_trace, "p long, part int, rings array<array<struct<x: long, y: long>>>, cells long")


def inside(polygon: list[list[Corner]]) -> set[tuple[int, int]]:
    """The cells whose centre lies in a polygon, by counting the rings' edges left of it, row by row."""
    across: dict[int, list[float]] = {}
    for ring in polygon:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
            low, high = sorted((y1, y2))
            for r in range(math.ceil(low - 0.5), math.ceil(high - 0.5)):
                across.setdefault(r, []).append(x1 + (r + 0.5 - y1) * (x2 - x1) / (y2 - y1))
    return {(r, c) for r, xs in across.items() for a, b in zip(sorted(xs)[::2], sorted(xs)[1::2], strict=True) for c in range(math.ceil(a - 0.5), math.ceil(b - 0.5))}


def rasterise(polygons_: DataFrame, touched: bool = False) -> DataFrame:
    """(p, r, c): cells whose centre lies in one of the polygons (p, rings), rings in corners of cells; with touched also
    those that an outline goes through."""

    def cells(polygon: list[list[Corner]]) -> set[tuple[int, int]]:
        out = inside(polygon)
        if touched:
            for ring in polygon:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
                    n = 4 * max(1, math.ceil(max(abs(x2 - x1), abs(y2 - y1))))
                    out |= {(math.floor(y1 + (y2 - y1) * (k + 0.5) / n), math.floor(x1 + (x2 - x1) * (k + 0.5) / n)) for k in range(n)}
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, r, c) for p, polygon in zip(pdf.p, pdf.rings, strict=True) for r, c in cells([[(v["x"], v["y"]) for v in ring] for ring in polygon])]
            yield pd.DataFrame(rows, columns=["p", "r", "c"])

    return polygons_.select("p", "rings").mapInPandas(run, "p long, r long, c long").distinct()


def simplified(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """A closed ring without the points that lie within tolerance of the line between those that stay. Four points stay at
    least, so that a ring stays a ring."""

    def off(p, a, b) -> float:
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy) if dx or dy else 0.0
        t = min(1.0, max(0.0, t))
        return math.hypot(p[0] - a[0] - t * dx, p[1] - a[1] - t * dy)

    if len(ring) <= 4:
        return ring
    half = max(range(1, len(ring) - 1), key=lambda i: math.dist(ring[0], ring[i]))  # the point furthest from the first
    keep, todo = {0, half, len(ring) - 1}, [(0, half), (half, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a > 1:
            k = max(range(a + 1, b), key=lambda i: off(ring[i], ring[a], ring[b]))
            if off(ring[k], ring[a], ring[b]) > tolerance:
                keep.add(k)
                todo += [(a, k), (k, b)]
    if len(keep) < 4:
        rest = [i for i in range(1, len(ring) - 1) if i not in keep]
        keep.add(max(rest, key=lambda i: min(off(ring[i], ring[0], ring[half]), off(ring[i], ring[half], ring[0]))))
    return [ring[i] for i in sorted(keep)]


def simplify(polygons_: DataFrame, tolerance: float) -> DataFrame:
    """Polygons (p, part, rings) with simplified rings; tolerance in sides of a cell."""
    kind = "array<array<struct<x: double, y: double>>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [[[{"x": x, "y": y} for x, y in simplified([(float(v["x"]), float(v["y"])) for v in ring], tolerance)] for ring in polygon] for polygon in pdf.rings]
            yield pd.DataFrame({"p": pdf.p, "part": pdf.part, "rings": out})

    return polygons_.select("p", "part", "rings").mapInPandas(run, f"p long, part int, rings {kind}")


def ring_area2(ring: Column) -> Column:
    """Twice the signed area of a ring of corners."""
    return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0).cast("long"), lambda s, i: s + F.get(ring, i - 1)["x"] * F.get(ring, i)["y"] - F.get(ring, i)["x"] * F.get(ring, i - 1)["y"])


def valid(ring: Column) -> Column:
    """A ring of four positions or more that ends where it began and encloses something."""
    return (F.size(ring) >= 4) & (F.get(ring, F.lit(0)) == F.element_at(ring, -1)) & (ring_area2(ring) != 0)


def repaired(polygons_: DataFrame) -> DataFrame:
    """Polygons with their valid rings only; those whose outer ring is not valid go."""
    return polygons_.filter((F.size("rings") > 0) & valid(F.get("rings", F.lit(0)))).withColumn("rings", F.filter("rings", valid))


def points_of(rings_: Column) -> Column:
    """How many positions rings have, the repeated last ones included."""
    return F.aggregate(rings_, F.lit(0), lambda n, ring: n + F.size(ring))


def to_degrees(rings_: Column, x0: Column, y0: Column, cell: int = P.CELL) -> Column:
    """Rings in corners of cells as GeoJSON positions [longitude, latitude], of a grid whose corner lies at x0, y0 in metres."""

    def position(v: Column) -> Column:
        lon, lat = geo.inverse(x0 + v["x"] * cell, y0 + v["y"] * cell)
        return F.array(F.round(lon, 7), F.round(lat, 7))

    return F.transform(rings_, lambda ring: F.transform(ring, position))


def _reached(radius: float, cell: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Offsets of cells whose centres are within radius of any point of the cell at (0, 0), and those that are of some points."""
    steps = int(radius // cell) + 1
    most = lambda k: max(abs(k * cell + cell / 2), abs(k * cell - cell / 2))
    least = lambda k: max(0, abs(k) * cell - cell / 2)
    near = [(i, j) for i in range(-steps, steps + 1) for j in range(-steps, steps + 1) if least(i) ** 2 + least(j) ** 2 <= radius * radius]
    whole = [(i, j) for i, j in near if most(i) ** 2 + most(j) ** 2 <= radius * radius]
    return whole, [o for o in near if o not in set(whole)]


def _first_times(points: DataFrame, cell: int) -> DataFrame:
    """(cluster, r, c, m): the least m of the points whose footprint holds the cell's centre.

    What any point of a cell reaches follows from the cell's least m. What only some of its points reach is looked at point by
    point, and only where the cell is early enough to change a time."""
    at = points.select("cluster", "m", "x", "y", by_instrument(P.FOOTPRINT).alias("radius"), F.floor(F.col("y") / cell).alias("r0"), F.floor(F.col("x") / cell).alias("c0"))
    blocks = materialize(at.groupBy("cluster", "radius", "r0", "c0").agg(F.min("m").alias("m")), "envelope-blocks")

    def around(k: int) -> DataFrame:
        each = [blocks.filter(F.col("radius") == f).select("*", offsets(_reached(f, cell)[k])) for f in sorted(set(P.FOOTPRINT.values()))]
        return reduce(DataFrame.union, each).withColumns({"r": F.col("r0") + F.col("o.dr"), "c": F.col("c0") + F.col("o.dc")}).drop("o")

    sure = materialize(around(0).groupBy("cluster", "r", "c").agg(F.min("m").alias("m")), "envelope-sure")
    early = around(1).join(sure.withColumnRenamed("m", "known"), ["cluster", "r", "c"], "left").filter(F.col("known").isNull() | (F.col("m") < F.col("known")))
    early = materialize(early.select("cluster", "radius", "r0", "c0", "r", "c", "known"), "envelope-open")
    dx, dy = (F.col(k) * cell + cell / 2 - F.col(d) for k, d in (("c", "x"), ("r", "y")))
    met = at.join(early, ["cluster", "radius", "r0", "c0"]).filter((F.col("known").isNull() | (F.col("m") < F.col("known"))) & (dx * dx + dy * dy <= F.col("radius") * F.col("radius")))
    return sure.union(met.select("cluster", "r", "c", "m")).groupBy("cluster", "r", "c").agg(F.min("m").alias("m"))


def envelope_times(points: DataFrame, cell: int = P.ENVELOPE_CELL, closing: int = P.CLOSING_M) -> DataFrame:
    """(cluster, r, c, m): when each cell joins its cluster's envelope. points: cluster, m, x, y, instrument."""
    first = _first_times(points, cell)
    ball = disc(closing // cell)
    for join, needed in ((F.min("m"), 1), (F.max("m"), len(ball))):
        around = first.select("cluster", "m", "r", "c", offsets(ball)).select("cluster", "m", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
        first = around.groupBy("cluster", "r", "c").agg(join.alias("m"), F.count("*").alias("n")).filter(F.col("n") >= needed).drop("n")
    return first.select("cluster", "r", "c", "m")
