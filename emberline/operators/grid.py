"""Grids as sparse cell tables (p, r, c, v): stencils are explodes over fixed offset lists, then grouped sums or minima."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..sources.tables import growing


def gaussian_weights(sigma: float) -> list[tuple[int, float]]:
    """(offset, weight) of a normalised kernel cut at four sigmas."""
    radius = int(4 * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [(k - radius, w / sum(raw)) for k, w in enumerate(raw)]


def disc(radius: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]


def offsets(pairs: list[tuple[int, int]]):
    return F.explode(F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i, j in pairs])).alias("o")


def extent(points: DataFrame) -> DataFrame:
    """One row (gx, gy): the padded lower left corner of the grid."""
    snap = lambda c: (F.floor((F.min(c) - P.PADDING) / P.CELL) * P.CELL).cast("long")
    return points.agg(snap("x").alias("gx"), snap("y").alias("gy"))


def size(points: DataFrame) -> DataFrame:
    """One row (nx, ny): columns and rows of the grid that extent() begins, padded on the far sides too."""
    far = lambda c: F.ceil((F.max(c) + P.PADDING) / P.CELL) * P.CELL
    near = lambda c: F.floor((F.min(c) - P.PADDING) / P.CELL) * P.CELL
    return points.agg(*[((far(c) - near(c)) / P.CELL).cast("long").alias(n) for c, n in (("x", "nx"), ("y", "ny"))])


def in_bounds(cells: DataFrame, grid_size: DataFrame) -> DataFrame:
    """Cells on a grid; grid_size: one row (nx, ny)."""
    on = cells.crossJoin(F.broadcast(grid_size))  # a single row
    return on.filter((F.col("c") >= 0) & (F.col("c") < F.col("nx")) & (F.col("r") >= 0) & (F.col("r") < F.col("ny"))).drop("nx", "ny")


def windows(cells: DataFrame, grid_size: DataFrame, by: list[str]) -> DataFrame:
    """(by, r0, c0, r1, c1): bounds of each group's cells, a cell wider on each side, clipped to the grid."""
    b = cells.groupBy(*by).agg(*[f(c).alias(n) for f, c, n in ((F.min, "r", "a"), (F.min, "c", "b"), (F.max, "r", "d"), (F.max, "c", "e"))])
    b = b.crossJoin(F.broadcast(grid_size))  # a single row
    zero = F.lit(0).cast("long")
    return b.select(*by, F.greatest(zero, F.col("a") - 1).alias("r0"), F.greatest(zero, F.col("b") - 1).alias("c0"), F.least(F.col("ny") - 1, F.col("d") + 1).alias("r1"), F.least(F.col("nx") - 1, F.col("e") + 1).alias("c1"))


def spread(mask: DataFrame, around: list[tuple[int, int]], keys: tuple[str, ...] = ("p",)) -> DataFrame:
    """(keys, r, c, n): the cells that the offsets reach from mask, and from how many of its cells."""
    near = mask.select(*keys, "r", "c", offsets(around)).select(*keys, (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
    return near.groupBy(*keys, "r", "c").agg(F.count("*").alias("n"))


def closing(mask: DataFrame, radius: int, keys: tuple[str, ...] = ("p",)) -> DataFrame:
    """Dilated, then eroded, by a disc: gaps and notches narrower than the disc are filled, and nothing is taken away."""
    ball = disc(radius)
    return spread(spread(mask, ball, keys).drop("n"), ball, keys).filter(F.col("n") == len(ball)).drop("n")


def same_masks(a: DataFrame, b: DataFrame) -> DataFrame:
    """(p, equal): whether both masks have the same cells in a pass; passes of either."""
    both = a.select("p", "r", "c", F.lit(1).alias("k")).union(b.select("p", "r", "c", F.lit(2).alias("k"))).groupBy("p", "r", "c").agg(F.bit_or("k").alias("k"))
    return both.groupBy("p").agg(F.every(F.col("k") == 3).alias("equal"))


def part_distances(labelled: DataFrame, radius: int = P.ADVANCE_CELLS) -> DataFrame:
    """(p, label, other, d2): squared distance in cells between parts of a pass that lie within radius, label < other.

    Only boundary cells are spread, as the nearest cells of two parts are always on their boundaries."""
    edge = labelled.join(boundary(labelled.select("p", "r", "c")), ["p", "r", "c"])
    near = edge.select("p", "label", "r", "c", offsets(disc(radius))).select("p", "label", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"), (F.col("o.dr") * F.col("o.dr") + F.col("o.dc") * F.col("o.dc")).alias("d2"))
    near = near.groupBy("p", "label", "r", "c").agg(F.min("d2").alias("d2"))
    met = near.join(edge.withColumnRenamed("label", "other"), ["p", "r", "c"]).filter("label < other")
    return met.groupBy("p", "label", "other").agg(F.min("d2").alias("d2"))


def with_cell(points: DataFrame) -> DataFrame:
    g = points.crossJoin(F.broadcast(extent(points)))  # a single row
    return g.withColumn("r", F.floor((F.col("y") - F.col("gy")) / P.CELL)).withColumn("c", F.floor((F.col("x") - F.col("gx")) / P.CELL)).drop("gx", "gy")


def smooth(cells: DataFrame, sigma: float = P.SIGMA_CELLS) -> DataFrame:
    """Separable Gaussian: columns, then rows; padding keeps all of it on the grid."""
    kernel = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in gaussian_weights(sigma)])).alias("g")
    for axis, other in (("c", "r"), ("r", "c")):
        spread = cells.select("p", other, axis, "v", kernel).select("p", other, (F.col(axis) + F.col("g.k")).alias(axis), (F.col("v") * F.col("g.w")).alias("v"))
        cells = spread.groupBy("p", "r", "c").agg(F.sum("v").alias("v"))
    return cells


def robust(smoothed: DataFrame, frozen: float | None = None) -> DataFrame:
    """Cells at EVIDENCE_ABSOLUTE of the whole run's maximum and EVIDENCE_RELATIVE of their own pass's. frozen: a maximum
    that is held fixed, so that later passes leave earlier thresholds as they are (streams)."""
    s = smoothed.withColumn("v", F.round("v", 9))
    per = s.groupBy("p").agg(F.max("v").alias("pmax"))
    top = per.agg((F.max("pmax") if frozen is None else F.lit(frozen)).alias("gmax"))
    limits = per.crossJoin(F.broadcast(top))  # a single row
    met = s.join(F.broadcast(limits), "p")  # a row for each pass
    return met.filter(F.col("v") / F.col("gmax") >= F.greatest(F.lit(P.EVIDENCE_ABSOLUTE), F.col("pmax") / F.col("gmax") * P.EVIDENCE_RELATIVE)).select("p", "r", "c", "v")


def label_cells(cells: set[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int]]:
    """4-connected components of one pass: cell -> its component's smallest cell."""
    label: dict[tuple[int, int], tuple[int, int]] = {}
    for cell in sorted(cells):
        if cell in label:
            continue
        label[cell], todo = cell, [cell]
        while todo:
            r, c = todo.pop()
            for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if n in cells and n not in label:
                    label[n] = cell
                    todo.append(n)
    return label


def _label_pass(pdf: pd.DataFrame) -> pd.DataFrame:
    label = label_cells(set(zip(pdf.r, pdf.c, strict=True)))
    roots = [label[x] for x in zip(pdf.r, pdf.c, strict=True)]
    return pdf.assign(label=[r * 100_000 + c for r, c in roots])[["p", "r", "c", "label"]]


def components(cells: DataFrame) -> DataFrame:
    """(p, r, c, label) of 4-connected components per pass; a group is the cells of one pass, bounded by the grid."""
    return cells.select("p", "r", "c").groupBy("p").applyInPandas(_label_pass, "p long, r long, c long, label long")


def without_small(cells: DataFrame) -> DataFrame:
    """Cells of components of MIN_COMPONENT cells or more."""
    labelled = components(cells)
    size = labelled.groupBy("p", "label").agg(F.count("*").alias("n")).filter(F.col("n") >= P.MIN_COMPONENT)
    return labelled.join(growing(size), ["p", "label"], "left_semi").select("p", "r", "c")


def boundary(mask: DataFrame) -> DataFrame:
    """Cells with fewer than nine set cells in their 3 x 3."""
    around = mask.select("p", "r", "c", offsets([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])).select("p", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
    n = around.groupBy("p", "r", "c").agg(F.count("*").alias("n"))
    return mask.join(growing(n), ["p", "r", "c"]).filter("n < 9").select("p", "r", "c")


def distance_to_previous(cells: DataFrame, mask: DataFrame, order: DataFrame, radius: int = P.ADVANCE_CELLS) -> DataFrame:
    """(p, r, c, d2): squared distance in cells to the mask of the pass before (order: p, prev), within radius."""
    # order has a row for each pass
    spread = cells.join(F.broadcast(order), "p").select("p", "prev", "r", "c", offsets(disc(radius)))
    spread = spread.select("p", F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("prev"), (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"), (F.col("o.dr") * F.col("o.dr") + F.col("o.dc") * F.col("o.dc")).alias("d2"))
    hit = spread.join(growing(mask.withColumnRenamed("p", "prev")), ["prev", "r", "c"])
    return hit.groupBy("p", "r0", "c0").agg(F.min("d2").alias("d2")).select("p", F.col("r0").alias("r"), F.col("c0").alias("c"), "d2")


def normalised_smooth(cells: DataFrame, at: DataFrame, sigma: float) -> DataFrame:
    """(p, r, c, v) for each cell of at: the Gaussian mean of v over the cells around that have one; 0 where none has."""
    both = cells.select("p", "r", "c", "v", F.lit(1.0).alias("n"))
    kernel = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in gaussian_weights(sigma)])).alias("g")
    for axis, other in (("c", "r"), ("r", "c")):
        spread = both.select("p", other, axis, "v", "n", kernel).select("p", other, (F.col(axis) + F.col("g.k")).alias(axis), (F.col("v") * F.col("g.w")).alias("v"), (F.col("n") * F.col("g.w")).alias("n"))
        both = spread.groupBy("p", "r", "c").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return at.select("p", "r", "c").join(growing(both), ["p", "r", "c"], "left").select("p", "r", "c", F.coalesce(F.try_divide("v", "n"), F.lit(0.0)).alias("v"))
