"""The sequential progression model: persistence, advance, provisional and confirmed starts, per region.

No rule reaches further than ADVANCE_CELLS, so the run's cells are cut into regions that lie further apart, and each is
folded on its own, seeing the times of all passes. A region is what connected tiles of ADVANCE_CELLS cells hold."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..sources.tables import growing
from .components import connected_components
from .grid import disc, label_cells

_TILE = P.ADVANCE_CELLS
Cells = set[tuple[int, int]]


def regions(cells: DataFrame) -> DataFrame:
    """cells with region, the smallest tile number of the connected tiles."""
    number = lambda r, c: F.col(r) * 1_000_000 + F.col(c)
    t = cells.withColumn("tr", F.floor(F.col("r") / _TILE)).withColumn("tc", F.floor(F.col("c") / _TILE))
    tiles = t.select("tr", "tc").distinct()
    near = tiles.select("tr", "tc", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("o"))
    near = near.select(number("tr", "tc").alias("src"), (F.col("tr") + F.col("o.i")).alias("tr"), (F.col("tc") + F.col("o.j")).alias("tc"))
    edges = near.join(growing(tiles), ["tr", "tc"]).select("src", number("tr", "tc").alias("dst"))
    found = connected_components(edges).select(F.col("node").alias("tile"), F.col("component").alias("region"))
    return t.withColumn("tile", number("tr", "tc")).join(growing(found), "tile").drop("tile", "tr", "tc")


def _large(cells: Cells) -> list[Cells]:
    groups: dict[tuple[int, int], Cells] = {}
    for cell, root in label_cells(cells).items():
        groups.setdefault(root, set()).add(cell)
    return [g for _, g in sorted(groups.items()) if len(g) >= P.MIN_COMPONENT]


def _near(cells: Cells, radius: int) -> Cells:
    reach = disc(radius)
    return {(r + i, c + j) for r, c in cells for i, j in reach}


def fold(passes: list[tuple[int, float, Cells]]) -> list[dict]:
    """passes: (p, hours, robust cells) in order, of which the first is the run's first pass. A row of counts for each, and
    the cells of each category."""
    history: Cells = set()
    pending: list[tuple[float, Cells]] = []
    out = []
    for k, (p, now, cells) in enumerate(passes):
        waiting = [x for x in pending if now - x[0] <= P.CONFIRM_HOURS]
        expired, pending = len(pending) - len(waiting), waiting
        persistence: Cells = set()
        advance: Cells = set()
        provisional: Cells = set()
        confirmed: Cells = set()
        if k == 0:
            confirmed = set(cells)
        else:
            persistence = set().union(*_large(cells & history))
            beyond = cells - history
            close = beyond & _near(history, P.ADVANCE_CELLS) if history else set()
            advance = set().union(*_large(close))
            for part in _large(beyond - close):
                met = [(min((r - a) ** 2 + (c - b) ** 2 for r, c in part for a, b in old), i) for i, (t, old) in enumerate(pending) if 0 < now - t]
                best = min(met, default=None)
                if best and best[0] <= P.CONFIRM_CELLS**2:
                    confirmed |= part | pending.pop(best[1])[1]
                else:
                    provisional |= part
                    pending.append((now, part))
        history = set().union(*_large(history | persistence | advance | confirmed))
        made = {"persistence": persistence, "advance": advance, "provisional": provisional, "confirmed": confirmed}
        out.append({"p": p, "cells": made, "persistence": len(persistence), "advance": len(advance), "provisional": len(provisional), "confirmed": len(confirmed), "pending": len(pending), "expired": expired, "history": len(history), "components": len(set(label_cells(history).values()))})
    return out


_COUNTS = ("persistence", "advance", "provisional", "confirmed", "pending", "expired", "history", "components")


def progression(cells: DataFrame, hours_per_pass: DataFrame) -> DataFrame:
    """What becomes of each pass in each region: a row of counts, and rows (p, category, r, c) of the cells themselves, told
    apart by category being null. cells: (p, r, c); hours_per_pass: (p, hours) of all passes, one row each."""
    # one row a pass: the times of all go to each task once
    times = sorted((r.hours, r.p) for r in hours_per_pass.select("hours", "p").collect())
    columns = ["p", "category", "r", "c", *_COUNTS]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        by: dict[int, Cells] = {}
        for p, r, c in zip(pdf.p, pdf.r, pdf.c, strict=True):
            by.setdefault(p, set()).add((r, c))
        rows = []
        for x in fold([(p, hours, by.get(p, set())) for hours, p in times]):
            rows.append((x["p"], None, None, None, *(x[c] for c in _COUNTS)))
            rows += [(x["p"], name, r, c, *[None] * len(_COUNTS)) for name, made in x["cells"].items() for r, c in sorted(made)]
        return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns if c != "category"})

    return regions(cells).groupBy("region").applyInPandas(run, "p long, category string, r long, c long, " + ", ".join(f"{c} long" for c in _COUNTS))


def counts(folded: DataFrame) -> DataFrame:
    """Counts per pass, summed over regions, and areas."""
    per = folded.filter("category IS NULL").groupBy("p").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    return per.select("p", *_COUNTS, *[F.bround(F.col(c) * P.CELL_AREA_KM2, 3).alias(f"{c}_km2") for c in ("persistence", "advance", "provisional", "confirmed", "history")])


def categories(folded: DataFrame) -> DataFrame:
    """(p, category, r, c): the four categories, and observed_front, which is all of them together."""
    own = folded.filter("category IS NOT NULL").select("p", "category", "r", "c")
    return own.unionByName(own.select("p", F.lit("observed_front").alias("category"), "r", "c").distinct())
