"""Evidence grids, masks, fronts and the progression model on the `events` view; a pass is a slot of the view."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import classify
from ..functions.classify import pixel_area
from ..operators import grid, passes, progression
from ..sources.detections import detections
from ..sources.tables import growing, step
from .registry import query
from .support_queries import _CLASSES, _REG, distances, support

_WEIGHTS = ", ".join(f"({k}, {w!r})" for k, w in grid.gaussian_weights(P.SIGMA_CELLS))
_CELLED = f"""{_CLASSES}, ext AS (SELECT CAST(floor((min(x) - 3000) / 250.0) * 250 AS BIGINT) AS gx, CAST(floor((min(y) - 3000) / 250.0) * 250 AS BIGINT) AS gy FROM det),
cel AS (SELECT slot AS p, m, id, (y - gy) // 250 AS r, (x - gx) // 250 AS c, (CASE causal_class WHEN 'same_pass' THEN 1.0 WHEN 'past_confirmed' THEN 0.75 ELSE 0.0 END) * (CASE WHEN scan * track > 0 THEN scan * track WHEN instrument = 'MODIS' THEN 1.0 ELSE 0.140625 END) AS w FROM c CROSS JOIN ext),
ev AS (SELECT p, r, c, sum(w) AS v FROM cel WHERE w > 0 GROUP BY p, r, c)"""
_SMOOTH = f"{_CELLED}, gw(k, gw) AS (VALUES {_WEIGHTS}), h1 AS (SELECT p, r, c + k AS c, sum(v * gw) AS v FROM ev CROSS JOIN gw GROUP BY ALL), sm AS (SELECT p, r + k AS r, c, round(sum(v * gw), 9) AS v FROM h1 CROSS JOIN gw GROUP BY ALL)"
_ROBUST = f"{_SMOOTH}, pm AS (SELECT p, max(v) AS pmax FROM sm GROUP BY p), gm AS (SELECT max(pmax) AS gmax FROM pm), rb AS (SELECT sm.p, r, c, v FROM sm JOIN pm USING (p) CROSS JOIN gm WHERE v / gmax >= greatest(0.04, pmax / gmax * 0.35))"
_COMP = f"{_ROBUST.replace('WITH', 'WITH RECURSIVE', 1)}, rc AS (SELECT p, r, c, r * 100000 + c AS k FROM rb), reach(p, root, k) AS (SELECT p, k, k FROM rc UNION SELECT q.p, q.root, rc.k FROM reach q JOIN rc ON rc.p = q.p AND rc.k > q.root AND (rc.k = q.k + 1 OR rc.k = q.k - 1 OR rc.k = q.k + 100000 OR rc.k = q.k - 100000)), lab AS (SELECT p, k, min(root) AS label FROM reach GROUP BY p, k)"
_MASK = f"{_COMP}, big AS (SELECT p, label FROM lab GROUP BY p, label HAVING count(*) >= 4), mk AS (SELECT lab.p, k // 100000 AS r, k % 100000 AS c FROM lab JOIN big USING (p, label))"
_ORDER = f"{_MASK}, ps AS (SELECT slot AS p, count(*) AS n, (min(m) + max(m)) / 120.0 AS hours FROM det GROUP BY slot), od AS (SELECT *, lag(p) OVER (ORDER BY p) AS prev, lag(n) OVER (ORDER BY p) AS n_prev, hours - lag(hours) OVER (ORDER BY p) AS gap FROM ps)"
_BOUND = f"{_ORDER}, bd AS (SELECT a.p, a.r, a.c FROM mk a JOIN mk b ON a.p = b.p AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.p, a.r, a.c HAVING count(*) < 9)"
_DIST = f"{_BOUND}, ds AS (SELECT a.p, a.r, a.c, min((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) AS d2 FROM bd a JOIN od USING (p) JOIN mk b ON b.p = od.prev AND abs(a.r - b.r) <= 10 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 100 GROUP BY a.p, a.r, a.c)"
_SPEED_WEIGHTS = ", ".join(f"({k}, {w!r})" for k, w in grid.gaussian_weights(P.SPEED_SIGMA_CELLS))
_REGS = re.sub(r"\bsm\b", "psm", _REG.split(", g AS (", 1)[1])
_CHAR = f"""g AS ({_REGS}, md AS (SELECT mid / 60 AS hours, arg_max(distance, pass_id) AS char_m FROM (SELECT pass_id, distance FROM rd) JOIN st USING (pass_id) GROUP BY mid), ch AS (SELECT p, coalesce(char_m, 600.0) AS char_m FROM od LEFT JOIN md USING (hours))"""
_FRONT = f"""{_DIST}, {_CHAR}, sp AS (SELECT ds.p, r, c, round(sqrt(d2) * 250 / gap, 6) AS speed FROM ds JOIN od USING (p) JOIN ch USING (p) WHERE sqrt(d2) * 250 <= least(2500.0, greatest(1000.0, 1.5 * char_m)) AND gap > 0 AND gap <= 3 AND n >= 10 AND n_prev >= 10),
fr AS (SELECT bd.p, count(sp.speed) / count(*) AS fraction FROM bd LEFT JOIN sp USING (p, r, c) GROUP BY bd.p), sw(k, sw) AS (VALUES {_SPEED_WEIGHTS}),
s1 AS (SELECT p, r, c + k AS c, sum(speed * sw) AS v, sum(sw) AS n FROM sp CROSS JOIN sw GROUP BY ALL), s2 AS (SELECT p, r + k AS r, c, sum(v * sw) AS v, sum(n * sw) AS n FROM s1 CROSS JOIN sw GROUP BY ALL),
ss AS (SELECT p, r, c, round(coalesce(v / n, 0), 6) AS speed FROM bd LEFT JOIN s2 USING (p, r, c))"""


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, r, c, v): weight of the detections in each cell and pass."""
    w = F.when(F.col("causal_class") == "same_pass", 1.0).when(F.col("causal_class") == "past_confirmed", 0.75).otherwise(0.0) * pixel_area()
    d = grid.with_cell(support(spark, sf_dir)).withColumn("w", w).filter("w > 0")
    return d.groupBy(F.col("slot").alias("p"), "r", "c").agg(F.sum("w").alias("v"))


def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step(spark, "smoothed", f"{sf_dir}/events.parquet", lambda: grid.smooth(evidence(spark, sf_dir)))


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, r, c): robust evidence without small components, written once as most queries start from it."""
    return step(spark, "masks", f"{sf_dir}/events.parquet", lambda: grid.without_small(grid.robust(smoothed(spark, sf_dir))))


def pass_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, n, hours, prev, n_prev, gap): one row per pass, so one window over all is small."""
    ps = detections(spark, sf_dir).groupBy(F.col("slot").alias("p")).agg(F.count("*").alias("n"), ((F.min("m") + F.max("m")) / 120.0).alias("hours"))
    w = Window.orderBy("p")
    return ps.withColumns({"prev": F.lag("p").over(w), "n_prev": F.lag("n").over(w), "gap": F.col("hours") - F.lag("hours").over(w)})


@query(f"{_CELLED} SELECT p, r, c, round(v, 8) AS v FROM ev")
def grid_scatter_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence(spark, sf_dir).select("p", "r", "c", F.round("v", 8).alias("v"))


@query(f"{_SMOOTH} SELECT p, count(*) AS cells, round(sum(v), 4) AS mass, round(max(v), 5) AS peak FROM sm GROUP BY p")
def gaussian_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = smoothed(spark, sf_dir).withColumn("v", F.round("v", 9))
    return s.groupBy("p").agg(F.count("*").alias("cells"), F.round(F.sum("v"), 4).alias("mass"), F.round(F.max("v"), 5).alias("peak"))


@query(f"{_ROBUST} SELECT p, r, c FROM rb")
def evidence_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.robust(smoothed(spark, sf_dir)).select("p", "r", "c")


@query(f"{_CELLED}, t AS (SELECT r, c, p, v, (p * 48 + 3) / 60.0 AS h FROM ev) SELECT a.p, a.r, a.c, round(sum(b.v * pow(2, (b.h - a.h) / 12)) + 1e-11, 8) AS state FROM t a JOIN t b ON a.r = b.r AND a.c = b.c AND b.p <= a.p GROUP BY a.p, a.r, a.c")
def active_decay_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state = state * 2^(-hours / 12) + evidence, as a running sum of evidence carried to hour 0; rescaled by pass."""
    t = evidence(spark, sf_dir).withColumn("h", (F.col("p") * 48 + 3) / 60.0)
    w = Window.partitionBy("r", "c").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    grown = F.sum(F.col("v") * F.pow(F.lit(2.0), F.col("h") / P.HALF_LIFE_HOURS)).over(w)
    return t.select("p", "r", "c", F.round(grown * F.pow(F.lit(2.0), -F.col("h") / P.HALF_LIFE_HOURS) + 1e-11, 8).alias("state"))


@query(f"{_COMP} SELECT p, label, count(*) AS n FROM lab GROUP BY p, label")
def grid_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.components(grid.robust(smoothed(spark, sf_dir))).groupBy("p", "label").agg(F.count("*").alias("n"))


@query(f"{_MASK} SELECT p, r, c FROM mk")
def remove_small_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir)


@query(f"{_BOUND} SELECT p, r, c FROM bd")
def mask_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.boundary(masks(spark, sf_dir))


def _distances(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Masks, their boundaries, and the boundary cells' squared distances to the mask of the pass before."""
    m, order = masks(spark, sf_dir), pass_order(spark, sf_dir)
    b = step(spark, "boundary", f"{sf_dir}/events.parquet", lambda: grid.boundary(m))
    reach = int(P.CORRESPONDENCE_M[1] // P.CELL)
    d = step(spark, "boundary-distance", f"{sf_dir}/events.parquet", lambda: grid.distance_to_previous(b, m, order.select("p", "prev").filter("prev IS NOT NULL"), reach))
    return m, b, d


def characteristic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, char_m): the regularised distance of the pass with that midpoint, of several the last one's; the fallback where
    there is none."""
    stats = passes.regularize(distances(spark, sf_dir))
    known = stats.groupBy((F.col("mid") / 60).alias("hours")).agg(F.max_by(F.round("distance", 4), "pass_id").alias("char_m"))
    return pass_order(spark, sf_dir).select("p", "hours").join(known, "hours", "left").select("p", F.coalesce("char_m", F.lit(P.FALLBACK_DISTANCE)).alias("char_m"))


def correspondence_m(distance: Column) -> Column:
    """How far from the mask before a boundary cell may lie to correspond with it, by the pass's characteristic distance."""
    low, high = P.CORRESPONDENCE_M
    return F.least(F.lit(high), F.greatest(F.lit(low), distance * P.CORRESPONDENCE_FACTOR))


def _usable() -> Column:
    """Whether a pass can be compared with the one before."""
    return (F.col("gap") > 0) & (F.col("gap") <= P.FRONT_MAX_GAP_H) & (F.col("n") >= P.FRONT_MIN_POINTS) & (F.col("n_prev") >= P.FRONT_MIN_POINTS)


def _front(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Masks, boundaries, the corresponding boundary cells' speeds in metres an hour, and each pass's share of such cells."""
    m, b, d = _distances(spark, sf_dir)
    order = pass_order(spark, sf_dir).filter(_usable()).select("p", "gap").join(F.broadcast(characteristic(spark, sf_dir)), "p")  # a row for each pass
    near = d.join(F.broadcast(order), "p").filter(F.sqrt("d2") * P.CELL <= correspondence_m(F.col("char_m")))
    s = near.select("p", "r", "c", F.round(F.sqrt("d2") * P.CELL / F.col("gap"), 6).alias("speed"))
    share = b.join(growing(s), ["p", "r", "c"], "left").groupBy("p").agg((F.count("speed") / F.count("*")).alias("fraction"))
    return m, b, s, share


def _smoothed(speeds: DataFrame, boundary: DataFrame) -> DataFrame:
    s = grid.normalised_smooth(speeds.withColumnRenamed("speed", "v"), boundary, P.SPEED_SIGMA_CELLS)
    return s.select("p", "r", "c", F.round("v", 6).alias("speed"))


@query(f"{_DIST} SELECT p, r, c, CAST(d2 AS BIGINT) AS d2 FROM ds")
def distance_to_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distances(spark, sf_dir)[2].select("p", "r", "c", F.col("d2").cast("long").alias("d2"))


@query(f"{_ORDER} SELECT p, count(*) AS n FROM (SELECT DISTINCT a.p, a.r, a.c FROM mk a JOIN od USING (p) JOIN mk b ON b.p = od.prev AND abs(a.r - b.r) <= 8 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 64) GROUP BY p")
def masks_within_2000m(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = masks(spark, sf_dir)
    order = pass_order(spark, sf_dir).select("p", "prev").filter("prev IS NOT NULL")
    return grid.distance_to_previous(m, m, order).groupBy("p").agg(F.count("*").alias("n"))


@query(f"{_FRONT} SELECT p, r, c, speed FROM sp")
def boundary_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _front(spark, sf_dir)[2]


@query(f"{_FRONT} SELECT p, r, c, speed FROM ss WHERE speed > 0")
def smoothed_boundary_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary cells' speeds by normalised convolution; cells that no speed reaches have none."""
    _, b, s, _ = _front(spark, sf_dir)
    return _smoothed(s, b).filter("speed > 0")


@query(f"{_FRONT} SELECT p, round(fraction, 6) AS fraction FROM fr")
def coherent_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _front(spark, sf_dir)[3].select("p", F.round("fraction", 6).alias("fraction"))


@query(f"{_FRONT} SELECT p, round(quantile_cont(speed, 0.5) / 1000, 6) AS median_kmh, round(quantile_cont(speed, 0.9) / 1000, 6) AS p90_kmh FROM ss WHERE speed > 0 GROUP BY p")
def speed_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = smoothed_boundary_speed(spark, sf_dir)
    return s.groupBy("p").agg(F.round(F.percentile("speed", 0.5) / 1000, 6).alias("median_kmh"), F.round(F.percentile("speed", 0.9) / 1000, 6).alias("p90_kmh"))


def _projected(hours: int, halo: float, then: str = "SELECT p, count(*) AS cells, round(count(*) * 0.0625, 4) AS area_km2 FROM pj GROUP BY p") -> str:
    return f"""{_FRONT}, el AS (SELECT p FROM fr WHERE fraction >= 0.25), nb AS (SELECT ss.p, ss.r + o.i AS r, ss.c + o.j AS c, arg_min(speed, (o.i * o.i + o.j * o.j, ss.r, ss.c)) AS speed, min(o.i * o.i + o.j * o.j) AS d2 FROM ss SEMI JOIN el USING (p) JOIN (SELECT i, j FROM range(-11, 12) t(i), range(-11, 12) u(j) WHERE i * i + j * j <= 121) o ON true GROUP BY 1, 2, 3),
pj AS (SELECT p, r, c FROM mk SEMI JOIN el USING (p) UNION SELECT p, r, c FROM nb JOIN ch USING (p) WHERE speed > 0 AND sqrt(d2) * 250 <= least(speed * {hours} * 0.25, 2000.0) + {halo} * char_m) {then}"""


def project(mask: DataFrame, speeds: DataFrame, hours: int, halo: DataFrame | None = None) -> DataFrame:
    """mask and the cells that the nearest boundary cell's scaled speed reaches within hours, plus a halo; of boundary
    cells as near the one with the smallest row and column counts. speeds has all boundary cells; halo: (p, halo metres)."""
    o = F.col("o.dr") * F.col("o.dr") + F.col("o.dc") * F.col("o.dc")
    near = speeds.select("p", "r", "c", "speed", grid.offsets(grid.disc(11))).select("p", (F.col("r") + F.col("o.dr")).alias("r1"), (F.col("c") + F.col("o.dc")).alias("c1"), F.struct(o.alias("d2"), "r", "c", "speed").alias("k"))
    best = near.groupBy("p", "r1", "c1").agg(F.min("k").alias("k")).filter("k.speed > 0")
    reach = F.least(F.col("k.speed") * hours * P.SPEED_SCALE, F.lit(P.FRONT_MAX_M))
    if halo is not None:
        best, reach = best.join(halo, "p"), reach + F.col("halo")
    return mask.select("p", "r", "c").union(best.filter(F.sqrt("k.d2") * P.CELL <= reach).select("p", "r1", "c1")).distinct()


def _areas(cells: DataFrame) -> DataFrame:
    return cells.groupBy("p").agg(F.count("*").alias("cells"), F.round(F.count("*") * P.CELL_AREA_KM2, 4).alias("area_km2"))


def projected(spark: SparkSession, sf_dir: str, hours: int, halo: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Masks and projections of the passes whose boundary corresponds well enough with the mask before; halo: its share of
    a pass's characteristic distance."""
    m, b, s, share = _front(spark, sf_dir)
    well = share.filter(F.col("fraction") >= P.MIN_COHERENT).select("p")
    m = m.join(well, "p", "left_semi")
    wide = characteristic(spark, sf_dir).select("p", (F.col("char_m") * halo).alias("halo")) if halo else None
    return m, project(m, _smoothed(s, b).join(well, "p", "left_semi"), hours, wide)


@query(f"{_FRONT} SELECT p, char_m FROM ch")
def characteristic_by_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return characteristic(spark, sf_dir)


@query(_projected(1, 0.0))
def front_projection_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(projected(spark, sf_dir, 1)[1])


@query(_projected(3, 0.0))
def front_projection_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(projected(spark, sf_dir, 3)[1])


@query(_projected(1, P.UNCERTAINTY_FACTOR))
def front_uncertainty_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(projected(spark, sf_dir, 1, P.UNCERTAINTY_FACTOR)[1])


@query(_projected(3, P.UNCERTAINTY_FACTOR))
def front_uncertainty_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(projected(spark, sf_dir, 3, P.UNCERTAINTY_FACTOR)[1])


def confidence(gap: Column, n: Column, fraction: Column) -> Column:
    """The levels, by fixed limits on gap, the smaller number of observations of the two passes, and coherence."""
    return F.when((gap <= 1.5) & (n >= 50) & (fraction >= 0.60), "élevée").when((gap <= 3) & (n >= 20) & (fraction >= 0.40), "moyenne").otherwise("faible")


_LEVEL = "CASE WHEN fraction IS NULL OR fraction < 0.25 OR gap IS NULL OR gap <= 0 OR gap > 3 OR n < 10 OR n_prev < 10 THEN 'indisponible' WHEN gap <= 1.5 AND least(n, n_prev) >= 50 AND fraction >= 0.60 THEN 'élevée' WHEN gap <= 3 AND least(n, n_prev) >= 20 AND fraction >= 0.40 THEN 'moyenne' ELSE 'faible' END"


@query(f"{_FRONT} SELECT od.p, {_LEVEL} AS level FROM od LEFT JOIN fr USING (p)")
def projection_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = pass_order(spark, sf_dir).join(_front(spark, sf_dir)[3], "p", "left")
    usable = _usable() & (F.col("fraction") >= P.MIN_COHERENT)
    return o.select("p", F.when(F.coalesce(usable, F.lit(False)), confidence(F.col("gap"), F.least("n", "n_prev"), F.col("fraction"))).otherwise("indisponible").alias("level"))


@query(_projected(1, 0.0, f", lv AS (SELECT od.p, {_LEVEL} AS level FROM od LEFT JOIN fr USING (p)), sz AS (SELECT p, count(*) AS n FROM pj GROUP BY p), sm2 AS (SELECT p, count(*) AS n FROM mk GROUP BY p) SELECT lv.p, level, coalesce(level IN ('moyenne', 'élevée') AND sz.n <> sm2.n, false) AS displayed FROM lv LEFT JOIN sz USING (p) LEFT JOIN sm2 USING (p)"))
def projection_displayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a pass's projection is shown; it holds the mask, so that it differs where it has more cells."""
    m, ahead = projected(spark, sf_dir, 1)
    before, after = (t.groupBy("p").agg(F.count("*").alias(n)) for t, n in ((m, "cells"), (ahead, "ahead")))
    found = projection_confidence(spark, sf_dir).join(before, "p", "left").join(after, "p", "left")
    return found.select("p", "level", F.coalesce(classify.displayed(F.col("level"), F.col("ahead"), F.col("cells")), F.lit(False)).alias("displayed"))


@query()
def progression_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression.counts(progressed(spark, sf_dir))


def progressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step(spark, "progression", f"{sf_dir}/events.parquet", lambda: progression.progression(masks(spark, sf_dir), pass_order(spark, sf_dir).select("p", "hours")))


@query()
def progression_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and area of each category of each pass, observed_front being the union of the other four."""
    c = progression.categories(progressed(spark, sf_dir)).groupBy("p", "category").agg(F.count("*").alias("cells"))
    return c.select("p", "category", "cells", F.bround(F.col("cells") * P.CELL_AREA_KM2, 3).alias("area_km2"))


@query()
def candidate_confirmation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression_stats(spark, sf_dir).filter("provisional + confirmed + pending + expired > 0").select("p", "provisional", "confirmed", "pending", "expired")


_ARRIVAL = f"{_MASK}, ar AS (SELECT r, c, min(p) AS first_p FROM mk GROUP BY r, c)"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks(spark, sf_dir).groupBy("r", "c").agg(F.min("p").alias("first_p"))


@query(f"{_ARRIVAL} SELECT r, c, first_p FROM ar")
def arrival_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(spark, sf_dir)


@query(f"{_ARRIVAL} SELECT first_p, count(*) AS cells, round(count(*) * 0.0625, 4) AS area_km2 FROM ar GROUP BY first_p")
def arrival_step_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals(spark, sf_dir).groupBy("first_p").agg(F.count("*").alias("cells"), F.round(F.count("*") * P.CELL_AREA_KM2, 4).alias("area_km2"))
