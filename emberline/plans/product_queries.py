"""Envelopes, land mask, audit and export on the `events` view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..operators import envelopes, grid, shapes
from ..sources.detections import detections
from ..sources.tables import materialize, step
from .grid_queries import _ARRIVAL, _MASK, arrivals, masks
from .registry import query
from .support_queries import _CELLS, D2, clusters

#: su: supported by their pass; ct: all that count, by reaching from those to later points in range; st: running counts.
_SUPPORTED = f"""{_CELLS}, su AS (SELECT a.id FROM det a JOIN det b ON a.slot = b.slot AND a.id <> b.id AND {D2} <= 4000000 GROUP BY a.id),
cp AS (SELECT cluster, det.id, m, x, y, satellite, instrument, CASE instrument WHEN 'MODIS' THEN 3750 ELSE 3300 END AS reach, det.id IN (SELECT id FROM su) AS sup FROM cl JOIN det USING (id)),
ct AS (SELECT id FROM cp WHERE sup UNION SELECT u.id FROM ct JOIN cp v ON v.id = ct.id JOIN cp u ON u.cluster = v.cluster AND NOT u.sup AND (v.m, v.satellite, v.instrument, v.id) < (u.m, u.satellite, u.instrument, u.id) AND (u.x - v.x) * (u.x - v.x) + (u.y - v.y) * (u.y - v.y) <= v.reach * v.reach),
st AS (SELECT cluster, CAST(m AS BIGINT) AS m, CAST(sum(count(*)) OVER (PARTITION BY cluster ORDER BY m) AS BIGINT) AS n FROM cl JOIN ct USING (id) JOIN det USING (id) GROUP BY cluster, m)"""


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir)
    return d.join(clusters(spark, sf_dir), "id")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections that count towards their cluster's envelope, with the cluster, written once."""

    def build() -> DataFrame:
        d = _clustered(spark, sf_dir)
        near = envelopes.same_pass_supported(d).select("id", F.lit(True).alias("supported"))
        ids = envelopes.counted(d.join(near, "id", "left").withColumn("supported", F.coalesce("supported", F.lit(False))))
        return d.join(ids.select("id"), "id", "left_semi")

    return step(spark, "counted", f"{sf_dir}/events.parquet", build)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = counted(spark, sf_dir).groupBy("cluster", F.col("m").cast("long").alias("m")).agg(F.count("*").alias("k"))
    return per.select("cluster", "m", F.sum("k").over(Window.partitionBy("cluster").orderBy("m")).alias("n"))


@query(f"{_SUPPORTED} SELECT id FROM su")
def envelope_supported_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.same_pass_supported(detections(spark, sf_dir)).select("id")


@query(f"{_SUPPORTED} SELECT cluster, id, m, row_number() OVER (PARTITION BY cluster ORDER BY m, satellite, instrument, id) AS n FROM cp JOIN ct USING (id)")
def envelope_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = counted(spark, sf_dir).select("cluster", "id", "m", "x", "y", "satellite", "instrument", F.lit(True).alias("supported"))
    return envelopes.states(d)


@query(f"{_SUPPORTED}, sn AS (SELECT cluster, min(m) AS a, max(m) AS b FROM st GROUP BY cluster), tg AS (SELECT DISTINCT cluster, target FROM (SELECT cluster, b, unnest(range(a, b, 360)) AS target FROM sn UNION ALL SELECT cluster, b, b FROM sn)), ao AS (SELECT tg.cluster, target, max(st.m) AS m FROM tg JOIN st ON st.cluster = tg.cluster AND st.m <= target GROUP BY tg.cluster, target), ch AS (SELECT *, lag(m) OVER (PARTITION BY cluster ORDER BY target) AS before FROM ao) SELECT ch.cluster, target, ch.m, n FROM ch JOIN st ON st.cluster = ch.cluster AND st.m = ch.m WHERE before IS NULL OR before <> ch.m")
def snapshot_6h_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.snapshots(_states(spark, sf_dir))


@query(f"{_SUPPORTED}, cut AS (SELECT unnest(range((SELECT min(m) FROM det) + 360, (SELECT max(m) FROM det) + 720, 720)) AS cutoff) SELECT cluster, CAST(cutoff AS BIGINT) AS cutoff, max(m) AS m, max(n) AS n FROM st JOIN cut ON st.m <= cutoff GROUP BY cluster, cutoff")
def extent_asof_per_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = detections(spark, sf_dir).agg(F.min("m").cast("long").alias("a"), F.max("m").cast("long").alias("b"))
    steps = F.sequence(F.col("a") + 360, F.col("b") + 719, F.lit(720).cast("long"))
    cutoffs = span.select(F.explode(steps).alias("cutoff"))  # two a day
    s = _states(spark, sf_dir).join(F.broadcast(cutoffs), F.col("m") <= F.col("cutoff"))
    return s.groupBy("cluster", "cutoff").agg(F.max("m").alias("m"), F.max("n").alias("n"))


@query(f"{_SUPPORTED}, cut AS (SELECT unnest(range((SELECT min(m) FROM det) + 360, (SELECT max(m) FROM det) + 720, 720)) AS cutoff), e AS (SELECT cluster, cutoff, max(m) AS m FROM st JOIN cut ON st.m <= cutoff GROUP BY cluster, cutoff), l AS (SELECT *, lag(m) OVER (PARTITION BY cluster ORDER BY cutoff) AS before FROM e) SELECT cluster, CAST(cutoff AS BIGINT) AS cutoff, m FROM l WHERE before IS NULL OR before <> m")
def extent_change_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = extent_asof_per_cluster(spark, sf_dir)
    return e.withColumn("before", F.lag("m").over(Window.partitionBy("cluster").orderBy("cutoff"))).filter("before IS NULL OR before != m").select("cluster", "cutoff", "m")


#: Cells of 2 km, so that clusters overlap; the run before is what was there a day before the end, named by its own smallest
#: detection, plus 1 for every other cluster so that most names change.
_CC = f"{_CELLS}, fin AS (SELECT max(m) AS b FROM det), pc AS (SELECT cluster, id, m, x // 2000 AS c, y // 2000 AS r FROM cl JOIN det USING (id)), nw AS (SELECT DISTINCT cluster, r, c FROM pc), ol AS (SELECT DISTINCT min(id) OVER (PARTITION BY cluster) + cluster % 2 AS cluster, r, c FROM pc, fin WHERE m <= b - 1440)"
_OV = f"{_CC}, bo AS (SELECT cluster, count(*) AS n, min(r) + max(r) AS y, min(c) + max(c) AS x FROM ol GROUP BY cluster), bn AS (SELECT cluster, count(*) AS n, min(r) + max(r) AS y, min(c) + max(c) AS x FROM nw GROUP BY cluster), ov AS (SELECT s.*, cells / (bo.n + bn.n - cells) AS iou, (bo.x - bn.x) * (bo.x - bn.x) + (bo.y - bn.y) * (bo.y - bn.y) AS apart FROM (SELECT ol.cluster AS old_cluster, nw.cluster AS new_cluster, count(*) AS cells FROM ol JOIN nw USING (r, c) GROUP BY ALL) s JOIN bo ON bo.cluster = old_cluster JOIN bn ON bn.cluster = new_cluster)"
#: Greedy by rank: a pair is taken if no pair taken before has one of its sides.
_PAIRS = f"{_OV}, rk AS (SELECT *, row_number() OVER (ORDER BY cells DESC, iou DESC, old_cluster DESC, new_cluster DESC) AS k FROM ov), gr AS (SELECT 0 AS k, CAST([] AS BIGINT[]) AS o, CAST([] AS BIGINT[]) AS w UNION ALL SELECT gr.k + 1, CASE WHEN t THEN list_append(o, old_cluster) ELSE o END, CASE WHEN t THEN list_append(w, new_cluster) ELSE w END FROM (SELECT gr.*, rk.old_cluster, rk.new_cluster, NOT (list_contains(o, rk.old_cluster) OR list_contains(w, rk.new_cluster)) AS t FROM gr JOIN rk ON rk.k = gr.k + 1) gr), mt AS (SELECT unnest(o) AS old_cluster, unnest(w) AS new_cluster FROM (SELECT * FROM gr ORDER BY k DESC LIMIT 1))"


def _cluster_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = materialize(_clustered(spark, sf_dir).select("cluster", "id", "m", F.floor(F.col("x") / 2000).alias("c"), F.floor(F.col("y") / 2000).alias("r")), "cluster-cells")
    before = c.crossJoin(F.broadcast(c.agg(F.max("m").alias("b")))).filter("m <= b - 1440")  # a single row
    names = before.groupBy("cluster").agg((F.min("id") + F.col("cluster") % 2).alias("name"))
    old = before.join(names, "cluster").select(F.col("name").alias("cluster"), "r", "c").distinct()
    return old, c.select("cluster", "r", "c").distinct()


@query(f"{_OV} SELECT old_cluster, arg_max(new_cluster, (cells, -apart, new_cluster)) AS new_cluster, max(cells) AS cells FROM ov GROUP BY old_cluster")
def cluster_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.best_match(envelopes.overlaps(*_cluster_cells(spark, sf_dir)))


@query(f"{_PAIRS} SELECT new_cluster, old_cluster FROM mt")
def cluster_id_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-to-one, greedily by shared cells, intersection over union and ids."""
    return envelopes.match_one_to_one(envelopes.overlaps(*_cluster_cells(spark, sf_dir)))


@query(f"{_PAIRS}, um AS (SELECT cluster, row_number() OVER (ORDER BY cluster) AS k FROM (SELECT DISTINCT cluster FROM nw) WHERE cluster NOT IN (SELECT new_cluster FROM mt)), fb AS (SELECT 0 AS k, (SELECT coalesce(list(old_cluster), CAST([] AS BIGINT[])) FROM mt) AS used, CAST(0 AS BIGINT) AS cluster, CAST(0 AS BIGINT) AS id UNION ALL SELECT k, list_append(used, id), cluster, id FROM (SELECT um.k, used, um.cluster, CASE WHEN list_contains(used, um.cluster) THEN list_min(list_filter(range(1, len(used) + 2), lambda v: NOT list_contains(used, v))) ELSE um.cluster END AS id FROM fb JOIN um ON um.k = fb.k + 1)) SELECT cluster AS new_cluster, id, CASE WHEN id = cluster THEN 'own' ELSE 'free' END AS how FROM fb WHERE k > 0 UNION ALL SELECT new_cluster, old_cluster, 'matched' FROM mt")
def cluster_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _cluster_cells(spark, sf_dir)
    return envelopes.assign_ids(new.select("cluster").distinct(), envelopes.match_one_to_one(envelopes.overlaps(old, new)))


_RUNS = f"{_CELLS}, fin AS (SELECT max(m) AS b FROM det), pc AS (SELECT cluster, m, instrument, x // 250 AS c, y // 250 AS r FROM cl JOIN det USING (id)), nw AS (SELECT cluster, r, c, min(m) AS m FROM pc WHERE instrument = 'VIIRS' OR m > (SELECT b - 1440 FROM fin) GROUP BY ALL), ol AS (SELECT cluster, r, c, min(m) AS m FROM pc WHERE m <= (SELECT b - 1440 FROM fin) GROUP BY ALL), fl AS (SELECT cluster, r, c, min(m) AS m FROM (FROM nw UNION ALL FROM ol) GROUP BY ALL)"


@query(f"{_RUNS} SELECT cluster, m, CAST(sum(count(*)) OVER (PARTITION BY cluster ORDER BY m) AS BIGINT) AS cells FROM fl GROUP BY cluster, m")
def monotone_floor_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of each cluster over time: those of a run that lost an instrument's early detections, never below those of the
    run a day before."""
    c = _clustered(spark, sf_dir).select("cluster", "m", "instrument", F.floor(F.col("x") / P.CELL).alias("c"), F.floor(F.col("y") / P.CELL).alias("r"))
    c = materialize(c.crossJoin(F.broadcast(detections(spark, sf_dir).agg((F.max("m") - 1440).alias("b")))), "runs")  # a single row
    new, old = (c.filter(w).groupBy("cluster", "r", "c").agg(F.min("m").cast("long").alias("m")) for w in ("instrument = 'VIIRS' OR m > b", "m <= b"))
    grown = envelopes.monotone_floor(new, old).groupBy("cluster", "m").agg(F.count("*").alias("k"))
    return grown.select("cluster", "m", F.sum("k").over(Window.partitionBy("cluster").orderBy("m")).alias("cells"))


#: A synthetic land cover: class 80 (water) in fine cells, 5 to a cell's side.
_WATER = "((((r * 5 + i) // 9) * 7 + ((c * 5 + j) // 9) * 13) % 17 < 6)"
_LAND = f"{_ARRIVAL}, fi AS (SELECT r, c, i, j, CASE WHEN {_WATER} THEN 80 ELSE 10 END AS class FROM ar JOIN (SELECT i, j FROM range(0, 5) t(i), range(0, 5) u(j)) o ON true), lf AS (SELECT r, c, avg(CASE WHEN class IN (0, 80) THEN 0.0 ELSE 1.0 END) AS land FROM fi GROUP BY r, c)"


def _fine(cells: DataFrame) -> DataFrame:
    f = cells.select("r", "c", grid.offsets([(i, j) for i in range(5) for j in range(5)])).select("r", "c", (F.col("r") * 5 + F.col("o.dr")).alias("fr"), (F.col("c") * 5 + F.col("o.dc")).alias("fc"))
    water = (F.floor(F.col("fr") / 9) * 7 + F.floor(F.col("fc") / 9) * 13) % 17 < 6
    return f.withColumn("class", F.when(water, 80).otherwise(10))


def _is_land() -> Column:
    return (~F.col("class").isin(0, 80)).cast("double")


def land_fraction(cells: DataFrame) -> DataFrame:
    return _fine(cells).groupBy("r", "c").agg(F.avg(_is_land()).alias("land"))


@query(f"{_LAND} SELECT r, c, round(land, 6) AS land FROM lf")
def land_fraction_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land_fraction(arrivals(spark, sf_dir)).select("r", "c", F.round("land", 6).alias("land"))


@query(f"{_LAND} SELECT p, count(*) AS cells, count(*) FILTER (WHERE land >= 0.5) AS land_cells FROM mk JOIN lf USING (r, c) GROUP BY p")
def land_mask_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = masks(spark, sf_dir)
    return m.join(land_fraction(m.select("r", "c").distinct()), ["r", "c"]).groupBy("p").agg(F.count("*").alias("cells"), F.count_if(F.col("land") >= P.LAND_FRACTION).alias("land_cells"))


@query(f"{_LAND} SELECT t AS threshold, round(count(*) FILTER (WHERE land < t) * 0.0625, 4) AS removed_km2 FROM lf CROSS JOIN (VALUES (0.1), (0.25), (0.5), (0.75)) v(t) GROUP BY t".replace("SELECT t AS threshold", "SELECT CAST(t AS DOUBLE) AS threshold"))
def mask_threshold_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = land_fraction(arrivals(spark, sf_dir)).select("land", F.explode(F.array(*[F.lit(t) for t in (0.10, 0.25, 0.50, 0.75)])).alias("threshold"))
    return f.groupBy("threshold").agg(F.round(F.count_if(F.col("land") < F.col("threshold")) * P.CELL_AREA_KM2, 4).alias("removed_km2"))


@query(f"{_LAND}, bn AS (SELECT s, (r * 5 + i) // s AS br, (c * 5 + j) // s AS bc, avg(CASE WHEN class IN (0, 80) THEN 0.0 ELSE 1.0 END) AS land, count(*) AS n FROM fi CROSS JOIN (VALUES (1), (2), (5)) v(s) GROUP BY 1, 2, 3) SELECT CAST(s AS BIGINT) AS side, count(*) AS bins, round(sum(CASE WHEN land < 0.5 THEN n ELSE 0 END) * 0.0025, 4) AS removed_km2 FROM bn GROUP BY s")
def mask_resolution_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fine(arrivals(spark, sf_dir)).select("fr", "fc", "class", F.explode(F.array(*[F.lit(s) for s in (1, 2, 5)])).alias("side"))
    b = f.groupBy("side", F.floor(F.col("fr") / F.col("side")).alias("br"), F.floor(F.col("fc") / F.col("side")).alias("bc")).agg(F.avg(_is_land()).alias("land"), F.count("*").alias("n"))
    return b.groupBy(F.col("side").cast("long").alias("side")).agg(F.count("*").alias("bins"), F.round(F.sum(F.when(F.col("land") < 0.5, F.col("n")).otherwise(0)) * 0.0025, 4).alias("removed_km2"))


_WET = f"{_LAND.replace('ar AS (SELECT', 'ar AS (SELECT', 1)}, wt AS (SELECT r * 5 + i AS fr, c * 5 + j AS fc, (r * 5 + i) * 100000 + c * 5 + j AS k FROM fi WHERE class = 80), wr(root, k) AS (SELECT k, k FROM wt UNION SELECT q.root, wt.k FROM wr q JOIN wt ON wt.k > q.root AND (wt.k = q.k + 1 OR wt.k = q.k - 1 OR wt.k = q.k + 100000 OR wt.k = q.k - 100000)), wl AS (SELECT k, min(root) AS label FROM wr GROUP BY k)"


def water_bodies(fine: DataFrame, least: int = 16) -> DataFrame:
    """(fr, fc) of water in connected bodies of at least so many fine cells; fine: (fr, fc, class)."""
    from ..operators.components import connected_components

    w = materialize(fine.filter("class = 80").select((F.col("fr") * 100_000 + F.col("fc")).alias("k")), "water")
    step = w.select(F.col("k").alias("src"), F.explode(F.array(F.col("k"), F.col("k") + 1, F.col("k") + 100_000)).alias("dst"))
    parts = materialize(connected_components(step.join(w.withColumnRenamed("k", "dst"), "dst").select("src", "dst")), "water-parts")
    large = parts.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return parts.join(large, "component").select(F.floor(F.col("node") / 100_000).alias("fr"), (F.col("node") % 100_000).alias("fc"), F.col("component").alias("body"))


@query(f"{_WET} SELECT count(*) AS bodies, CAST(sum(n) AS BIGINT) AS cells FROM (SELECT label, count(*) AS n FROM wl GROUP BY label HAVING count(*) >= 16)")
def water_component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Water bodies of a hectare (16 fine cells) or more that meet the burnt surface."""
    return water_bodies(_fine(arrivals(spark, sf_dir))).agg(F.countDistinct("body").alias("bodies"), F.count("*").alias("cells"))


@query(f"{_WET}, wb AS (SELECT k FROM wl WHERE label IN (SELECT label FROM wl GROUP BY label HAVING count(*) >= 16)) SELECT first_p, count(*) AS fine_cells, round(count(*) * 0.0025, 4) AS area_km2 FROM (SELECT ar.first_p, (fi.r * 5 + i) * 100000 + fi.c * 5 + j AS k FROM fi JOIN ar USING (r, c)) WHERE k NOT IN (SELECT k FROM wb) GROUP BY first_p")
def water_component_subtraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each pass's newly burnt cells keep when large water bodies are taken off: never more than they had."""
    a = materialize(arrivals(spark, sf_dir), "arrivals")
    fine = _fine(a)
    left = fine.join(water_bodies(fine), ["fr", "fc"], "left_anti").join(a, ["r", "c"])
    return left.groupBy("first_p").agg(F.count("*").alias("fine_cells"), F.round(F.count("*") * 0.0025, 4).alias("area_km2"))


_AUDIT = f"{_MASK}, aw AS (SELECT p, r, c, CASE WHEN (r + c) % 2 = 0 THEN 'advance' ELSE 'persistence' END AS category FROM mk), o AS (SELECT category, p, count(*) AS n FROM aw WHERE p % 10 <> 0 GROUP BY ALL), n AS (SELECT category, p, count(*) AS n FROM aw WHERE p % 10 <> 1 AND r % 50 <> 0 GROUP BY ALL)"


def _exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(category, p, old_n, new_n): an export before and after a change, joined on their key."""
    a = masks(spark, sf_dir).withColumn("category", F.when((F.col("r") + F.col("c")) % 2 == 0, "advance").otherwise("persistence"))
    old = a.filter("p % 10 != 0").groupBy("category", "p").agg(F.count("*").alias("old_n"))
    new = a.filter("p % 10 != 1 AND r % 50 != 0").groupBy("category", "p").agg(F.count("*").alias("new_n"))
    return old.join(new, ["category", "p"], "full_outer")


@query(f"{_AUDIT} SELECT CASE WHEN o.n IS NULL THEN 'missing_in_old' WHEN n.n IS NULL THEN 'missing_in_new' ELSE 'common' END AS side, count(*) AS n FROM o FULL JOIN n USING (category, p) GROUP BY 1")
def audit_key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("old_n").isNull(), "missing_in_old").when(F.col("new_n").isNull(), "missing_in_new").otherwise("common")
    return _exports(spark, sf_dir).groupBy(side.alias("side")).agg(F.count("*").alias("n"))


@query(f"{_AUDIT} SELECT category, count(*) AS features, round(sum(o.n) * 0.0625, 4) AS old_km2, round(sum(n.n) * 0.0625, 4) AS new_km2, round(100.0 * (sum(n.n) - sum(o.n)) / sum(o.n), 4) AS change_percent, round(max(o.n - n.n) * 0.0625, 4) AS max_removed_km2 FROM o JOIN n USING (category, p) GROUP BY category")
def audit_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, (o, n) = P.CELL_AREA_KM2, (F.sum("old_n"), F.sum("new_n"))
    return _exports(spark, sf_dir).dropna(subset=["old_n", "new_n"]).groupBy("category").agg(F.count("*").alias("features"), F.round(o * a, 4).alias("old_km2"), F.round(n * a, 4).alias("new_km2"), F.round(100.0 * (n - o) / o, 4).alias("change_percent"), F.round(F.max(F.col("old_n") - F.col("new_n")) * a, 4).alias("max_removed_km2"))


@query(f"{_AUDIT} SELECT category, p, round((o.n - n.n) * 0.0625, 4) AS removed_km2 FROM o JOIN n USING (category, p) WHERE (o.n - n.n) * 0.0625 > 0.01")
def audit_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = (F.col("old_n") - F.col("new_n")) * P.CELL_AREA_KM2
    return _exports(spark, sf_dir).filter(removed > P.ALERT_KM2).select("category", "p", F.round(removed, 4).alias("removed_km2"))


@query(f"{_AUDIT} SELECT bool_and(o.n IS NOT NULL AND n.n IS NOT NULL) AS same_keys, coalesce(bool_and(n.n <= o.n), true) AS never_grows, coalesce(bool_or(n.n = 0), false) AS any_empty FROM o FULL JOIN n USING (category, p)")
def audit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exports(spark, sf_dir).agg(
        F.every(F.col("old_n").isNotNull() & F.col("new_n").isNotNull()).alias("same_keys"), F.coalesce(F.every(F.col("new_n") <= F.col("old_n")), F.lit(True)).alias("never_grows"), F.coalesce(F.some(F.col("new_n") == 0), F.lit(False)).alias("any_empty")
    )


def front_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, part, rings, cells, gx, gy): the polygons of each pass's mask and the corner of their grid."""
    corner = grid.extent(detections(spark, sf_dir))
    return shapes.polygons(masks(spark, sf_dir)).crossJoin(F.broadcast(corner))  # a single row


@query(f"{_MASK} SELECT p, CAST(count(DISTINCT label) AS BIGINT) AS parts, count(*) AS cells FROM lab JOIN big USING (p, label) GROUP BY p")
def polygon_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each pass's outline; the cells within it by the rings' own area, holes taken off."""
    inside = F.aggregate(F.transform("rings", shapes.ring_area2), F.lit(0).cast("long"), lambda s, v: s + v)
    return shapes.polygons(masks(spark, sf_dir)).withColumn("inside", inside).groupBy("p").agg(F.count("*").alias("parts"), F.sum(F.expr("inside div 2")).alias("cells"))


_ENVELOPE = f"""{_SUPPORTED}, sp AS MATERIALIZED (SELECT cluster, CAST(m AS BIGINT) AS m, x, y, reach - 3000 AS rad FROM cp WHERE id IN (SELECT id FROM ct)),
e0 AS (SELECT cluster, r, c, min(m) AS m FROM (SELECT cluster, m, x, y, rad, y // 50 + i AS r, x // 50 + j AS c FROM sp JOIN range(-16, 17) t(i) ON abs((y // 50 + i) * 50 + 25 - y) <= rad CROSS JOIN range(-16, 17) u(j)) WHERE (r * 50 + 25 - y) * (r * 50 + 25 - y) + (c * 50 + 25 - x) * (c * 50 + 25 - x) <= rad * rad GROUP BY cluster, r, c),
ba AS (SELECT i, j FROM range(-2, 3) t(i), range(-2, 3) u(j) WHERE i * i + j * j <= 4), e1 AS (SELECT cluster, r + i AS r, c + j AS c, min(m) AS m FROM e0 CROSS JOIN ba GROUP BY ALL), e2 AS (SELECT cluster, r + i AS r, c + j AS c, max(m) AS m FROM e1 CROSS JOIN ba GROUP BY ALL HAVING count(*) = 13)"""


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return step(spark, "envelopes", f"{sf_dir}/events.parquet", lambda: shapes.envelope_times(counted(spark, sf_dir).withColumn("m", F.col("m").cast("long"))))


@query(f"{_ENVELOPE} SELECT cluster, m, round(sum(count(*)) OVER (PARTITION BY cluster ORDER BY m) * 0.0025, 4) AS area_km2 FROM e2 GROUP BY cluster, m")
def envelope_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closed envelope's area after each moment at which it grows."""
    grown = _envelope(spark, sf_dir).groupBy("cluster", "m").agg(F.count("*").alias("k"))
    total = F.sum("k").over(Window.partitionBy("cluster").orderBy("m"))
    return grown.select("cluster", "m", F.round(total * (P.ENVELOPE_CELL**2 / 1e6), 4).alias("area_km2"))


@query(f"{_ENVELOPE}, h AS (SELECT cluster, count(*) AS total, count(*) FILTER (WHERE m <= a + 1440) AS day FROM (SELECT cluster, m, min(m) OVER (PARTITION BY cluster) AS a FROM e2) GROUP BY cluster) SELECT cluster, round(day / total, 6) AS iou, round((total - day) * 0.0025, 4) AS added_km2 FROM h")
def envelope_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection over union, and difference, of each cluster's envelope after its first day and at the end."""
    e = _envelope(spark, sf_dir)
    began = e.groupBy("cluster").agg(F.min("m").alias("a"))
    e = e.join(began, "cluster").groupBy("cluster").agg(F.count("*").alias("total"), F.count_if(F.col("m") <= F.col("a") + 1440).alias("day"))
    return e.select("cluster", F.round(F.col("day") / F.col("total"), 6).alias("iou"), F.round((F.col("total") - F.col("day")) * (P.ENVELOPE_CELL**2 / 1e6), 4).alias("added_km2"))
