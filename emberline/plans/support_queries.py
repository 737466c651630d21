"""Spatio-temporal support, passes, characteristic distances, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..operators import passes
from ..operators.components import linked_clusters
from ..operators.neighbours import neighbour_counts, pairs_within, with_neighbours
from ..sources.detections import VIEW_SQL, detections
from ..sources.tables import growing, step
from .registry import query

D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"


def _radius(r: dict[str, int]) -> str:
    return f"(CASE WHEN a.instrument = 'MODIS' THEN {r['MODIS'] ** 2} ELSE {r['VIIRS'] ** 2} END)"


_SAME = f"same AS (SELECT a.id, count(b.id) AS n FROM det a LEFT JOIN det b ON a.m = b.m AND a.id <> b.id AND {D2} <= {_radius(P.SAME_PASS_RADIUS)} GROUP BY a.id)"
_TEMPORAL = f"temporal AS (SELECT a.id, count(b.id) AS n, count(b.id) FILTER (WHERE b.m < a.m) AS past FROM det a LEFT JOIN det b ON b.m BETWEEN a.m - {P.TEMPORAL_MINUTES} AND a.m + {P.TEMPORAL_MINUTES} AND a.m <> b.m AND {D2} <= {_radius(P.TEMPORAL_RADIUS)} GROUP BY a.id)"
_CLASSES = f"WITH {VIEW_SQL}, {_SAME}, {_TEMPORAL}, c AS (SELECT det.*, CASE WHEN same.n > 0 THEN 'same_pass' WHEN temporal.n > 0 THEN 'temporal_only' ELSE 'isolated' END AS support_class, CASE WHEN same.n > 0 THEN 'same_pass' WHEN temporal.past > 0 THEN 'past_confirmed' ELSE 'isolated' END AS causal_class FROM det JOIN same USING (id) JOIN temporal USING (id))"


def same_pass(det: DataFrame) -> DataFrame:
    return neighbour_counts(det, P.SAME_PASS_RADIUS, on="m").select("id", "n")


def temporal(det: DataFrame, past_only: bool = False) -> DataFrame:
    both = neighbour_counts(det, P.TEMPORAL_RADIUS, minutes=P.TEMPORAL_MINUTES)
    return both.select("id", F.col("past" if past_only else "n").alias("n"))


def supported(det: DataFrame) -> DataFrame:
    """det with support_class and causal_class. Classes ask only whether there are neighbours, not how many."""
    same = with_neighbours(det, P.SAME_PASS_RADIUS, on="m").select("id", F.col("near").alias("same"))
    around = with_neighbours(det, P.TEMPORAL_RADIUS, minutes=P.TEMPORAL_MINUTES)
    both = det.join(growing(same), "id").join(growing(around), "id")
    both = both.withColumn("support_class", F.when(F.col("same"), "same_pass").when(F.col("near"), "temporal_only").otherwise("isolated"))
    return both.withColumn("causal_class", F.when(F.col("same"), "same_pass").when(F.col("past"), "past_confirmed").otherwise("isolated")).drop("same", "near", "past")


def support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view's detections with their classes, written once as most steps start from them."""
    return step(spark, "support", f"{sf_dir}/events.parquet", lambda: supported(detections(spark, sf_dir)))


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes with their nearest-neighbour distances, written once."""
    return step(spark, "pass-distances", f"{sf_dir}/events.parquet", lambda: passes.nearest_stats(passes.sessionize(detections(spark, sf_dir))))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cluster), written once."""
    return step(spark, "clusters", f"{sf_dir}/events.parquet", lambda: linked_clusters(detections(spark, sf_dir), P.CLUSTER_RADIUS))


@query(f"WITH {VIEW_SQL}, {_SAME} SELECT id, n FROM same")
def same_pass_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_pass(detections(spark, sf_dir))


@query(f"WITH {VIEW_SQL}, {_TEMPORAL} SELECT id, n FROM temporal")
def temporal_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal(detections(spark, sf_dir))


@query(f"WITH {VIEW_SQL}, {_TEMPORAL} SELECT id, past AS n FROM temporal")
def past_temporal_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal(detections(spark, sf_dir), past_only=True)


@query(f"{_CLASSES} SELECT support_class, count(*) AS n, round(sum(CASE support_class WHEN 'same_pass' THEN 1.0 WHEN 'temporal_only' THEN 0.75 ELSE 0.25 END), 2) AS weight FROM c GROUP BY support_class")
def support_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.classify import mapped

    s = support(spark, sf_dir)
    return s.groupBy("support_class").agg(F.count("*").alias("n"), F.round(F.sum(mapped(F.col("support_class"), P.SUPPORT_WEIGHT, 0.25)), 2).alias("weight"))


@query(f"{_CLASSES} SELECT causal_class, count(*) AS n FROM c GROUP BY causal_class")
def causal_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support(spark, sf_dir).groupBy("causal_class").agg(F.count("*").alias("n"))


@query(f"{_CLASSES} SELECT count(*) FILTER (WHERE support_class = 'temporal_only' AND causal_class = 'isolated') AS future_only, count(*) AS n FROM c")
def future_only_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = support(spark, sf_dir)
    return s.agg(F.count_if((F.col("support_class") == "temporal_only") & (F.col("causal_class") == "isolated")).alias("future_only"), F.count("*").alias("n"))


_PASSES = f"WITH {VIEW_SQL}, g AS (SELECT *, m - lag(m) OVER (PARTITION BY satellite, instrument ORDER BY m) AS gap FROM det), s AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > {P.PASS_GAP_MINUTES} THEN 1 ELSE 0 END) OVER (PARTITION BY satellite, instrument ORDER BY m) AS seq FROM g), p AS (SELECT *, satellite || '_' || instrument || '_' || printf('%03d', CAST(seq AS BIGINT)) AS pass_id FROM s), sm AS (SELECT pass_id, any_value(satellite) AS satellite, any_value(instrument) AS instrument, CAST(min(m) AS BIGINT) AS first_m, CAST(max(m) AS BIGINT) AS last_m, count(*) AS n FROM p GROUP BY pass_id)"


@query(f"{_PASSES} SELECT id, pass_id FROM p")
def passes_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.sessionize(detections(spark, sf_dir)).select("id", "pass_id")


@query(f"{_PASSES} SELECT pass_id, first_m, last_m, n FROM sm")
def pass_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.summary(passes.sessionize(detections(spark, sf_dir))).select("pass_id", "first_m", "last_m", "n")


@query(f"{_PASSES} SELECT id, (first_m + last_m) / 2.0 AS pass_minute FROM p JOIN sm USING (pass_id)")
def pass_midpoint_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.with_midpoint(passes.sessionize(detections(spark, sf_dir))).select("id", F.col("mid").alias("pass_minute"))


_NN = f"{_PASSES}, nn AS (SELECT a.pass_id, a.id, sqrt(min({D2})) AS d FROM p a LEFT JOIN p b ON a.pass_id = b.pass_id AND a.id <> b.id GROUP BY a.pass_id, a.id), st AS (SELECT sm.*, (first_m + last_m) / 2.0 AS mid, q.* EXCLUDE (pass_id) FROM sm JOIN (SELECT pass_id, avg(d) AS mean, quantile_cont(d, 0.5) AS med, quantile_cont(d, 0.75) AS p75, quantile_cont(d, 0.9) AS p90 FROM nn GROUP BY pass_id) q USING (pass_id))"


@query(f"{_NN} SELECT pass_id, n, round(mean, 4) AS nn_mean_m, round(med, 4) AS nn_median_m, round(p75, 4) AS nn_p75_m, round(p90, 4) AS nn_p90_m FROM st")
def pass_nn_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = distances(spark, sf_dir)
    return s.select("pass_id", "n", *[F.round(a, 4).alias(b) for a, b in (("mean", "nn_mean_m"), ("med", "nn_median_m"), ("p75", "nn_p75_m"), ("p90", "nn_p90_m"))])


@query(f"{_NN} SELECT instrument, count(*) AS passes, round(quantile_cont(med, 0.5), 4) AS median_of_median, round(quantile_cont(p75, 0.5), 4) AS median_of_p75, round(quantile_cont(p75, 0.9), 4) AS p90_of_p75 FROM st GROUP BY instrument")
def instrument_nn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = distances(spark, sf_dir)
    return s.groupBy("instrument").agg(F.count("*").alias("passes"), F.round(F.percentile("med", 0.5), 4).alias("median_of_median"), F.round(F.percentile("p75", 0.5), 4).alias("median_of_p75"), F.round(F.percentile("p75", 0.9), 4).alias("p90_of_p75"))


@query(f"{_NN} SELECT pass_id, round((mid - lag(mid) OVER (ORDER BY mid, pass_id)) / 60, 6) AS gap_previous_h FROM st")
def pass_gap_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passes.with_gap(passes.summary(passes.sessionize(detections(spark, sf_dir)))).select("pass_id", F.round("gap_h", 6).alias("gap_previous_h"))


_lo, _hi, _ref = ("CASE WHEN instrument = 'MODIS' THEN {} ELSE {} END".format(m, v) for m, v in ((700.0, 300.0), (1500.0, 800.0), (1112.0, 430.0)))
_REG = f"{_NN}, rg AS (SELECT pass_id, instrument, CASE WHEN p75 IS NULL THEN 0.0 ELSE n / (n + 30.0) END AS w, coalesce(greatest({_lo}, least({_hi}, greatest(250.0, least(2000.0, p75)))), 0.0) AS raw, {_ref} AS ref, p75 FROM st), rd AS (SELECT pass_id, instrument, bround AS distance, w, p75 FROM (SELECT *, round(w * raw + (1 - w) * ref, 4) AS bround FROM rg))"


@query(f"{_REG} SELECT pass_id, distance AS distance_regularized_m, round(w, 6) AS pass_weight, CASE WHEN p75 IS NULL THEN 'instrument_fallback' ELSE 'pass_shrunk' END AS distance_source FROM rd")
def distance_regularized(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = passes.regularize(distances(spark, sf_dir))
    return r.select("pass_id", F.round("distance", 4).alias("distance_regularized_m"), F.round("weight", 6).alias("pass_weight"), "distance_source")


@query(f"{_REG} SELECT instrument, count(*) AS n, round(quantile_cont(distance, 0.5), 3) AS median_m, round(min(distance), 3) AS min_m, round(max(distance), 3) AS max_m FROM rd GROUP BY instrument")
def regularized_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = passes.regularize(distances(spark, sf_dir)).withColumn("distance", F.round("distance", 4))
    return r.groupBy("instrument").agg(F.count("*").alias("n"), F.round(F.percentile("distance", 0.5), 3).alias("median_m"), F.round(F.min("distance"), 3).alias("min_m"), F.round(F.max("distance"), 3).alias("max_m"))


@query(f"WITH {VIEW_SQL} SELECT a.id, count(*) AS n FROM det a JOIN det b ON a.id < b.id AND abs(a.x - b.x) <= 750 AND {D2} <= 562500 GROUP BY a.id")
def radius_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).select("id", "x", "y")
    return pairs_within(d, d, F.lit(P.CLUSTER_RADIUS), P.CLUSTER_RADIUS).filter("id < r_id").groupBy("id").agg(F.count("*").alias("n"))


_CELLS = f"""WITH RECURSIVE {VIEW_SQL}, pt AS (SELECT id, x, y, x // 530 AS cx, y // 530 AS cy FROM det), cell AS (SELECT cx, cy, min(id) AS node FROM pt GROUP BY cx, cy),
link AS (SELECT DISTINCT ca.node AS src, cb.node AS dst FROM (SELECT DISTINCT a.cx AS ax, a.cy AS ay, b.cx AS bx, b.cy AS byy FROM pt a JOIN (SELECT i, j FROM range(-2, 3) t(i), range(-2, 3) u(j)) o ON true JOIN pt b ON b.cx = a.cx + o.i AND b.cy = a.cy + o.j AND {D2} <= 562500) z JOIN cell ca ON ca.cx = ax AND ca.cy = ay JOIN cell cb ON cb.cx = bx AND cb.cy = byy),
reach(root, node) AS (SELECT node, node FROM cell UNION SELECT r.root, link.dst FROM reach r JOIN link ON link.src = r.node WHERE link.dst > r.root),
lab AS (SELECT node, min(root) AS cluster FROM reach GROUP BY node), cl AS (SELECT pt.id, cluster FROM pt JOIN cell USING (cx, cy) JOIN lab ON lab.node = cell.node)"""


@query(f"{_CELLS} SELECT cluster, count(*) AS n FROM cl GROUP BY cluster")
def cell_graph_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(spark, sf_dir).groupBy("cluster").agg(F.count("*").alias("n"))


@query(f"{_CELLS}, k AS (SELECT cluster, count(*) AS n FROM cl GROUP BY cluster HAVING count(*) >= 15) SELECT row_number() OVER (ORDER BY n DESC, cluster) AS cluster_id, cluster, n FROM k ORDER BY n DESC, cluster LIMIT 2")
def top_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters_ranked(clusters(spark, sf_dir))


def clusters_ranked(clusters: DataFrame) -> DataFrame:
    """The largest clusters of CLUSTER_MIN points or more, numbered from 1."""
    big = clusters.groupBy("cluster").agg(F.count("*").alias("n")).filter(F.col("n") >= P.CLUSTER_MIN).orderBy(F.desc("n"), "cluster").limit(P.CLUSTER_MAX)
    return big.select(F.row_number().over(Window.orderBy(F.desc("n"), "cluster")).cast("long").alias("cluster_id"), "cluster", "n")


