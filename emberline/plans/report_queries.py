"""Times, checks, guards and reports on the `events` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import classify, times
from ..operators import grid, passes
from ..sources import checks
from ..sources.detections import VIEW_SQL, detections
from .grid_queries import _CELLED, _MASK, _ORDER, masks, pass_order
from .product_queries import _SUPPORTED, _states, counted
from .registry import query
from .support_queries import _PASSES

WITH = f"WITH {VIEW_SQL}"
_SHIFT = "INTERVAL 1 HOUR"  # the local zone's offset from UTC in the days of the view


@query(f"{WITH}, s AS (SELECT slot, min(m) AS m FROM det GROUP BY slot) SELECT slot, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(m AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS utc, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(m AS BIGINT)) + {_SHIFT}, '%Y-%m-%d %H:%M') AS local, round((m - min(m) OVER ()) / 60.0, 6) AS arrival_h, round((max(m) OVER () - m) / 60.0, 6) AS hours_ago FROM s")
def pass_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pass's time as UTC text with Z and as local time, hours since the first and before the last."""
    s = detections(spark, sf_dir).groupBy("slot").agg(F.min("m").alias("m"))
    s = s.crossJoin(F.broadcast(s.agg(F.min("m").alias("m0"), F.max("m").alias("m1"))))  # a single row
    ts = times.at_minute()
    return s.select(
        "slot", times.z_suffix(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))).alias("utc"), F.date_format(times.local(ts.cast("timestamp")), "yyyy-MM-dd HH:mm").alias("local"),
        F.round(times.hours_between(F.col("m"), F.col("m0")), 6).alias("arrival_h"), F.round(times.hours_between(F.col("m1"), F.col("m")), 6).alias("hours_ago"),
    )


_NAMES = "CASE id % 5 WHEN 0 THEN ' viirs_snpp ' WHEN 1 THEN 'Modis' WHEN 2 THEN NULL WHEN 3 THEN 'modis-aqua' ELSE ' abi' END"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("id", F.expr(_NAMES).alias("raw"))


@query(f"{WITH}, n AS (SELECT upper(trim(coalesce({_NAMES}, ''))) AS u FROM det) SELECT CASE WHEN contains(u, 'VIIRS') THEN 'VIIRS' WHEN contains(u, 'MODIS') THEN 'MODIS' ELSE u END AS instrument, count(*) AS n FROM n GROUP BY 1")
def instrument_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).groupBy(classify.normal_instrument(F.col("raw")).alias("instrument")).agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT upper(coalesce({_NAMES}, '')) AS instrument, count(*) AS n FROM det GROUP BY 1")
def instrument_normalise_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).groupBy(classify.causal_instrument(F.col("raw")).alias("instrument")).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('confidence', true), ('frp', true), ('id', true), ('support_weight', false), ('x', true), ('y', true)) v(name, present)")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = ["confidence", "frp", "id", "support_weight", "x", "y"]
    absent = checks.missing_columns(detections(spark, sf_dir), needed)
    return spark.createDataFrame([(c, c not in absent) for c in needed], "name string, present boolean")


@query(f"{WITH} SELECT instrument, count(*) AS n, count(v) AS with_power, round(coalesce(avg(v), 0), 6) AS mean FROM (SELECT instrument, CASE WHEN id % 13 <> 0 THEN frp END AS v FROM det) GROUP BY instrument")
def nan_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power that is NaN counts as missing."""
    d = detections(spark, sf_dir).select("instrument", times.denaned(F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("frp"))).alias("v"))
    return d.groupBy("instrument").agg(F.count("*").alias("n"), F.count("v").alias("with_power"), F.round(F.coalesce(F.avg("v"), F.lit(0.0)), 6).alias("mean"))


@query(f"{_MASK} SELECT p, round_even(count(*) * 0.0625, 3) AS area_km2, round_even(count(*) * 0.0625, 1) AS short_km2 FROM mk GROUP BY p")
def half_even_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = F.count("*") * P.CELL_AREA_KM2
    return masks(spark, sf_dir).groupBy("p").agg(F.bround(area, 3).alias("area_km2"), F.bround(area, 1).alias("short_km2"))


_GRID = f"{_CELLED}, sz AS (SELECT CAST((ceil((max(x) + 3000) / 250.0) * 250 - floor((min(x) - 3000) / 250.0) * 250) / 250 AS BIGINT) AS nx, CAST((ceil((max(y) + 3000) / 250.0) * 250 - floor((min(y) - 3000) / 250.0) * 250) / 250 AS BIGINT) AS ny FROM det)"


@query(f"{_GRID}, t AS (SELECT r + (id % 5 - 2) * 20 AS r, c + (id % 7 - 3) * 20 AS c FROM cel) SELECT nx, ny, count(*) AS n FROM t, sz WHERE c >= 0 AND c < nx AND r >= 0 AND r < ny GROUP BY nx, ny")
def cells_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells moved by up to 60 columns and 40 rows: those that are still on the grid, and its size."""
    d = detections(spark, sf_dir)
    moved = grid.with_cell(d).select((F.col("r") + (F.col("id") % 5 - 2) * 20).alias("r"), (F.col("c") + (F.col("id") % 7 - 3) * 20).alias("c"))
    size = grid.size(d)
    return grid.in_bounds(moved, size).agg(F.count("*").alias("n")).crossJoin(F.broadcast(size)).select("nx", "ny", "n")  # a single row


@query(f"{_MASK}, sz AS (SELECT CAST((ceil((max(x) + 3000) / 250.0) * 250 - floor((min(x) - 3000) / 250.0) * 250) / 250 AS BIGINT) AS nx, CAST((ceil((max(y) + 3000) / 250.0) * 250 - floor((min(y) - 3000) / 250.0) * 250) / 250 AS BIGINT) AS ny FROM det) SELECT p, greatest(0, min(r) - 1) AS r0, greatest(0, min(c) - 1) AS c0, least(any_value(ny) - 1, max(r) + 1) AS r1, least(any_value(nx) - 1, max(c) + 1) AS c1 FROM mk, sz GROUP BY p")
def raster_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.windows(masks(spark, sf_dir), grid.size(detections(spark, sf_dir)), ["p"])


@query(f"{_MASK} SELECT p, bool_and(r % 50 <> 0) AS equal FROM mk GROUP BY p")
def mask_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which passes' masks stay the same when some rows are taken off."""
    m = masks(spark, sf_dir)
    return grid.same_masks(m, m.filter("r % 50 != 0"))


@query(f"{_MASK} SELECT p, count(*) AS cells FROM (SELECT p, r + i AS r, c + j AS c FROM (SELECT DISTINCT p, r + i AS r, c + j AS c FROM mk CROSS JOIN (VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) v(i, j)) CROSS JOIN (VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) v(i, j) GROUP BY ALL HAVING count(*) = 5) GROUP BY p")
def display_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks smoothed for display: closed by a cell."""
    return grid.closing(masks(spark, sf_dir), 1).groupBy("p").agg(F.count("*").alias("cells"))


@query(f"{_ORDER}, d AS (SELECT od.p, min((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) AS d2 FROM od JOIN mk a USING (p) JOIN mk b ON b.p = od.prev AND abs(a.r - b.r) <= 8 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 64 GROUP BY od.p) SELECT od.p, round(coalesce(sqrt(d2) * 250, CAST('inf' AS DOUBLE)), 4) AS distance_m FROM od LEFT JOIN d USING (p)")
def mask_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance from a pass's mask to the one before, infinite where it is over 2000 m or one of them is empty."""
    m, order = masks(spark, sf_dir), pass_order(spark, sf_dir).select("p", "prev")
    d = grid.distance_to_previous(m, m, order.filter("prev IS NOT NULL")).groupBy("p").agg(F.min("d2").alias("d2"))
    return order.join(d, "p", "left").select("p", F.coalesce(F.round(F.sqrt("d2") * P.CELL, 4), F.lit(float("inf"))).alias("distance_m"))


@query(f"{_SUPPORTED}, sp AS (SELECT cluster, CAST(m AS BIGINT) AS m, satellite FROM cl JOIN ct USING (id) JOIN det USING (id)), mm AS (SELECT DISTINCT cluster, m FROM sp), ds AS (SELECT cluster, satellite, min(m) AS m FROM sp GROUP BY cluster, satellite) SELECT mm.cluster, mm.m, (SELECT n FROM st WHERE st.cluster = mm.cluster AND st.m = mm.m) AS n, string_agg(satellite, ',' ORDER BY satellite) AS satellites FROM mm JOIN ds ON ds.cluster = mm.cluster AND ds.m <= mm.m GROUP BY mm.cluster, mm.m")
def cumulative_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supported detections so far, and the satellites that have seen the cluster so far, in order."""
    per = counted(spark, sf_dir).groupBy("cluster", F.col("m").cast("long").alias("m")).agg(F.count("*").alias("k"), F.collect_set("satellite").alias("seen"))
    w = Window.partitionBy("cluster").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_set("seen").over(w))))
    return per.select("cluster", "m", F.sum("k").over(w).alias("n"), F.array_join(seen, ",").alias("satellites"))


@query(f"{_SUPPORTED} SELECT count(*) AS extents, CAST(sum(n) AS BIGINT) AS points FROM (SELECT cluster, max(n) AS n FROM st GROUP BY cluster HAVING max(n) >= 15)")
def chosen_extent_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the last extents of the clusters that are large enough."""
    last = _states(spark, sf_dir).groupBy("cluster").agg(F.max("n").alias("n")).filter(F.col("n") >= P.CLUSTER_MIN)
    return last.agg(F.count("*").alias("extents"), F.sum("n").alias("points"))


@query(f"{WITH}, s AS (SELECT slot, row_number() OVER (ORDER BY slot) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT slot FROM det)) SELECT DISTINCT slot FROM s JOIN range(0, 16) k(k) ON n <= 16 OR i = round_even(k * ((n - 1) / 15.0), 0)")
def panel_subsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen passes at even steps from the first to the last, or all of sixteen or fewer."""
    return passes.even_subsample(detections(spark, sf_dir).select("slot").distinct(), "slot")


@query(f"{_PASSES} SELECT pass_id, last_m, n FROM sm ORDER BY last_m DESC, pass_id DESC LIMIT 10")
def last_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten last passes, as the console report lists them."""
    s = passes.summary(passes.sessionize(detections(spark, sf_dir)))
    return s.orderBy(F.desc("last_m"), F.desc("pass_id")).limit(10).select("pass_id", "last_m", "n")


@query(f"{_PASSES} SELECT pass_id, n FROM sm ORDER BY n DESC, pass_id LIMIT 15")
def largest_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = passes.summary(passes.sessionize(detections(spark, sf_dir)))
    return s.orderBy(F.desc("n"), "pass_id").limit(15).select("pass_id", "n")


@query(f"{WITH}, w AS (SELECT id, m, satellite, frp, unnest(range(m // 360 * 360 - 2520, m // 360 * 360 + 1, 360)) AS a FROM det) SELECT a AS start_m, satellite, count(*) AS n, round(sum(frp), 4) AS power FROM w GROUP BY a, satellite")
def sliding_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections and power per satellite in windows of 48 hours, every 6 hours."""
    from ..streaming import twins

    d = detections(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    w = twins.recency_windows(d)
    return w.select((F.unix_seconds("start") / 60).cast("long").alias("start_m"), "satellite", "n", F.round("power", 4).alias("power"))

