"""Feeds in, products out: each written to the shared folder, read again, and reported from what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import times
from ..operators import grid, progression, shapes
from ..sources import checks, detections as feeds, tiles, web
from ..sources.detections import VIEW_SQL, detections
from ..sources.tables import materialize, shared_dir
from .grid_queries import _COMP, _MASK, _ORDER, masks, pass_order, progressed, projection_displayed
from .product_queries import _LAND, _fine, arrivals, front_polygons
from .registry import query

WITH = f"WITH {VIEW_SQL}"


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a feed has it: places as degrees (of squares of a metre), date and HHMM, numbers as text; every 97th row
    without a place, every 89th without a time."""
    d = detections(spark, sf_dir)
    return d.select(
        F.when(F.col("id") % 97 != 0, (F.col("y") * 2 + 1) / 200000.0).alias("latitude"), ((F.col("x") * 2 + 1) / 200000.0).alias("longitude"),
        F.when(F.col("id") % 89 != 0, F.date_format(times.at_minute(), "yyyy-MM-dd")).alias("acq_date"), (F.floor(F.col("m") % 1440 / 60) * 100 + F.col("m") % 60).cast("int").alias("acq_time"),
        F.when(F.col("id") % 7 == 0, "bad").otherwise(F.col("frp").cast("string")).alias("frp"), F.col("scan").cast("string").alias("scan"), F.col("track").cast("string").alias("track"), "confidence", "satellite", "instrument",
    )


@query(f"{WITH} SELECT 'feed-' || instrument AS source, count(*) AS n, count(*) FILTER (WHERE id % 7 = 0 OR frp = 1) AS defaulted, count(DISTINCT m) AS times FROM det WHERE id % 97 <> 0 AND id % 89 <> 0 AND m <= (SELECT max(m) - 1440 + 30 FROM det) GROUP BY instrument")
def feeds_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds that are there, one that is empty and one that isn't, normalised as of a day before the end: what lacks a
    place or a time goes, and so does what lies more than half an hour ahead."""
    raw = materialize(_raw_feed(spark, sf_dir), "raw-feed")
    paths = {f"feed-{i}": _place(spark, f"feed-{i}") for i in ("VIIRS", "MODIS")}
    for name, path in paths.items():
        web.write_csv(raw.filter(F.col("instrument") == name[5:]), path)
    paths["feed-empty"] = _place(spark, "feed-empty")
    web.write_csv(raw.limit(0), paths["feed-empty"])
    found, _ = feeds.read_feeds(spark, paths | {"feed-absent": _place(spark, "feed-absent")})
    end = detections(spark, sf_dir).agg(F.max("m")).first()[0] - 1440
    now = F.date_add(F.lit("2024-01-01").cast("date"), 0).cast("timestamp") + F.expr(f"INTERVAL {end} MINUTES")
    n = feeds.normalise(found, now)
    return n.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("frp") == 1.0).alias("defaulted"), F.countDistinct("dt_utc").alias("times"))


@query(f"{WITH} SELECT satellite, count(*) AS n, CAST(sum(m) AS BIGINT) AS minutes, round(sum(frp), 4) AS power FROM det GROUP BY satellite")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).select("id", "satellite", F.col("m").cast("long").alias("m"), "frp", F.lit(None).cast("string").alias("nothing"), F.lit("").alias("empty"))
    path = _place(spark, "csv")
    web.write_csv(d, path)
    back = web.read_csv(spark, path, d.schema).filter("nothing IS NULL AND empty IS NULL")
    return back.groupBy("satellite").agg(F.count("*").alias("n"), F.sum("m").alias("minutes"), F.round(F.sum("frp"), 4).alias("power"))


#: Corners of a mask's outline: where one or three of the four cells around a corner are set, and twice where two opposite ones are.
_CORNERS = f"{_MASK}, vx AS (SELECT p, r + i AS vr, c + j AS vc, count(*) AS n, sum(i * 2 + j) AS k FROM mk CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(i, j) GROUP BY ALL), cn AS (SELECT p, CAST(sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND k = 3 THEN 2 ELSE 0 END) AS BIGINT) AS corners FROM vx GROUP BY p)"
_PARTS = f"{_CORNERS}, pt AS (SELECT p, CAST(count(DISTINCT label) AS BIGINT) AS parts, count(*) AS cells FROM lab JOIN big USING (p, label) GROUP BY p)"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, cells, coordinates, feature): a MultiPolygon in degrees for each pass."""
    f = front_polygons(spark, sf_dir).withColumn("degrees", shapes.to_degrees(F.col("rings"), F.col("gx"), F.col("gy")))
    f = f.groupBy("p").agg(F.sum("cells").alias("cells"), F.sort_array(F.collect_list(F.struct("part", "degrees"))).alias("all"))
    f = f.withColumn("coordinates", F.col("all.degrees")).drop("all")
    properties = F.struct(F.col("p").alias("snapshot_index"), "cells", F.bround(F.col("cells") * P.CELL_AREA_KM2, 3).alias("area_km2"), times.iso_utc(times.at_minute("p * 48")).alias("slot_utc"))
    return f.withColumn("feature", web.feature(properties, F.col("coordinates")))


_PROPERTIES = "snapshot_index: bigint, cells: bigint, area_km2: double, slot_utc: string"


def _read_report(found: DataFrame) -> DataFrame:
    rings = web.polygon_parts(found).groupBy("properties").agg(F.count("*").alias("parts"), F.sum(F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring) - 1)).cast("long").alias("corners"))
    return rings.select(F.col("properties.snapshot_index").alias("p"), "parts", "corners", F.col("properties.cells").alias("cells"), F.round("properties.area_km2", 3).alias("area_km2"), F.col("properties.slot_utc").alias("slot_utc"))


_READ = f"{_PARTS} SELECT p, parts, corners, cells, round_even(cells * 0.0625, 3) AS area_km2, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(p * 48 AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS slot_utc FROM pt JOIN cn USING (p)"


@query(_READ)
def feature_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A GeoJSON feature a line for each pass, written and read back: parts, corners without the closing ones, properties."""
    path = _place(spark, "features")
    web.write_features(_features(spark, sf_dir), path)
    return _read_report(web.read_features(spark, path, _PROPERTIES))


@query(_READ)
def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One FeatureCollection with bbox and metadata, written and read back."""
    path = _place(spark, "collection")
    web.write_collection(materialize(_features(spark, sf_dir), "features"), path, F.struct(F.lit("arrival").alias("model"), F.lit(P.CELL).alias("cell_m")))
    return _read_report(web.read_features(spark, path, _PROPERTIES))


@query(f"{_MASK} SELECT min(c) AS x0, min(r) AS y0, max(c) + 1 AS x1, max(r) + 1 AS y1 FROM mk")
def collection_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bbox of a collection whose coordinates are corners of cells, as its reader finds it."""
    corners = F.transform("rings", lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"])))
    f = shapes.polygons(masks(spark, sf_dir)).groupBy("p").agg(F.collect_list(corners).alias("coordinates"))
    path = _place(spark, "collection")
    web.write_collection(materialize(f.withColumn("feature", web.feature(F.struct("p"), F.col("coordinates"))), "features"), path)
    box = spark.read.text(path).select(F.from_json("value", "bbox array<double>").getField("bbox").alias("b"))
    return box.select(*[F.get("b", F.lit(i)).cast("long").alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query(f"{_PARTS} SELECT p, parts, corners FROM pt JOIN cn USING (p)")
def geometry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of well-known binary, written and read back."""
    path = _place(spark, "layer")
    web.write_geometry(_features(spark, sf_dir), path, "p")
    back = web.read_geometry(spark, path, "p").select("p", F.explode("coordinates").alias("rings"))
    return back.groupBy("p").agg(F.count("*").alias("parts"), F.sum(F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring) - 1)).cast("long").alias("corners"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: a run's parameters, and a snapshot for each pass with times, areas of the five categories, confidence and
    whether the projection is shown. As long as the list of passes."""
    parts = progression.categories(progressed(spark, sf_dir)).groupBy("p", "category").agg(F.bround(F.count("*") * P.CELL_AREA_KM2, 3).alias("area_km2"))
    parts = parts.groupBy("p").agg(F.sort_array(F.collect_list(F.struct("category", "area_km2"))).alias("categories"))
    span = detections(spark, sf_dir).groupBy(F.col("slot").alias("p")).agg(F.min("m").alias("m"), F.count("*").alias("detections"))
    run = span.agg(F.min("m").alias("m0"), F.max("m").alias("m1"))
    s = span.crossJoin(F.broadcast(run)).join(parts, "p", "left").join(projection_displayed(spark, sf_dir), "p")  # a single row
    none = F.array().cast("array<struct<category: string, area_km2: double>>")
    snap = F.struct(
        F.col("p").alias("snapshot_index"), times.iso_utc(times.at_minute("m")).alias("pass_time_utc"), F.date_format(times.local(times.at_minute("m").cast("timestamp")), "yyyy-MM-dd HH:mm").alias("pass_time_local"),
        times.hours_between(F.col("m"), F.col("m0")).alias("arrival_h"), times.hours_between(F.col("m1"), F.col("m")).alias("hours_ago"), "detections",
        F.coalesce("categories", none).alias("categories"), F.col("level").alias("projection_confidence"), F.col("displayed").alias("projection_displayed"),
    )
    fixed = F.struct(F.lit(P.CELL).alias("cell_m"), F.lit(P.SIGMA_CELLS).alias("sigma_cells"), F.lit(P.MIN_COMPONENT).alias("min_component"), F.lit(P.SPEED_SCALE).alias("speed_scale"), F.lit(P.CONFIRM_HOURS).alias("confirm_hours"), F.lit(P.LAND_FRACTION).alias("land_fraction"))
    one = s.agg(F.sort_array(F.collect_list(snap)).alias("snapshots"))
    categories = F.array(*map(F.lit, web.CATEGORIES))
    return one.select("snapshots", F.to_json(F.struct(F.lit("arrival").alias("model"), fixed.alias("parameters"), categories.alias("categories"), "snapshots")).alias("manifest"))


@query(f"{_ORDER} SELECT count(*) AS passes, max(p) AS last_pass, strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(max((SELECT min(m) FROM det WHERE slot = ps.p)) AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ') AS last_time FROM ps")
def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, written, read back and probed."""
    path = _place(spark, "manifest")
    manifest(spark, sf_dir).select("manifest").coalesce(1).write.text(path)
    return web.probe_manifest(spark, path).select("passes", "last_pass", "last_time")


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{c}', {ok})" for t, ok in (("N42W003", True), ("N45W003", True), ("N48W003", True)) for c, ok in ((c, c not in {"N45W003": ("dtype", "width"), "N48W003": ("bounds", "nodata")}.get(t, ())) for c in (*checks.TILE_FORMAT, "bounds"))) + ") v(tile, \"check\", passed)")
def tile_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tiles' descriptions: one that is as it should be, one of the wrong type and size, one that isn't known."""
    good = ("GTiff", "EPSG:4326", 36000, 36000, 1, "uint8", 0)
    rows = [("N42W003", *good, -3.0, 42.0, 0.0, 45.0), ("N45W003", *good[:2], 18000, *good[3:5], "uint16", 0, -3.0, 45.0, 0.0, 48.0 + 1e-10), ("N48W003", *good[:6], None, -3.0, 48.0, 0.0, 51.0)]
    names = "tile string, driver string, crs string, width int, height int, bands int, dtype string, nodata int, left double, bottom double, right double, top double"
    return checks.tile_checks(spark.createDataFrame(rows, names))


@query(f"{_LAND} SELECT CAST(class AS INTEGER) AS class, count(*) AS cells FROM (SELECT class, r * 5 + i AS fr, c * 5 + j AS fc FROM fi) WHERE fr BETWEEN 100 AND 2000 AND fc BETWEEN 50 AND 1500 GROUP BY class")
def land_cover_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land cover written as tiles and read in bounds: only the folders of tiles that the bounds touch are opened."""
    path = _place(spark, "land-cover")
    tiles.write_cells(_fine(arrivals(spark, sf_dir)).select(F.col("fr").alias("r"), F.col("fc").alias("c"), "class"), path)
    return tiles.read_cells(spark, path, (100, 50, 2000, 1500)).groupBy("class").agg(F.count("*").alias("cells"))


@query(f"{_MASK} SELECT p, count(*) AS cells, CAST(sum(r * 31 + c) AS BIGINT) AS mix FROM mk GROUP BY p")
def rasterise_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines drawn back on the grid: the cells that they came from."""
    back = shapes.rasterise(shapes.polygons(masks(spark, sf_dir)))
    return back.groupBy("p").agg(F.count("*").alias("cells"), F.sum(F.col("r") * 31 + F.col("c")).alias("mix"))


@query(f"{_PARTS}, s AS (SELECT p, CAST(4 * count(*) AS BIGINT) AS sides FROM mk GROUP BY p), ad AS (SELECT a.p, count(*) AS n FROM mk a JOIN mk b ON a.p = b.p AND ((b.r = a.r + 1 AND b.c = a.c) OR (b.r = a.r AND b.c = a.c + 1)) GROUP BY a.p) SELECT p, corners, CAST((sides - 2 * coalesce(n, 0)) * 250 AS BIGINT) AS outline_m, CAST(0 AS BIGINT) AS invalid FROM cn JOIN s USING (p) LEFT JOIN ad USING (p)")
def outline_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates, length and validity of the outlines, before and after a simplification below the cell's size (which
    must leave them as they are) and a repair (which must leave them all)."""
    polygons = materialize(shapes.polygons(masks(spark, sf_dir)), "polygons")
    fixed = shapes.repaired(polygons)
    thin = shapes.simplify(fixed, 50 / P.CELL)
    length = lambda ring: F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0).cast("long"), lambda s, i: s + (F.abs(F.get(ring, i)["x"] - F.get(ring, i - 1)["x"]) + F.abs(F.get(ring, i)["y"] - F.get(ring, i - 1)["y"])).cast("long"))
    total = lambda rings, f: F.aggregate(F.transform(rings, f), F.lit(0).cast("long"), lambda s, v: s + v)
    bad = polygons.groupBy("p").agg(F.sum(F.size(F.filter("rings", lambda r: ~shapes.valid(r)))).cast("long").alias("invalid"))
    lines = thin.groupBy("p").agg(F.sum(shapes.points_of(F.col("rings")) - F.size("rings")).cast("long").alias("corners"), F.sum(total("rings", length) * P.CELL).alias("outline_m"))
    return lines.join(bad, "p").select("p", "corners", "outline_m", "invalid")


@query(f"{_COMP}, big AS (SELECT p, label FROM lab GROUP BY p, label HAVING count(*) >= 4), e AS (SELECT p, label, k // 100000 AS r, k % 100000 AS c FROM lab JOIN big USING (p, label)) SELECT a.p, a.label, b.label AS other, CAST(min((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) AS BIGINT) AS d2 FROM e a JOIN e b ON a.p = b.p AND a.label < b.label AND abs(a.r - b.r) <= 8 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 64 GROUP BY ALL")
def part_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance between the parts of a pass's mask that lie within 2000 m of each other."""
    labelled = materialize(grid.components(masks(spark, sf_dir)), "labelled")
    return grid.part_distances(labelled).select("p", "label", "other", F.col("d2").cast("long").alias("d2"))
