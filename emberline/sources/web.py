"""What the web reads: CSV tables, GeoJSON collections, manifests and geometry tables, with a writer and a reader for each.

Features are rows and are written as such, a line of JSON each, by all tasks; a collection that must be one document is put
together from its features, as long as the number of passes, when it is written."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rings of polygons in positions [x, y]; a MultiPolygon's coordinates.
COORDINATES = "array<array<array<array<double>>>>"
CATEGORIES = ("observed_front", "persistence", "advance", "provisional_new", "confirmed_new")


def write_csv(df: DataFrame, path: str) -> None:
    """A header; nulls and empty texts are empty fields, which are read as null."""
    df.write.option("header", True).option("emptyValue", "").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def feature(properties: Column, coordinates: Column) -> Column:
    """A GeoJSON MultiPolygon feature as text."""
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))


def write_features(features: DataFrame, path: str, column: str = "feature") -> None:
    features.select(F.col(column).alias("value")).write.text(path)


def write_collection(features: DataFrame, path: str, metadata: Column | None = None, column: str = "feature") -> None:
    """One FeatureCollection: its bbox, metadata if given, and the features in the order of their text."""
    one = features.agg(F.array_join(F.sort_array(F.collect_list(column)), ",").alias("all"), *header(features))
    extra = [F.lit(',"metadata":'), F.to_json(metadata)] if metadata is not None else []
    text = F.concat(F.lit('{"type":"FeatureCollection","bbox":'), F.to_json(F.array("x0", "y0", "x1", "y1")), *extra, F.lit(',"features":['), F.col("all"), F.lit("]}"))
    one.select(text.alias("value")).coalesce(1).write.text(path)


def header(features: DataFrame) -> list[Column]:
    """Aggregates x0, y0, x1, y1 over the column coordinates of features."""
    flat = F.flatten(F.flatten("coordinates"))
    side = lambda i: F.transform(flat, lambda v: F.get(v, F.lit(i)).cast("double"))
    return [F.min(F.array_min(side(0))).alias("x0"), F.min(F.array_min(side(1))).alias("y0"), F.max(F.array_max(side(0))).alias("x1"), F.max(F.array_max(side(1))).alias("y1")]


def read_features(spark: SparkSession, path: str, properties: str, whole: bool = False) -> DataFrame:
    """(properties, coordinates, kind): the features of collections, or of lines with a feature each. Polygons become
    MultiPolygons of one; properties: their fields as DDL. whole: a document may go over several lines."""
    one = f"struct<type: string, properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>"
    text = spark.read.text(path, wholetext=whole)
    many = F.from_json("value", f"struct<type: string, features: array<{one}>>")["features"]
    found = text.select(F.explode(F.when(F.get_json_object("value", "$.type") == "FeatureCollection", many).otherwise(F.array(F.from_json("value", one)))).alias("f"))
    flat = found.select("f.properties", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    single = F.array(F.from_json("text", "array<array<array<double>>>"))
    return flat.select("properties", F.when(F.col("kind") == "Polygon", single).otherwise(F.from_json("text", COORDINATES)).alias("coordinates"), "kind")


def polygon_parts(features: DataFrame) -> DataFrame:
    """(properties, part, rings): each polygon of each feature."""
    return features.select("properties", F.posexplode("coordinates").alias("part", "rings"))


def probe_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(passes, last_pass, last_time, projection_displayed) of a manifest: its last snapshot, or nulls where it has none."""
    snapshot = "struct<snapshot_index: bigint, pass_time_utc: string, projection_displayed: boolean>"
    m = spark.read.text(path, wholetext=True).select(F.from_json("value", f"snapshots array<{snapshot}>").alias("m"))
    last = F.try_element_at("m.snapshots", F.lit(-1))
    return m.select(F.size("m.snapshots").cast("long").alias("passes"), last["snapshot_index"].alias("last_pass"), last["pass_time_utc"].alias("last_time"), F.coalesce(last["projection_displayed"], F.lit(False)).alias("projection_displayed"))


def to_wkb(polygons: list[list[list[tuple[float, float]]]]) -> bytes:
    """A MultiPolygon as well-known binary, little-endian."""
    out = [struct.pack("<BII", 1, 6, len(polygons))]
    for rings in polygons:
        out.append(struct.pack("<BII", 1, 3, len(rings)))
        for ring in rings:
            out.append(struct.pack("<I", len(ring)))
            out.extend(struct.pack("<dd", x, y) for x, y in ring)
    return b"".join(out)


def from_wkb(data: bytes) -> list[list[list[list[float]]]]:
    def take(fmt: str) -> tuple:
        nonlocal at
        at += struct.calcsize(order + fmt)
        return struct.unpack_from(order + fmt, data, at - struct.calcsize(order + fmt))

    def polygon() -> list[list[list[float]]]:
        return [[list(take("dd")) for _ in range(take("I")[0])] for _ in range(take("I")[0])]

    at, order = 0, "<"

    def opened() -> int:
        nonlocal order, at
        order = "<" if data[at] else ">"
        at += 1
        return take("I")[0]

    if (kind := opened()) == 3:
        return [polygon()]
    if kind != 6:
        raise ValueError(f"not a polygon: {kind}")
    out = []
    for _ in range(take("I")[0]):
        opened()
        out.append(polygon())
    return out


def _convert(name: str, to: str, make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.binary() if to == "binary" else pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([v if v is None else make(v) for v in batch.column(name).to_pylist()], kind)], names=["key", "out"])

    return run


def write_geometry(features: DataFrame, path: str, key: str) -> None:
    """A layer as a table (key, geometry): MultiPolygons as well-known binary. A layer that was there is replaced."""
    rows = features.select(F.col(key).alias("key"), F.col("coordinates").cast(COORDINATES).alias("coordinates"))
    rows.mapInArrow(_convert("coordinates", "binary", to_wkb), T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("out", T.BinaryType())])).select(F.col("key").alias(key), F.col("out").alias("geometry")).write.mode("overwrite").parquet(path)


def read_geometry(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, coordinates) of a layer."""
    rows = spark.read.parquet(path).select(F.col(key).alias("key"), "geometry")
    kind = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
    return rows.mapInArrow(_convert("geometry", "coordinates", from_wkb), T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("out", kind)])).select(F.col("key").alias(key), F.col("out").alias("coordinates"))
