"""Thermal detections: the feed schema and readers, and the deterministic view of `events` as detections."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEED = T.StructType(
    [T.StructField(n, t) for n, t in (("latitude", T.DoubleType()), ("longitude", T.DoubleType()), ("acq_date", T.StringType()), ("acq_time", T.IntegerType()), ("frp", T.StringType()), ("scan", T.StringType()), ("track", T.StringType()), ("confidence", T.StringType()), ("satellite", T.StringType()), ("instrument", T.StringType()))]
)


def read_feed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One feed's CSV files, typed by FEED and tagged with the feed's name."""
    return spark.read.schema(FEED).option("header", True).csv(path).withColumn("source", F.lit(source))


def union_feeds(feeds: list[DataFrame]) -> DataFrame:
    """All feeds; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def read_feeds(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """All feeds that can be read, and why the others can't; an error where none has a row. paths: feed -> path."""
    feeds, failed = [], {}
    for source, path in paths.items():
        try:
            feed = read_feed(spark, path, source)
            if feed.isEmpty():
                failed[source] = "empty"
            else:
                feeds.append(feed)
        except (AnalysisException, Py4JJavaError, SparkRuntimeException) as e:
            failed[source] = str(e).split("\n")[0]
    if not feeds:
        raise RuntimeError(f"no feed has a row: {failed}")
    return union_feeds(feeds), failed


def read_history(spark: SparkSession, archive: str, working: str, schema: str | T.StructType) -> DataFrame | None:
    """The archive, else the working file, else none; what can't be read is passed over."""
    for path in (archive, working):
        try:
            found = spark.read.schema(schema).option("header", True).csv(path)
            found.isEmpty()
            return found
        except (AnalysisException, Py4JJavaError, SparkRuntimeException):
            continue
    return None


def acquired(date: Column, hhmm: Column) -> Column:
    """Timestamp of a date and an unpadded HHMM number; null where they make none."""
    return F.try_to_timestamp(F.concat(date, F.lit(" "), F.lpad(F.coalesce(hhmm, F.lit(0)).cast("string"), 4, "0")), F.lit("yyyy-MM-dd HHmm"))


def normalise(feed: DataFrame, now: Column) -> DataFrame:
    """Detections of a feed: typed columns, age in hours, null power as 1, rows without place or time dropped."""
    out = feed.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}).withColumn("dt_utc", acquired(F.col("acq_date"), F.col("acq_time")))
    number = {c: F.expr(f"try_cast({c} AS double)") for c in ("frp", "scan", "track")}
    out = out.withColumns(number).withColumn("frp", F.coalesce("frp", F.lit(1.0))).na.drop(subset=["lat", "lon", "dt_utc"])
    return out.withColumn("hours_ago", (F.unix_micros(now) - F.unix_micros("dt_utc")) / 3.6e9).filter("hours_ago >= -0.5")


def merge_history(history: DataFrame | None, batch: DataFrame) -> DataFrame:
    """History and new rows, of each (place to 3 decimals, date, time) the one with the most power; ties by time, source, place."""
    both = batch if history is None else history.unionByName(batch, allowMissingColumns=True)
    key = [F.round("lat", 3).alias("klat"), F.round("lon", 3).alias("klon"), F.col("acq_date"), F.col("acq_time")]
    ranked = both.withColumn("row", F.struct("*"))
    best = F.max_by("row", F.struct(F.col("frp"), -F.unix_micros("dt_utc"), F.coalesce("source", F.lit("")), -F.col("lat"), -F.col("lon")))
    return ranked.groupBy(*key).agg(best.alias("row")).select("row.*")


#: The view on `events`; integer arithmetic only, so that any engine gets the same rows.
VIEW_SQL = """
det AS (
  SELECT event_id AS id, slot, m, x, y, value AS frp,
    CASE slot % 5 WHEN 0 THEN 'N20' WHEN 1 THEN 'N21' WHEN 2 THEN 'N' WHEN 3 THEN 'Terra' ELSE 'Aqua' END AS satellite,
    CASE WHEN slot % 5 < 3 THEN 'VIIRS' ELSE 'MODIS' END AS instrument,
    CASE WHEN slot % 5 < 3 THEN (CASE event_id % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'n' ELSE 'h' END) ELSE CAST(event_id % 101 AS VARCHAR) END AS confidence,
    CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE 0.375 + CAST(event_id % 5 AS DOUBLE) / 10 END AS scan, 0.375 + CAST(event_id % 3 AS DOUBLE) / 10 AS track
  FROM (SELECT event_id, value, slot, slot * 48 + (event_id % 3) * 3 AS m,
      380000 + slot * 40 + (CASE WHEN event_id % 10 < 6 THEN (event_id * 7919) % 4001 - 2000 WHEN event_id % 10 < 9 THEN 22000 + (event_id * 7919) % 3001 - 1500 ELSE (event_id * 7919) % 50021 - 25010 END) AS x,
      6420000 + slot * 20 + (CASE WHEN event_id % 10 < 6 THEN (event_id * 104729) % 4003 - 2001 WHEN event_id % 10 < 9 THEN 9000 + (event_id * 104729) % 3011 - 1505 ELSE (event_id * 104729) % 40009 - 20004 END) AS y
    FROM (SELECT event_id, value, date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', ts)) // 288 AS slot FROM events))
)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as detections: id, slot, m (minutes since 2024-01-01), x, y (metres), frp, satellite, instrument, ..."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "value")
    slot = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 288")
    i = F.col("event_id")
    part = i % 10

    def place(a: int, b: int, near: tuple[int, int], mid: tuple[int, int, int], far: tuple[int, int], prime: int) -> Column:
        p = i * prime
        return F.lit(a) + F.col("slot") * b + F.when(part < 6, p % near[0] - near[1]).when(part < 9, mid[0] + p % mid[1] - mid[2]).otherwise(p % far[0] - far[1])

    e = e.withColumn("slot", slot)
    k = F.col("slot") % 5
    viirs = k < 3
    return e.select(
        i.alias("id"), "slot", (F.col("slot") * 48 + (i % 3) * 3).alias("m"),
        place(380000, 40, (4001, 2000), (22000, 3001, 1500), (50021, 25010), 7919).alias("x"),
        place(6420000, 20, (4003, 2001), (9000, 3011, 1505), (40009, 20004), 104729).alias("y"),
        F.col("value").alias("frp"),
        F.when(k == 0, "N20").when(k == 1, "N21").when(k == 2, "N").when(k == 3, "Terra").otherwise("Aqua").alias("satellite"),
        F.when(viirs, "VIIRS").otherwise("MODIS").alias("instrument"),
        F.when(viirs, F.when(i % 3 == 0, "l").when(i % 3 == 1, "n").otherwise("h")).otherwise((i % 101).cast("string")).alias("confidence"),
        F.when(i % 11 == 0, 0.0).otherwise(F.lit(0.375) + (i % 5).cast("double") / 10).alias("scan"), (F.lit(0.375) + (i % 3).cast("double") / 10).alias("track"),
    )
