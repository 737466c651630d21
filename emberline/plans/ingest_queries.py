"""Parsing, coercion, filters, deduplication, projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, geo, times
from ..sources.detections import VIEW_SQL, acquired, detections, merge_history
from .registry import query

WITH = f"WITH {VIEW_SQL}"
#: The latest minute in the table stands for now.
NOW_SQL = "(SELECT max(m) FROM det)"


def _now(det: DataFrame) -> DataFrame:
    return det.crossJoin(F.broadcast(det.agg(F.max("m").alias("now"))))  # a single row


@query(f"{WITH} SELECT id, CAST(m AS BIGINT) AS m, satellite, instrument, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, round(frp, 6) AS frp, confidence FROM det")
def detections_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir)
    return d.select("id", F.col("m").cast("long").alias("m"), "satellite", "instrument", "x", "y", F.round("frp", 6).alias("frp"), "confidence")


@query(f"{WITH} SELECT id, CAST(m % 1440 // 60 * 100 + m % 60 AS BIGINT) AS acq_time, CAST(m AS BIGINT) AS minute FROM det")
def ingest_hhmm_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir)
    hhmm = (F.floor(F.col("m") % 1440 / 60) * 100 + F.col("m") % 60).cast("long")
    d = d.select("id", hhmm.alias("acq_time"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("m") / 1440).cast("int")), "yyyy-MM-dd").alias("acq_date"))
    base = acquired(F.lit("2024-01-01"), F.lit(0))
    return d.select("id", "acq_time", ((F.unix_micros(acquired(F.col("acq_date"), F.col("acq_time"))) - F.unix_micros(base)) / 60_000_000).cast("long").alias("minute"))


@query(f"{WITH} SELECT satellite, count(*) AS n, count(*) FILTER (WHERE id % 7 = 0) AS defaulted, round(sum(CASE WHEN id % 7 = 0 THEN 1.0 ELSE frp END), 4) AS power FROM det GROUP BY satellite")
def ingest_coerce_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = detections(spark, sf_dir).withColumn("frp", F.when(F.col("id") % 7 == 0, "bad").otherwise(F.col("frp").cast("string")))
    typed = raw.withColumn("frp", F.expr("try_cast(frp AS double)"))
    return typed.groupBy("satellite").agg(F.count("*").alias("n"), F.count_if(F.col("frp").isNull()).alias("defaulted"), F.round(F.sum(F.coalesce("frp", F.lit(1.0))), 4).alias("power"))


@query(f"{WITH} SELECT id, CAST({NOW_SQL} - m AS BIGINT) AS age_minutes FROM det WHERE {NOW_SQL} - m BETWEEN -30 AND 2880")
def recency_window_48h(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = (F.col("now") - F.col("m")).cast("long")
    return _now(detections(spark, sf_dir)).select("id", age.alias("age_minutes")).filter(F.col("age_minutes").between(-30, 2880))


@query(f"{WITH} SELECT id, CAST(m AS BIGINT) AS m FROM det WHERE m >= 1440")
def campaign_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).filter("m >= 1440").select("id", F.col("m").cast("long").alias("m"))


@query(f"{WITH} SELECT start, count(*) AS n FROM det CROSS JOIN (VALUES ('auto', 0), ('2024-01-02T00:00:00', 1440), ('2024-01-02T12:00:00+02:00', 2040)) v(start, a) WHERE m >= a GROUP BY start")
def campaign_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections since each of three starts: none at all, one without a zone (UTC) and one with."""
    ts = F.timestamp_seconds(F.unix_seconds(times.parsed_utc(F.lit("2024-01-01T00:00:00Z"))) + F.col("m") * 60)
    starts = ("auto", "2024-01-02T00:00:00", "2024-01-02T12:00:00+02:00")
    hits = F.explode(F.array(*[F.struct(F.lit(s).alias("start"), times.since(ts, s).alias("in")) for s in starts]))
    return detections(spark, sf_dir).select(hits.alias("h")).filter("h.in").groupBy("h.start").agg(F.count("*").alias("n"))


@query(f"{WITH}, a AS (SELECT ({NOW_SQL} - m) / 60.0 AS h FROM det) SELECT CAST(least(floor(h / 8) + 1, 6) AS BIGINT) AS age_class, count(*) AS n FROM a WHERE h BETWEEN 0 AND 48 GROUP BY 1")
def age_class_8h(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _now(detections(spark, sf_dir)).select(classify.age_class((F.col("now") - F.col("m")) / 60.0).cast("long").alias("age_class"))
    return d.filter("age_class IS NOT NULL").groupBy("age_class").agg(F.count("*").alias("n"))


@query(f"{WITH} SELECT id, instrument, confidence FROM det WHERE (instrument = 'VIIRS' AND confidence IN ('n', 'h')) OR (instrument = 'MODIS' AND TRY_CAST(confidence AS DOUBLE) >= 30)")
def confidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).filter(classify.confident()).select("id", "instrument", "confidence")


@query(f"{WITH} SELECT count(*) AS kept, min(id) AS first_id, max(id) AS last_id, round(sum(frp), 4) AS power FROM (SELECT *, row_number() OVER (PARTITION BY x // 100, y // 100, m ORDER BY frp DESC, id) AS rn FROM det) WHERE rn = 1")
def dedupe_max_frp(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).withColumns({"kx": F.floor(F.col("x") / 100), "ky": F.floor(F.col("y") / 100)})
    best = d.groupBy("kx", "ky", "m").agg(F.max(F.struct("frp", (-F.col("id")).alias("i"))).alias("b"))
    return best.agg(F.count("*").alias("kept"), F.min(-F.col("b.i")).alias("first_id"), F.max(-F.col("b.i")).alias("last_id"), F.round(F.sum("b.frp"), 4).alias("power"))


_UPSERT = f"{WITH}, l AS (SELECT max(m) AS b FROM det), u AS (SELECT id, (x * 2 + 1) / 200000.0 AS lon, (y * 2 + 1) / 200000.0 AS lat, m, frp, 'old' AS source FROM det, l WHERE m <= b - 1440 UNION ALL SELECT id, (x * 2 + 1) / 200000.0, (y * 2 + 1) / 200000.0, m, frp + id % 2, 'new' FROM det, l WHERE m > b - 4320)"


def _overlapping(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An archive up to a day before the end, and a batch of the last three days, in which half the rows have more power;
    together they have every row. Degrees of no place on earth: rounded to three decimals they make squares of 100 m."""
    d = detections(spark, sf_dir).crossJoin(F.broadcast(detections(spark, sf_dir).agg(F.max("m").alias("b"))))  # a single row
    d = d.select(((F.col("y") * 2 + 1) / 200000.0).alias("lat"), ((F.col("x") * 2 + 1) / 200000.0).alias("lon"), F.col("m").cast("string").alias("acq_date"), F.lit(0).alias("acq_time"), F.timestamp_seconds(F.col("m") * 60).alias("dt_utc"), "frp", "id", "m", "b")
    old = d.filter("m <= b - 1440").withColumn("source", F.lit("old"))
    new = d.filter("m > b - 4320").withColumns({"frp": F.col("frp") + F.col("id") % 2, "source": F.lit("new")})
    return old, new


@query(f"{_UPSERT} SELECT source, count(*) AS n, round(sum(frp), 4) AS power FROM (SELECT *, row_number() OVER (PARTITION BY round(lat, 3), round(lon, 3), m ORDER BY frp DESC, source DESC, lat, lon) AS rn FROM u) WHERE rn = 1 GROUP BY source")
def history_union_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_history(*_overlapping(spark, sf_dir)).groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("frp"), 4).alias("power"))


@query(f"{WITH} SELECT instrument, count(*) AS n, round(sum(CASE WHEN scan * track > 0 THEN scan * track WHEN instrument = 'MODIS' THEN 1.0 ELSE 0.140625 END), 4) AS area FROM det GROUP BY instrument")
def pixel_area_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).groupBy("instrument").agg(F.count("*").alias("n"), F.round(F.sum(classify.pixel_area()), 4).alias("area"))


_PLACED = f"{WITH}, g AS (SELECT id, -1.2 + (id % 1000) / 1000.0 AS lon, 44.4 + (id % 700) / 1000.0 AS lat FROM det), p AS (SELECT *, radians(lat) AS phi, radians(lon) AS lam FROM g), t AS (SELECT *, tan(pi() / 4 - phi / 2) / pow((1 - {geo.E} * sin(phi)) / (1 + {geo.E} * sin(phi)), {geo.E / 2}) AS tt FROM p), r AS (SELECT *, {geo.C} * pow(tt, {geo.N}) AS rho FROM t)"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).select("id", (F.lit(-1.2) + F.col("id") % 1000 / 1000.0).alias("lon"), (F.lit(44.4) + F.col("id") % 700 / 1000.0).alias("lat"))
    x, y = geo.forward(F.col("lon"), F.col("lat"))
    return d.select("id", "lon", "lat", x.alias("x"), y.alias("y"))


@query(f"{_PLACED} SELECT id, round({geo.X0} + rho * sin({geo.N} * (lam - {geo.LON0})), 2) AS x, round({geo.YS} - rho * cos({geo.N} * (lam - {geo.LON0})), 2) AS y FROM r")
def project_l93(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select("id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


@query(f"{WITH} SELECT id, round(-1.2 + (id % 1000) / 1000.0, 6) AS lon, round(44.4 + (id % 700) / 1000.0, 6) AS lat FROM det")
def unproject_l93(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = geo.inverse(F.col("x"), F.col("y"))
    return _places(spark, sf_dir).select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))
