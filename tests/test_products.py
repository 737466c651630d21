"""Sinks, readers, identity, outlines, categories and streams, on hand fixtures and against brute force."""

import itertools
import random

import pytest

from emberline.functions import times
from emberline.operators import envelopes, grid, passes, progression, shapes
from emberline.sources import checks, detections, web
from emberline.streaming import twins


def test_times(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("2024-07-01T12:00:00+00:00",), ("2024-07-01T12:00:00",), ("2024-07-01T14:00:00+02:00",), ("x",), (None,)], "t string")
    ts = times.parsed_utc(F.col("t"))
    rows = df.select(times.iso_utc(ts).alias("u"), F.date_format(times.local(ts), "HH:mm").alias("l"), times.z_suffix(F.col("t")).alias("z"), times.since(ts, "2024-07-01T12:30:00").alias("s")).collect()
    assert [r.u for r in rows] == ["2024-07-01T12:00:00Z"] * 3 + [None, None] and rows[0].l == "14:00" and rows[0].z.endswith("Z") and rows[2].z.endswith("+02:00")
    assert rows[0].s is False and df.filter(times.since(ts, "auto")).count() == 5


def test_checks(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert checks.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="b, c"):
        checks.require_columns(df, ["b", "a", "c"])


def test_feeds(spark, tmp_path):
    head = "latitude,longitude,acq_date,acq_time,frp,scan,track,confidence,satellite,instrument\n"
    (tmp_path / "a.csv").write_text(head + "44.5,-1.0,2024-01-01,905,12.5,0.4,0.4,n,N20,VIIRS\n44.5,,2024-01-01,5,1,1,1,30,Terra,MODIS\n")
    (tmp_path / "empty.csv").write_text(head)
    paths = {n: str(tmp_path / f"{n}.csv") for n in ("a", "empty", "absent")}
    found, failed = detections.read_feeds(spark, paths)
    assert found.count() == 2 and set(failed) == {"empty", "absent"}
    with pytest.raises(RuntimeError, match="no feed"):
        detections.read_feeds(spark, {"empty": paths["empty"], "absent": paths["absent"]})
    assert detections.read_history(spark, paths["absent"], paths["a"], detections.FEED).count() == 2 and detections.read_history(spark, paths["absent"], paths["absent"], detections.FEED) is None


def test_geometry_round_trips(spark, tmp_path):
    from pyspark.sql import functions as F

    multi = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]]], [[[9.0, 9.0], [10.0, 9.0], [9.0, 10.0], [9.0, 9.0]]]]
    assert web.from_wkb(web.to_wkb(multi)) == multi and web.from_wkb(web.to_wkb([])) == []
    df = spark.createDataFrame([(1, multi), (2, [])], f"p long, coordinates {web.COORDINATES}")
    web.write_geometry(df, str(tmp_path / "g"), "p")
    web.write_geometry(df, str(tmp_path / "g"), "p")  # a layer is replaced
    assert {r.p: r.coordinates for r in web.read_geometry(spark, str(tmp_path / "g"), "p").collect()} == {1: multi, 2: []}
    features = df.withColumn("feature", web.feature(F.struct("p"), F.col("coordinates")))
    web.write_collection(features, str(tmp_path / "c"), F.struct(F.lit("é").alias("name")))
    back = web.read_features(spark, str(tmp_path / "c"), "p: bigint")
    assert {r.properties.p: r.coordinates for r in back.collect()} == {1: multi, 2: []}
    text = spark.read.text(str(tmp_path / "c")).first()[0]
    assert '"bbox":[0.0,0.0,10.0,10.0]' in text and '"name":"é"' in text
    (tmp_path / "p.json").write_text('{"type":"FeatureCollection",\n"features":[{"type":"Feature","properties":{"p":7},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    assert web.polygon_parts(web.read_features(spark, str(tmp_path / "p.json"), "p: bigint", whole=True)).count() == 1


def test_outlines():
    rng = random.Random(3)
    for _ in range(30):
        cells = {(rng.randrange(8), rng.randrange(8)) for _ in range(30)}
        label = grid.label_cells(cells)
        for root in set(label.values()):
            part = {c for c in cells if label[c] == root}
            polygon = shapes.rings(part)
            assert shapes.inside(polygon) == part
            corners = sum(len(r) - 1 for r in polygon)
            n = {(r + i, c + j): [(r + i - a, c + j - b) for a, b in itertools.product((0, 1), (0, 1)) if (r + i - a, c + j - b) in part] for r, c in part for i, j in itertools.product((0, 1), (0, 1))}
            want = sum(1 if len(v) in (1, 3) else 2 if len(v) == 2 and v[0][0] != v[1][0] and v[0][1] != v[1][1] else 0 for v in n.values())
            assert corners == want
    ring = [(0, 0), (1, 0.01), (2, 0), (2, 2), (1, 2.3), (0, 2), (0, 0)]
    assert shapes.simplified(ring, 0.1) == [(0, 0), (2, 0), (2, 2), (1, 2.3), (0, 2), (0, 0)]
    assert len(shapes.simplified(ring, 100)) >= 4 and shapes.simplified(ring, 100)[0] == shapes.simplified(ring, 100)[-1]


def test_matching_against_greedy(spark):
    rng = random.Random(5)
    rows = [(o, n, rng.randrange(1, 5), rng.choice([0.1, 0.25, 0.5])) for o in range(12) for n in range(100, 112) if rng.random() < 0.4]
    shared = spark.createDataFrame(rows, "old_cluster long, new_cluster long, cells long, iou double")
    used, want = set(), {}
    for _, _, o, n in sorted(((c, i, o, n) for o, n, c, i in rows), reverse=True):
        if o not in used and n not in want:
            used.add(o)
            want[n] = o
    assert {r.new_cluster: r.old_cluster for r in envelopes.match_one_to_one(shared).collect()} == want


def test_ids_fall_back_in_order(spark):
    new = spark.createDataFrame([(1,), (2,), (3,), (4,), (9,)], "cluster long")
    matched = spark.createDataFrame([(4, 1)], "new_cluster long, old_cluster long")
    got = {r.new_cluster: (r.id, r.how) for r in envelopes.assign_ids(new, matched).collect()}
    # 1 is used, so the first takes 2, whose owner then takes 3, and so on
    assert got == {4: (1, "matched"), 1: (2, "free"), 2: (3, "free"), 3: (4, "free"), 9: (9, "own")}


def test_monotone_floor(spark):
    kind = "cluster long, r long, c long, m long"
    new, old = spark.createDataFrame([(1, 0, 0, 50), (1, 0, 1, 90)], kind), spark.createDataFrame([(1, 0, 0, 10), (1, 5, 5, 60)], kind)
    assert {(r.r, r.c): r.m for r in envelopes.monotone_floor(new, old).collect()} == {(0, 0): 10, (0, 1): 90, (5, 5): 60}
    with pytest.raises(ValueError, match="before the old one"):
        envelopes.monotone_floor(old, new)
    assert envelopes.monotone_floor(new, old.limit(0)).count() == 2


def test_categories(spark):
    block = lambda r, c: {(r + i, c + j) for i in range(3) for j in range(3)}
    runs = {1: block(0, 0), 2: block(20, 0), 3: block(24, 0) | block(0, 3), 4: block(100, 0), 5: block(100, 0) | {(50, 50)}}
    cells = spark.createDataFrame([(p, r, c) for p, s in runs.items() for r, c in s], "p long, r long, c long")
    hours = spark.createDataFrame([(1, 0.0), (2, 2.0), (3, 4.0), (4, 5.0), (5, 13.0)], "p long, hours double")
    folded = progression.progression(cells, hours).cache()
    got = {}
    for r in progression.categories(folded).collect():
        got.setdefault((r.p, r.category), set()).add((r.r, r.c))
    assert got[1, "confirmed"] == runs[1] and got[2, "provisional"] == runs[2] and got[3, "confirmed"] == block(20, 0) | block(24, 0) and got[3, "advance"] == block(0, 3)
    assert got[4, "provisional"] == runs[4] and got[5, "confirmed"] == runs[4]
    for p in runs:
        parts = [got.get((p, c), set()) for c in ("persistence", "advance", "provisional", "confirmed")]
        assert got.get((p, "observed_front"), set()) == set().union(*parts)
    rows = {r.p: r for r in progression.counts(folded).collect()}
    assert rows[3].confirmed == 18 and rows[3].confirmed_km2 == 1.125 and rows[5].pending == 0 and rows[4].pending == 1


def test_nearest_of_scattered_points(spark):
    rng = random.Random(2)
    pts = [(i, rng.choice([0, 9_000, 400_000]) + rng.randrange(3000), rng.randrange(100), f"p{i % 3}") for i in range(40)] + [(99, 5, 5, "lone"), (100, 0, 0, "two"), (101, 10**6, 0, "two")]
    got = {r.id: r.d for r in passes.nearest(spark.createDataFrame(pts, "id long, x long, y long, pass_id string")).collect()}
    for i, x, y, p in pts:
        want = min((((x - a) ** 2 + (y - b) ** 2) ** 0.5 for j, a, b, q in pts if q == p and j != i), default=None)
        assert got[i] == want or abs(got[i] - want) < 1e-9


def _stream(spark, tmp_path, name, df, parts=1):
    """A stream of df's rows, a file for each of its parts by order of ts."""
    path = str(tmp_path / name)
    rows = sorted(df.collect(), key=lambda r: r.ts)
    for k in range(parts):
        spark.createDataFrame(rows[k * len(rows) // parts : (k + 1) * len(rows) // parts], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name)


@pytest.fixture(scope="module")
def moving(spark):
    from pyspark.sql import functions as F

    rows = [(i, "N20" if i % 2 else "Terra", "VIIRS" if i % 2 else "MODIS", 60 * (i // 4) + i % 4 + 28_000_800, 100 * (i % 7), 50 * (i % 5), float(i % 9)) for i in range(40)]
    d = spark.createDataFrame(rows, "id long, satellite string, instrument string, m long, x long, y long, frp double")
    return d.withColumn("ts", F.timestamp_seconds(F.col("m") * 60)).cache()


def test_streams_say_what_batches_say(spark, tmp_path, moving):
    for name, f, mode in (("sessions", twins.pass_sessions, "complete"), ("counts", twins.class_counts, "complete"), ("recent", twins.recency_windows, "complete"), ("anchored", lambda d: twins.anchored_counts(d, "90 minutes"), "complete"), ("pairs", twins.past_confirmed, "append")):
        got = _run(f(_stream(spark, tmp_path, name, moving)), name, mode)
        assert sorted(map(str, got.collect())) == sorted(map(str, f(moving).collect())) and got.count() > 0
    assert {r.start.minute for r in twins.anchored_counts(moving, "90 minutes").collect()} == {30}


def test_repeated_rows_are_seen_once(spark, tmp_path, moving):
    twice = moving.union(moving)
    assert _run(twins.first_seen(_stream(spark, tmp_path, "twice", twice, 3), ["id"]), "twice").count() == 40


def test_archive(spark, tmp_path, moving):
    from pyspark.sql import functions as F

    path, add = str(tmp_path / "archive"), twins.append_archive(str(tmp_path / "archive"), ["id", "frp"])
    stream = _stream(spark, tmp_path, "batches", moving.union(moving.withColumn("frp", F.col("frp") + F.col("id") % 2)), 2)
    stream.writeStream.foreachBatch(add).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start().awaitTermination(120)
    view = twins.archive_view(spark.read.parquet(path), ["id"])
    assert {r.id: r.frp for r in view.collect()} == {i: i % 9 + i % 2 for i in range(40)}


def test_candidate_timers(spark, tmp_path):
    hour = lambda h: 3600 * h
    rows = [(1, 10, hour(1), 0, 0), (1, 11, hour(3), 3, 4), (1, 12, hour(4), 100, 0), (2, 20, hour(4), 0, 0), (1, 13, hour(13), 100, 1), (2, 21, hour(30), 500, 500), (1, 14, hour(40), 900, 900)]
    from pyspark.sql import functions as F

    starts = spark.createDataFrame(rows, "region long, candidate long, s long, r long, c long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = {(r.candidate, r.outcome) for r in _run(twins.candidate_timers(_stream(spark, tmp_path, "starts", starts, len(rows))), "starts").collect()}
    assert {(10, "confirmed"), (11, "confirmed"), (12, "expired"), (20, "expired")} <= got and not {(13, "confirmed"), (14, "confirmed")} & got


def test_frozen_maximum(spark):
    s = spark.createDataFrame([(1, 0, 0, 1.0, 1.0), (1, 0, 1, 0.1, 1.0), (2, 0, 0, 10.0, 10.0)], "p long, r long, c long, v double, pmax double")
    assert twins.robust_evidence(s, 1.0).count() == 2
    first = s.filter("p = 1").select("p", "r", "c", "v")
    assert grid.robust(first, frozen=1.0).count() == 1 and grid.robust(s.select("p", "r", "c", "v"), frozen=1.0).filter("p = 1").count() == 1


def test_counted_points_against_a_walk(spark):
    """In order: a point counts if supported, or within 3000 m of the footprint of one that counts already."""
    rng = random.Random(4)
    rows = [(rng.choice([1, 2]), i, rng.randrange(6), rng.randrange(0, 60_000), rng.randrange(0, 3000), rng.choice("AB"), rng.choice(["VIIRS", "MODIS"]), rng.random() < 0.1) for i in range(120)]
    kept, want = {1: [], 2: []}, []
    for c, i, m, x, y, _, kind, supported in sorted(rows, key=lambda r: (r[2], r[5], r[6], r[1])):
        if supported or any((x - a) ** 2 + (y - b) ** 2 <= (3000 + f) ** 2 for a, b, f in kept[c]):
            kept[c].append((x, y, 750 if kind == "MODIS" else 300))
            want.append((c, i, m, len(kept[c])))
    points = spark.createDataFrame(rows, "cluster long, id long, m long, x long, y long, satellite string, instrument string, supported boolean")
    assert sorted(map(tuple, envelopes.states(points).collect())) == sorted(want)
    assert sum(r[7] for r in rows) < len(want) < len(rows) and envelopes.states(points.filter("NOT supported")).count() == 0
