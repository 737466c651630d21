"""Hand fixtures and stated invariants of the detection engine."""

import math

import duckdb
import pytest

from emberline import catalog
from emberline.functions import geo
from emberline.operators import grid, passes, progression, shapes
from emberline.plans import support_queries

SF = "/root/testdata/sf0.001"
FIXTURE = [
    (1, "N20", "VIIRS", 720, 0, 0), (2, "N20", "VIIRS", 720, 600, 0), (3, "N20", "VIIRS", 720, 3000, 0), (4, "Terra", "MODIS", 768, 1400, 0), (5, "N21", "VIIRS", 810, 4000, 0),
    (6, "N20", "VIIRS", 822, 600, 100), (7, "N20", "VIIRS", 1200, 9000, 9000), (8, "N20", "VIIRS", 1215, 9000, 9500), (9, "N20", "VIIRS", 1231, 9000, 10600),
]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(FIXTURE, "id long, satellite string, instrument string, m long, x long, y long").cache()


def test_neighbours(points):
    got = [{r.id: r.n for r in f.collect()} for f in (support_queries.same_pass(points), support_queries.temporal(points), support_queries.temporal(points, True))]
    assert [got[0][i] for i in range(1, 10)] == [1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert [got[1][i] for i in range(1, 10)] == [0, 1, 1, 4, 1, 1, 1, 1, 0]
    assert [got[2][i] for i in range(1, 10)] == [0, 0, 0, 3, 1, 1, 0, 1, 0]


def test_classes(points):
    rows = {r.id: (r.support_class, r.causal_class) for r in support_queries.supported(points).collect()}
    assert rows[1] == ("same_pass", "same_pass") and rows[3] == ("temporal_only", "isolated") and rows[4] == ("temporal_only", "past_confirmed") and rows[9] == ("isolated", "isolated")


def test_passes(points):
    s = passes.sessionize(points)
    got = {r.id: r.pass_id for r in s.collect()}
    assert got[1] == got[2] == got[3] == "N20_VIIRS_001" and got[6] == "N20_VIIRS_002" and got[7] == got[8] == "N20_VIIRS_003" and got[9] == "N20_VIIRS_004" and got[4] == "Terra_MODIS_001"
    r = {x.pass_id: x for x in passes.regularize(passes.nearest_stats(s)).collect()}
    a = r["N20_VIIRS_001"]
    assert (a.mean, a.med, a.p75, a.p90) == (1200, 600, 1500, 2040) and round(a.distance, 1) == 463.6 and round(a.weight, 3) == 0.091
    assert r["Terra_MODIS_001"].distance == 1112.0 and r["N21_VIIRS_001"].distance == 430.0 and r["N21_VIIRS_001"].distance_source == "instrument_fallback"


def test_projection(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(3.0, 46.5), (-1.2, 44.9)], "lon double, lat double")
    x, y = geo.forward(F.col("lon"), F.col("lat"))
    rows = df.select(x.alias("x"), y.alias("y")).collect()
    assert rows[0].x == pytest.approx(700000) and rows[0].y == pytest.approx(6600000)
    assert rows[1].x == pytest.approx(368608.176729, abs=1e-5) and rows[1].y == pytest.approx(6431127.751845, abs=1e-5)


def test_kernels():
    w = dict(grid.gaussian_weights(2.4))
    assert len(w) == 21 and w[0] == pytest.approx(0.16622769853894057) and w[10] == pytest.approx(2.823488e-05, rel=1e-5)
    assert [len(grid.disc(r)) for r in (6, 8, 11)] == [113, 197, 377]
    assert len(set(grid.label_cells({(0, 0), (1, 1)}).values())) == 2


def test_boundary(spark):
    cells = spark.createDataFrame([(1, r, c) for r in range(5) for c in range(5)] + [(2, r, c) for r in range(2) for c in range(2)], "p long, r long, c long")
    n = {r.p: r["count"] for r in grid.boundary(cells).groupBy("p").count().collect()}
    assert n == {1: 16, 2: 4}


def _block(r, c):
    return {(r + i, c + j) for i in range(3) for j in range(3)}


def test_fold():
    a, b, near_b, far = _block(0, 0), _block(20, 0), _block(24, 0), _block(100, 0)
    out = progression.fold([(1, 0, a), (2, 2, b), (3, 4, near_b), (4, 5, far), (5, 13, far)])
    assert [x["confirmed"] for x in out] == [9, 0, 18, 0, 9] and [x["pending"] for x in out] == [0, 1, 0, 1, 0]
    late = progression.fold([(1, 0, a), (4, 5, far), (5, 13 + 1 / 60, far)])
    assert late[2]["expired"] == 1 and late[2]["provisional"] == 9 and late[2]["pending"] == 1


def test_regions_fold_like_one(spark):
    import random

    rng = random.Random(3)
    runs = [(p, p * 0.8, set().union(*[_block(rng.randrange(0, 120), rng.randrange(0, 120)) for _ in range(3)])) for p in range(12)]
    cells = spark.createDataFrame([(p, r, c) for p, _, x in runs for r, c in x], "p long, r long, c long")
    hours = spark.createDataFrame([(p, h) for p, h, _ in runs], "p long, hours double")
    folded = progression.progression(cells, hours).cache()
    got = {r.p: r.asDict() for r in progression.counts(folded).collect()}
    made = {}
    for r in progression.categories(folded).collect():
        made.setdefault((r.p, r.category), set()).add((r.r, r.c))
    for row in progression.fold(runs):
        kinds = row.pop("cells")
        assert {k: got[row["p"]][k] for k in row} == row
        assert all(made.get((row["p"], k), set()) == v for k, v in kinds.items())


def test_streaming_twins(spark):
    from emberline.streaming import twins

    df = spark.createDataFrame([(1, "A", "VIIRS", "2024-01-01 00:00:00", 1.0), (2, "A", "VIIRS", "2024-01-01 00:15:00", 2.0), (3, "A", "VIIRS", "2024-01-01 00:31:00", 3.0)], "id long, satellite string, instrument string, t string, frp double").selectExpr("*", "cast(t AS timestamp) AS ts")
    assert sorted(r.n for r in twins.pass_sessions(df).collect()) == [1, 2]
    assert twins.class_counts(df).collect()[0].n == 3


def _canon(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.sql(catalog.oracle_sql()[name])
    assert not [t for t in want.types if "DECIMAL" in str(t)]
    assert cols == sorted(want.columns)
    order = [want.columns.index(c) for c in cols]
    assert _canon(tuple(r) for r in df.select(*cols).collect()) == _canon(tuple(r[i] for i in order) for r in want.fetchall())


def test_invariants(spark):
    q = catalog.queries()
    sym = {r.id: r.n for r in q["temporal_neighbours"](spark, SF).collect()}
    assert all(r.n <= sym[r.id] for r in q["past_temporal_neighbours"](spark, SF).collect())
    one, three = ({r.p: r.cells for r in q[n](spark, SF).collect()} for n in ("front_projection_1h", "front_uncertainty_3h"))
    assert all(three[p] >= n for p, n in one.items())
    assert not math.isnan(sum(r.distance_regularized_m for r in q["distance_regularized"](spark, SF).collect()))


def test_normalised_smooth(spark):
    cells = spark.createDataFrame([(1, 0, 0, 100.0), (1, 0, 1, 300.0), (1, 0, 30, 7.0)], "p long, r long, c long, v double")
    at = spark.createDataFrame([(1, 0, 0), (1, 0, 30), (1, 60, 60), (2, 0, 0)], "p long, r long, c long")
    got = {(r.p, r.r, r.c): r.v for r in grid.normalised_smooth(cells, at, 1.5).collect()}
    near = math.exp(-0.5 / 1.5**2)
    assert got[1, 0, 0] == pytest.approx((100 + 300 * near) / (1 + near)) and got[1, 0, 30] == pytest.approx(7)
    assert got[1, 60, 60] == got[2, 0, 0] == 0


def test_projection_stays_without_speed(spark):
    from pyspark.sql import functions as F

    from emberline.plans import grid_queries

    mask = spark.createDataFrame([(1, 0, 0), (1, 0, 1)], "p long, r long, c long")
    still = spark.createDataFrame([(1, 0, 0, 0.0), (1, 0, 1, 1000.0)], "p long, r long, c long, speed double")
    cells = {(r.r, r.c) for r in grid_queries.project(mask, still, 1).collect()}
    assert cells == {(0, 0), (0, 1), (0, 2)} | {(1, 1), (-1, 1)}
    wide = spark.createDataFrame([(600.0,), (5000.0,), (1000.0,)], "d double").select(grid_queries.correspondence_m(F.col("d")).alias("w")).collect()
    assert [r.w for r in wide] == [1000, 2500, 1500]


def test_rings():
    square = {(r, c) for r in range(3) for c in range(3)}
    assert shapes.rings(square) == [[(3, 0), (3, 3), (0, 3), (0, 0), (3, 0)]] or shapes.area2(shapes.rings(square)[0]) == 18
    outer, hole = shapes.rings(square - {(1, 1)})
    assert shapes.area2(outer) == 18 and shapes.area2(hole) == -2 and len(hole) == 5
    # a hole that touches the outside at a corner is a hole of its own; no ring meets itself
    ring = {(r, c) for r in range(4) for c in range(4)} - {(1, 1), (0, 0)}
    found = shapes.rings(ring)
    assert [shapes.area2(x) for x in found] == [30, -2] and all(len(set(x)) == len(x) - 1 for x in found)


def test_rings_cover_their_cells():
    import random

    rng = random.Random(5)
    for _ in range(60):
        cells = {(rng.randrange(9), rng.randrange(9)) for _ in range(50)}
        label = grid.label_cells(cells)
        for root in set(label.values()):
            part = {k for k, v in label.items() if v == root}
            found = shapes.rings(part)
            assert sum(map(shapes.area2, found)) == 2 * len(part) and [shapes.area2(x) > 0 for x in found] == [True] + [False] * (len(found) - 1)
            assert all(len(set(x)) == len(x) - 1 for x in found)


def test_envelope_times(spark):
    pts = spark.createDataFrame([(1, 0, 25, 25, "VIIRS"), (1, 60, 725, 25, "VIIRS"), (1, 90, 25, 25, "VIIRS"), (2, 5, 25, 25, "MODIS")], "cluster long, m long, x long, y long, instrument string")
    got = {(r.cluster, r.r, r.c): r.m for r in shapes.envelope_times(pts).collect()}
    one = len(grid.disc(6))
    assert sum(k[0] == 1 and m == 0 for k, m in got.items()) == one and sum(k[0] == 2 for k in got) == len(grid.disc(15))
    assert got[1, 0, 7] == 60  # the gap between two discs is closed once both are there
    assert got[1, 0, 0] == 0 and (1, 6, 7) not in got


def test_feature_is_a_polygon(spark):
    import json

    from emberline.plans import web_queries

    row = web_queries._features(spark, SF).filter("p = 3").first()
    shape = json.loads(row.feature)["geometry"]
    assert shape["type"] == "MultiPolygon" and shape["coordinates"][0][0][0] == shape["coordinates"][0][0][-1]
    lon, lat = shape["coordinates"][0][0][0]
    assert -4 < lon < 2 and 42 < lat < 47
