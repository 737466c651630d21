"""Dense and large tables: what is found among many points is what comparing all of them finds."""

import glob
import os
import random
import re

import pytest

from emberline.operators import envelopes, neighbours, passes, shapes
from emberline.plans import support_queries
from emberline.sources import tables


@pytest.fixture(scope="module")
def crowd(spark):
    """Points of a few passes: crowded, shared places, edges of a crowd, and scattered ones."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        m = rng.choice([0, 3, 48, 96, 99, 400, 1000])
        wide = rng.choice([60, 900, 900, 40_000])
        rows.append((i, m, rng.randrange(-wide, wide), rng.randrange(-wide, wide), rng.choice(["VIIRS", "MODIS"]), f"p{m}", m // 48, "N"))
    return spark.createDataFrame(rows, "id long, m long, x long, y long, instrument string, pass_id string, slot long, satellite string").repartition(3).cache()


def test_with_neighbours_against_counts(crowd):
    radii = {"VIIRS": 750, "MODIS": 1500}
    for how in ({"on": "m"}, {"minutes": 90}):
        want = {r.id: (r.n > 0, r.past > 0) for r in neighbours.neighbour_counts(crowd, radii, **how).collect()}
        got = {r.id: (r.near, r.past) for r in neighbours.with_neighbours(crowd, radii, **how).collect()}
        assert got == want and 50 < sum(n for n, _ in want.values()) < 850


def test_support_compares_no_crowds(spark):
    """4,000 points of one pass within 500 m: 16 million pairs, of which support needs none."""
    rows = spark.range(4000).selectExpr("id", "id % 3 * 3 AS m", "id * 7919 % 353 AS x", "id * 104729 % 347 AS y", "'VIIRS' AS instrument")
    out = support_queries.supported(rows)
    assert {tuple(r) for r in out.groupBy("support_class", "causal_class").count().collect()} == {("same_pass", "same_pass", 4000)}
    last = sorted(glob.glob(f"{tables.shared_dir(spark)}/neighbour-boxes-*"), key=os.path.getmtime)[-2:]
    assert [spark.read.parquet(d).filter("NOT sure").count() for d in last][0] == 0 and spark.read.parquet(last[1]).count() < 40_000


def test_nearest_among_crowds(crowd):
    rows = crowd.collect()
    want = {}
    for a in rows:
        d = [(a.x - b.x) ** 2 + (a.y - b.y) ** 2 for b in rows if b.id != a.id and b.pass_id == a.pass_id]
        want[a.id] = min(d) ** 0.5
    got = {r.id: r.d for r in passes.nearest(crowd).collect()}
    assert got == want


def test_reach_follows_density(spark):
    """In a crowd the first look is short: with 2,500 m every point would be compared with all others of its pass."""
    places = spark.range(20_000).selectExpr("'p' AS pass_id", "id * 7919 % 4001 AS x", "id * 104729 % 4003 AS y")
    assert passes._first_reach(places) < 100 and passes._first_reach(places.limit(8)) == passes.REACH


def test_supported_compares_no_crowds(spark, crowd):
    rows = crowd.collect()
    want = {a.id for a in rows if any(b.id != a.id and b.slot == a.slot and (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 4_000_000 for b in rows)}
    assert {r.id for r in envelopes.same_pass_supported(crowd).collect()} == want and 0 < len(want) < len(rows)
    last = max(glob.glob(f"{tables.shared_dir(spark)}/neighbour-boxes-*"), key=os.path.getmtime)
    assert spark.read.parquet(last).filter("NOT sure").count() < len(rows)


def test_first_times_against_all_cells(spark, crowd):
    rng = random.Random(9)
    rows = [(rng.randrange(2), rng.randrange(40), rng.randrange(-900, 900), rng.randrange(-900, 900), rng.choice(["VIIRS", "MODIS"])) for _ in range(120)]
    want = {}
    for k, m, x, y, instrument in rows:
        rad = 750 if instrument == "MODIS" else 300
        for r in range((y - rad) // 50 - 1, (y + rad) // 50 + 2):
            for c in range((x - rad) // 50 - 1, (x + rad) // 50 + 2):
                if (r * 50 + 25 - y) ** 2 + (c * 50 + 25 - x) ** 2 <= rad * rad:
                    want[k, r, c] = min(m, want.get((k, r, c), m))
    pts = spark.createDataFrame(rows, "cluster long, m long, x long, y long, instrument string")
    assert {(r.cluster, r.r, r.c): r.m for r in shapes._first_times(pts, 50).collect()} == want
    dense = spark.range(30_000).selectExpr("0L AS cluster", "id % 50 AS m", "id * 7919 % 501 AS x", "id * 104729 % 503 AS y", "'MODIS' AS instrument")
    assert shapes._first_times(dense, 50).count() > 900
    opened = max(glob.glob(f"{tables.shared_dir(spark)}/envelope-open-*"), key=os.path.getmtime)
    assert spark.read.parquet(opened).count() < 30_000  # each point by itself reaches about 700 cells


def test_broadcasts_stay_small(spark):
    from emberline import catalog

    name, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set(name, "10485760b")
        catalog.queries()["campaign_filter"](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(name)) == tables.BROADCAST_BYTES
        spark.conf.set(name, "20m")
        catalog.queries()["campaign_filter"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(name) == "20m"
    finally:
        spark.conf.set(name, was)


def test_no_limit_of_broadcasts(spark):
    """-1, by which sessions forbid broadcasts, is a limit like others."""
    from emberline import catalog

    name, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set(name, "-1")
        assert catalog.queries()["campaign_filter"](spark, "/root/testdata/sf0.001").count() > 0 and spark.conf.get(name) == "-1"
    finally:
        spark.conf.set(name, was)


#: Joins by pass: cells with a table of passes, and two tables of passes.
BY_PASS = r"BroadcastHashJoin \[p#\d+L\], \[p#\d+L\], \w+, BuildRight|BroadcastHashJoin \[[\w(]*(hours|pass_id|category#\d+, p)#"


@pytest.fixture(scope="module")
def joins(spark):
    """query -> the joins by broadcast that it, the steps it starts from and the queries asked for before it plan where the
    session allows broadcasts of any size, but those by pass and products with a single row."""
    from pyspark.sql.readwriter import DataFrameWriter

    from emberline import catalog

    found, steps = [], {}
    name, was, write = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), DataFrameWriter.parquet

    def planned(df):
        found.extend(re.findall(r"BroadcastHashJoin \[.*", df._jdf.queryExecution().sparkPlan().toString()))

    def parquet(self, *a, **k):
        planned(self._df)
        return write(self, *a, **k)

    def of(query):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", parquet)
            m.setattr(tables, "_steps", steps)
            planned(catalog.queries()[query](spark, "/root/testdata/sf0.001"))
        return [x for x in found if not re.match(BY_PASS, x)]

    try:
        spark.conf.set(name, "1g")
        yield of
    finally:
        spark.conf.set(name, was)


#: In this order, as each starts from steps of those before it.
GROWN = [
    "support_class_counts",
    "remove_small_components",
    "mask_boundary",
    "masks_within_2000m",
    "boundary_speed",
    "speed_percentiles",
    "progression_stats",
    "polygon_parts",
    "mask_equality",
    "arrival_surface",
    "arrival_step_area",
    "audit_alerts",
    "audit_checks",
    "audit_category_summary",
]


@pytest.mark.parametrize("query", GROWN)
def test_growing_tables_are_never_broadcast(joins, query):
    assert joins(query) == []
