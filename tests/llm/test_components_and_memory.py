"""What keeps the driver small in near-dedup: components that need no steps, and memory given back."""

import random

from emberline.llm import graph
from emberline.sources import tables


def _components(spark, edges):
    return sorted(map(tuple, graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()))


def test_stars_need_no_steps(spark, monkeypatch):
    """Components found before, as edges, are handed back as they are, whichever way the edges point."""

    def never(_):
        raise AssertionError("a step of edges that are stars")

    monkeypatch.setattr(graph, "_large_star", never)
    stars = [(i, i // 10 * 10) for i in range(40)]
    assert _components(spark, stars) == _components(spark, [(b, a) for a, b in stars]) == stars
    assert _components(spark, []) == []


def test_components_of_components_and_more_edges(spark):
    rng = random.Random(8)
    for _ in range(3):
        edges = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(50)]
        root = {x: x for e in edges for x in e if e[0] != e[1]}
        for _ in root:
            for a, b in edges:
                if a != b:
                    root[a] = root[b] = min(root[a], root[b])
        first = _components(spark, edges[:25])
        assert _components(spark, edges) == _components(spark, first + edges[25:]) == sorted(root.items())


def test_release_trims_the_drivers_jvm(spark):
    said = tables.trim_driver(spark)
    assert "Trim native heap" in said
