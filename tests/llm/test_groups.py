import random

import numpy as np
import pytest

from roadloom.llm.groups import connected_groups, local_roots, road_groups
from tests.conftest import rows


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s, a, b in edges:
        if None not in (s, a, b):
            x, y = find((s, a)), find((s, b))
            parent[max(x, y)] = min(x, y)
    return sorted(((s, v, find((s, v))[1]) for s, v in list(parent)), key=str)


def graph(spark, edges):
    return spark.createDataFrame(edges, "s long, a long, b long")


def test_local_roots():
    assert local_roots(np.array([5, 1, 3]), np.array([3, 2, 4]), 7).tolist() == [0, 1, 1, 3, 3, 3, 6]
    assert local_roots(np.zeros(0, int), np.zeros(0, int), 3).tolist() == [0, 1, 2]


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_against_union_find(spark, kind):
    rng = random.Random(kind)
    if kind == "chain":  # in order, the worst numbering for minimum labels
        edges = [(1, i, i + 1) for i in range(300)]
    elif kind == "star":  # one road in all pairs of a map
        edges = [(1, 150, i) for i in range(300)] + [(2, i, i) for i in range(5)]
    else:
        edges = [(rng.randint(1, 4), rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(150)]
    assert rows(connected_groups(graph(spark, edges), "s", "a", "b", cell_edges=25)) == brute(edges)


def test_defined_cases(spark):
    edges = [(1, 2, 2), (1, 3, None), (None, 4, 5), (1, 9, 8), (1, 8, 9), (1, 9, 8), (2, 9, 7), (1, 2**62, -(2**62))]
    assert rows(connected_groups(graph(spark, edges), "s", "a", "b")) == brute(edges)
    assert connected_groups(graph(spark, edges).limit(0), "s", "a", "b").count() == 0
    wide = spark.createDataFrame([(1, 2, 3, "x")], "s long, a long, b long, vertex string")
    assert rows(connected_groups(wide, "s", "a", "b")) == [(1, 2, 2), (1, 3, 2)]


def test_road_pairs(spark):
    import datetime as d

    t = [d.datetime(2024, 1, k) for k in (1, 2)]
    data = [
        (1, 1, " 07", "8", None, t[0]), (2, 1, "8", " ", "9", t[0]), (3, 1, "10", "x", "9", t[0]), (4, 1, "11", None, None, t[0]), (5, 1, "12", "12", "1", t[0]),
        (6, 1, "20", "21", None, t[0]), (6, 1, "20", "22", None, t[1]), (7, 2, "7", "8", None, t[0]), (7, 2, "7", "8", None, t[0]),
    ]
    df = spark.createDataFrame(data, "connection_id long, map_id long, incoming_road string, connecting_road string, linked_road string, loaded_at timestamp_ntz")
    assert rows(road_groups(df)) == sorted([(1, 7, 7), (1, 8, 7), (1, 9, 7), (1, 12, 12), (1, 20, 20), (1, 22, 20), (2, 7, 7), (2, 8, 7)], key=str)
