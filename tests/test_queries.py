"""Queries over small tables of their own, compared with brute force."""

import random

import numpy as np
import pytest

from roadloom.functions import geo as G
from roadloom.operators.projection import fit_projection
from roadloom.plans.registry import QUERIES
from tests.conftest import rows


def graph_tables(spark, at, edges):
    """The road and junction_connection tables of maps with edges (map, from, to)."""
    every = sorted({(m, r) for m, a, b in edges for r in (a, b)})
    spark.createDataFrame([(m, str(r)) for m, r in every], "map_id long, road_id string").selectExpr("*", "'' as name", "1.0d as length", "cast(null as string) as junction", "timestamp'2024-01-01' as loaded_at", "cast(null as timestamp) as deleted_at").write.parquet(f"{at}/road.parquet")
    c = spark.createDataFrame([(i, m, str(a), str(b)) for i, (m, a, b) in enumerate(edges)], "connection_id long, map_id long, incoming_road string, connecting_road string")
    c.selectExpr("*", "'1' as junction_id", "'0' as conn_id", "timestamp'2024-01-01' as loaded_at").write.parquet(f"{at}/junction_connection.parquet")


def ends_within(start, after, links):
    front = {start}
    for _ in range(links):
        if any(not after.get(q) for q in front):
            return True
        front = {n for q in front for n in after[q]}
    return False


def test_dead_end_ahead_looks_forty_links_far(spark, tmp_path):
    rng = random.Random(10)
    edges = [(1, k, k + 1) for k in range(60)] + [(2, 100, 101), (2, 101, 100)]  # a chain and a circle
    edges += [(3, k, (k + 1) % 50) for k in range(50)] + [(3, 7, 60), (3, 30, 31)]  # a ring with one way out
    edges += sorted({(4, *rng.sample(range(40), 2)) for _ in range(55)})
    graph_tables(spark, str(tmp_path), edges)
    after = {}
    for m, a, b in edges:
        after.setdefault((m, a), set()).add((m, b))
    want = [(m, r, ends_within((m, r), after, 40)) for m, r in {(m, r) for m, a, b in edges for r in (a, b)}]
    got = rows(QUERIES["g10_dead_end_ahead"](spark, str(tmp_path)).select("map_id", "wp_id", "dead_end"))
    assert got == sorted(want, key=str)
    assert (1, 21, True) in got and (1, 20, False) in got


def test_every_map_is_fitted_in_its_own_zone(spark, tmp_path):
    rng = np.random.default_rng(42)
    nodes, want = [], {}
    for m, (lat, lon, t, noise) in enumerate([(-33.9, 151.2, G.Tmerc.utm(56, True), 0), (35.6, -122.1, G.Tmerc.utm(10), 0), (49.0, 8.4, None, 0), (11.0, 23.0, G.Tmerc.utm(34), 0), (11.0, 179.9, G.Tmerc.utm(60), 0), (11.0, 23.0, G.Tmerc.utm(34), 5), (52.0, 5.9, G.Tmerc.utm(32), 0)]):
        lat, lon = lat + rng.random(40) / 100, lon + rng.random(40) / 100
        x, y = t.forward(lat, lon, G.NUMBERS) if t else G.web_mercator(lat, lon, G.NUMBERS)
        x = x - 1234.5 + rng.normal(0, noise, 40)
        places = list(zip(*(v.tolist() for v in (lat, lon, x, y + 77.25))))
        nodes += [(m, k, a, b, repr(c), repr(d)) for k, (a, b, c, d) in enumerate(places)]
        fit = fit_projection(spark.createDataFrame(places, "lat double, lon double, x double, y double"))
        want[m] = fit.source if fit else None
    nodes += [(7, 1, 1.0, 2.0, "3", "4"), (7, 2, None, 2.0, "3", "4"), (8, 1, 1.0, 2.0, "east", "4")]
    df = spark.createDataFrame(nodes, "map_id long, node_id long, lat double, lon double, local_x string, local_y string")
    df.selectExpr("*", "'0' as ele", "timestamp'2024-01-01' as loaded_at").write.parquet(f"{tmp_path}/osm_node.parquet")
    got = {r["map_id"]: r for r in QUERIES["a42_projection_fit"](spark, str(tmp_path)).collect()}
    assert [want[m] for m in range(7)] == ["fit-utm56S", "fit-utm10N", "fit-webmercator", "fit-utm34N", "fit-utm60N", None, "fit-utm32N"]
    assert {m: r["source"] for m, r in got.items()} == want | {7: None, 8: None}
    assert got[5]["candidate"] is not None and got[5]["rmse"] > 1 and got[5]["max_error"] > got[5]["rmse"]
    assert all(got[m]["max_error"] == pytest.approx(0.0, abs=1e-3) for m in want if want[m])
    assert [got[m]["nodes"] for m in (0, 7, 8)] == [40, 1, 0]


def test_node_samples_are_up_to_two_thousand_a_map(spark, tmp_path):
    n = spark.range(5000).selectExpr("1L as map_id", "id as node_id", "1.0d as lat", "2.0d as lon", "'3' as local_x", "'4' as local_y", "'0' as ele", "timestamp'2024-01-01' as loaded_at")
    n.write.parquet(f"{tmp_path}/osm_node.parquet")
    assert sorted(r["node_id"] for r in QUERIES["s15_node_samples"](spark, str(tmp_path)).collect()) == list(range(0, 5000, 2))


def test_only_ends_beyond_thirty_metres_are_cut(spark, tmp_path):
    now = ["timestamp'2024-01-01' as loaded_at", "cast(null as timestamp) as deleted_at"]
    metres = {1: [0, 10, 20, 30], 2: [0, 1, 2, 42], 3: [0, 40, 41, 42, 90]}  # steps of 10 m stay, steps of over 30 m at the ends go
    nodes = [(m, 10 * m + k, at / 111319.49, 0.0) for m in metres for k, at in enumerate(metres[m])]
    spark.createDataFrame(nodes, "map_id long, node_id long, lat double, lon double").selectExpr("*", "'1' as local_x", "'1' as local_y", "'0' as ele", now[0]).write.parquet(f"{tmp_path}/osm_node.parquet")
    ways = [(m, 5, [(str(10 * m + k),) for k in range(len(metres[m]))]) for m in metres]
    spark.createDataFrame(ways, "map_id long, way_id long, nd array<struct<ref:string>>").selectExpr("*", "'' as way_type", "'' as subtype", "'' as lane_change", *now).write.parquet(f"{tmp_path}/osm_way.parquet")
    rel = spark.createDataFrame([(m, 7) for m in metres], "map_id long, rel_id long")
    rel.selectExpr("*", "'lanelet' as rel_type", "'walkway' as subtype", "'' as location", "'' as one_way", "'' as speed_limit", "cast(null as string) as turn_direction", *now).write.parquet(f"{tmp_path}/osm_relation.parquet")
    rel.selectExpr("map_id as member_id", "*", "0 as seq", "'way' as mtype", "'5' as ref", "'left' as role", now[0]).write.parquet(f"{tmp_path}/osm_member.parquet")
    got = QUERIES["f13_repaired_ends"](spark, str(tmp_path)).select("map_id", "ways_trimmed", "endpoints_dropped")
    assert rows(got) == [(2, 1, 1), (3, 1, 2)]
