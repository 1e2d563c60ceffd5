import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roadloom.operators.nearby import close_nodes, points_in_boxes, points_in_rings, points_within
from tests.conftest import rows


def brute(points, r):
    out = set()
    for m, a, ax, ay in points:
        for n, b, bx, by in points:
            if m == n and a < b and (ax - bx) ** 2 + (ay - by) ** 2 <= r * r:
                out.add((m, a, b))
    return sorted(out, key=str)


@pytest.mark.parametrize("radius", [0.5, 0.37, 3.0])
def test_against_all_pairs(spark, radius):
    rng = random.Random(7)
    pts = [(rng.randint(1, 3), i, round(rng.uniform(-20, 20), 2), round(rng.uniform(-20, 20), 2)) for i in range(400)]
    pts += [(1, 1000 + i, 5.0, 5.0) for i in range(40)]  # a hot cell
    df = spark.createDataFrame(pts, "m long, i long, x double, y double")
    got = points_within(df, radius, "m", "i")
    assert rows(got.select("scope", "a", "b")) == brute(pts, radius)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 10**6), st.integers(-8, 8), st.integers(-8, 8)), min_size=1, max_size=30, unique_by=lambda t: t[1]))
def test_grid_points_on_the_limit(spark, pts):
    pts = [(m, i, x / 4, y / 4) for m, i, x, y in pts]
    df = spark.createDataFrame(pts, "m long, i long, x double, y double")
    assert rows(points_within(df, 0.5, "m", "i").select("scope", "a", "b")) == brute(pts, 0.5)


def test_unusable_and_far_points(spark):
    inf, nan = float("inf"), float("nan")
    pts = [(1, 1, 1e300, 0.0), (1, 2, 1e300, 0.0), (1, 3, inf, 0.0), (1, 4, inf, 0.0), (1, 5, nan, 0.0), (1, 6, None, 0.0), (None, 7, 0.0, 0.0), (1, None, 0.0, 0.0), (1, 8, -1e300, 0.0)]
    df = spark.createDataFrame(pts, "m long, i long, x double, y double")
    assert rows(points_within(df, 0.5, "m", "i")) == [(1, 1, 2, 0.0)]
    assert points_within(df.limit(0), 0.5, "m", "i").count() == 0
    with pytest.raises(ValueError):
        points_within(df, 0, "m", "i")


def test_points_in_boxes(spark):
    rng = random.Random(3)
    pts = [(1, i, rng.uniform(0, 30), rng.uniform(0, 30)) for i in range(200)]
    boxes = [(1, b, x, x + rng.uniform(0, 9), y, y + rng.uniform(0, 9)) for b in range(20) for x, y in [(rng.uniform(0, 25), rng.uniform(0, 25))]] + [(1, 99, 5.0, 1.0, 0.0, 1.0), (2, 98, 0.0, 30.0, 0.0, 30.0)]
    got = points_in_boxes(spark.createDataFrame(pts, "m long, i long, x double, y double"), spark.createDataFrame(boxes, "m long, b long, x_lo double, x_hi double, y_lo double, y_hi double"), 1.5, "m")
    want = [(i, b) for m, i, x, y in pts for n, b, x0, x1, y0, y1 in boxes if m == n and x0 <= x <= x1 and y0 <= y <= y1]
    assert rows(got.select("i", "b")) == sorted(want, key=str)
    clash = spark.createDataFrame(pts, "m long, i long, x double, b double").withColumnRenamed("x", "x")
    with pytest.raises(ValueError):
        points_in_boxes(clash, spark.createDataFrame(boxes, "m long, b long, x_lo double, x_hi double, y_lo double, y_hi double"), 1.5, "m", "x", "x")


def test_current_rows_and_notations(spark):
    import datetime as d

    t = [d.datetime(2024, 1, k) for k in (1, 2)]
    data = [(1, 1, " 1.0 ", "2", t[0]), (1, 2, "1.2e0", "2.1", t[0]), (1, 3, "1", "2", t[0]), (1, 3, "90", "2", t[1]), (1, 4, "1 m", "2", t[0]), (1, 5, "nan", "2", t[0]), (2, 6, "1", "2", t[0])]
    df = spark.createDataFrame(data, "map_id long, node_id long, local_x string, local_y string, loaded_at timestamp_ntz")
    assert rows(close_nodes(df)) == [(1, 1, 2)]


def test_far_from_the_origin(spark):
    """A millimetre radius at map coordinates, places beyond the cell range, and no cell that gathers them all."""
    rng = random.Random(2)
    pts = [(1, i, 5_000_000 + rng.randint(0, 400) / 1000, 9_000_000 + rng.randint(0, 40) / 1000) for i in range(300)]
    df = spark.createDataFrame(pts, "m long, i long, x double, y double")
    assert rows(points_within(df, 0.0015, "m", "i").select("scope", "a", "b")) == brute(pts, 0.0015)
    far = [(1, i, 1e250 + i * 1e240, float(i % 3)) for i in range(60)] + [(1, 100 + i, 1e250, i / 4) for i in range(8)]
    df = spark.createDataFrame(far, "m long, i long, x double, y double")
    want = sorted(((1, a, b) for _, a, ax, ay in far for _, b, bx, by in far if a < b and ax == bx and abs(ay - by) <= 0.5), key=str)
    assert rows(points_within(df, 0.5, "m", "i").select("scope", "a", "b")) == want
    from roadloom.operators.nearby import _coded

    assert _coded(df, "x", "y", 0.5).select("_block").distinct().count() == 60  # one for every place along x


def test_regions_of_any_size(spark):
    rng = random.Random(4)
    pts = [(1, i, rng.uniform(-1e6, 1e6), rng.uniform(-1e6, 1e6)) for i in range(300)] + [(1, 1000, 1e300, 0.0)]
    boxes = [(1, b, x, x + w, y, y + w) for b in range(60) for x, y, w in [(rng.uniform(-1e6, 1e6), rng.uniform(-1e6, 1e6), 10 ** rng.uniform(0, 6.5))]] + [(1, 99, -1e300, 1e300, -1e300, 1e300), (1, 98, pts[0][2], pts[0][2], pts[0][3], pts[0][3])]
    got = points_in_boxes(spark.createDataFrame(pts, "m long, i long, x double, y double"), spark.createDataFrame(boxes, "m long, b long, x_lo double, x_hi double, y_lo double, y_hi double"), 1.0, "m")
    want = [(i, b) for m, i, x, y in pts for n, b, x0, x1, y0, y1 in boxes if m == n and x0 <= x <= x1 and y0 <= y <= y1]
    assert rows(got.select("i", "b")) == sorted(want, key=str)
    assert got.sparkSession.createDataFrame([], got.schema).count() == 0


def test_points_in_rings(spark):
    rings = [(1, 7, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]), (1, 8, [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]), (1, 9, []), (1, 10, None), (2, 11, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)])]
    pts = [(1, 1, 1.0, 1.0), (1, 2, 8.0, 1.0), (1, 3, 8.0, 8.0), (1, 4, None, 1.0), (2, 5, 5.0, 1.0)]
    got = points_in_rings(spark.createDataFrame(pts, "m long, i long, x double, y double"), spark.createDataFrame(rings, "m long, b long, ring array<struct<x:double,y:double>>"), 1.0, "m", "b")
    assert rows(got.select("i", "b")) == [(1, 7), (1, 8), (2, 8), (5, 11)]
