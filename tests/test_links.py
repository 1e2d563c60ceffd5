import random
import time

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadloom.functions import planview as V
from roadloom.functions import resample as R
from roadloom.operators import fidelity as D
from roadloom.operators import links as L
from roadloom.operators import passes as X
from roadloom.operators.components import components
from tests.conftest import rows


def test_components(spark):
    edges = [("m", f"{i:03d}", f"{i + 1:03d}") for i in range(120)] + [("m", "500", "500"), ("n", "001", "002"), ("n", None, "003"), (None, "1", "2")]
    got = rows(components(spark.createDataFrame(edges, "s string, a string, b string"), "s", "a", "b"))
    assert got == sorted([("m", f"{i:03d}", "000") for i in range(121)] + [("m", "500", "500"), ("n", "001", "001"), ("n", "002", "001")], key=str)


def stub_loop(edges):
    """Promotion one after the other, until nothing changes."""
    out, inn = {}, {}
    for e in edges:
        out.setdefault(e[:2], []).append(e)
        inn.setdefault(e[2:], []).append(e)
    stub = {e for e in edges if len(out[e[:2]]) > 1 or len(inn[e[2:]]) > 1}
    while True:
        slots = {}
        for e in edges:
            slots.setdefault((e[0], e[1] < 0), set()).add("junction" if e in stub else e[2])
        more = {e for e in edges if len(slots[e[0], e[1] < 0]) > 1} - stub
        if not more:
            return stub
        stub |= more


def test_edge_classes(spark):
    rng = random.Random(6)
    edges = sorted({(str(rng.randint(1, 8)), rng.choice([-2, -1, 1]), str(rng.randint(9, 16)), rng.choice([-1, 1])) for _ in range(25)})
    df = spark.createDataFrame([("m", *e, i) for i, e in enumerate(edges)], "map_id string, src_road string, src_lane int, dst_road string, dst_lane int, ord long")
    got = {tuple(r) for r in L.classify_edges(df).where("stub").select(*L.EDGE).collect()}
    assert got == stub_loop(edges)


def test_rebuild(spark):
    road = spark.createDataFrame([("m", str(i), 20.0) for i in range(1, 5)], "map_id string, road_id string, length double")
    none = ("curvature", "curv_end", "au", "bu", "cu", "du", "av", "bv", "cv", "dv")
    geometry = road.select("map_id", "road_id", F.lit(0).alias("ord"), F.lit(0.0).alias("s"), (F.col("road_id").cast("int") * 20.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("hdg"), "length", F.lit("line").alias("kind"), F.lit(None).cast("string").alias("p_range"), *[F.lit(None).cast("double").alias(c) for c in none])
    width = road.select("map_id", "road_id", F.explode(F.array(*map(F.lit, (-2, -1, 1)))).alias("lane_id"), F.lit(0.0).alias("s_offset"), F.lit(3.0).alias("a"), F.lit(0.1).alias("b"), F.lit(0.0).alias("c"), F.lit(0.0).alias("d"))
    edges = [("1", -1, "2", -1), ("2", -1, "3", -2), ("2", -1, "4", 1), ("1", -1, "2", -1), ("1", -1, "1", -2), ("1", -1, "9", -1)]
    df = spark.createDataFrame([("m", *e, i) for i, e in enumerate(edges)], "map_id string, src_road string, src_lane int, dst_road string, dst_lane int, ord long")
    out, stats = L.rebuild(df, road, width.select("map_id", "road_id", "lane_id"), geometry, width)
    s = stats.first()
    assert (s["edges"], s["plain_links"], s["entry_links_omitted"], s["stubs"], s["junctions"]) == (3, 1, 0, 2, 1)
    stubs = {r["stub_id"]: r for r in out["stub"].collect()}
    assert set(stubs) == {"5", "6"} and stubs["5"]["dst_road"] == "3" and stubs["5"]["length"] == pytest.approx(2.0)
    assert stubs["5"]["width_a"] == pytest.approx(3.0) and stubs["5"]["width_b"] == pytest.approx(0.1) and stubs["5"]["lane_offset_a"] == pytest.approx(-3.0)
    assert stubs["6"]["width_a"] == pytest.approx(5.0) and stubs["6"]["prims"][0]["x"] == pytest.approx(100.0)  # backwards from its end
    assert rows(out["road_link"].select("road_id", "side", "element_type", "element_id")) == [("1", "end", "road", "2"), ("2", "end", "junction", "7"), ("2", "start", "road", "1"), ("3", "start", "junction", "7"), ("4", "end", "junction", "7")]
    assert rows(out["lane_link"].select("road_id", "lane_id", "direction", "target")) == [("1", -1, "successor", -1), ("2", -1, "predecessor", -1)]


def test_merge_junctions(spark):
    make = spark.createDataFrame
    j = make([("m", x, i) for i, x in enumerate(["12", "9", "30", "31"])], "map_id string, junction_id string, ord long")
    c = make([("m", "12", "0", "1", "100", 0), ("m", "9", "0", "2", "100", 1), ("m", "9", "1", "1", "100", 2), ("m", "30", "0", "5", "200", 3), ("m", "12", "1", "3", "101", 4)], "map_id string, junction_id string, conn_id string, incoming_road string, connecting_road string, ord long")
    r = make([("m", "100", "12", 0), ("m", "101", "12", 1), ("m", "200", "31", 2), ("m", "1", "-1", 3)], "map_id string, road_id string, junction string, ord long")
    l = make([("m", "1", "successor", "junction", "12"), ("m", "1", "predecessor", "road", "12")], "map_id string, road_id string, direction string, element_type string, element_id string")  # noqa: E741
    out, stats = L.merge_junctions(j, c, r, l)
    s = stats.first()
    assert (s["junctions_before"], s["junctions_after"], s["merged_away"], s["duplicate_connections_dropped"]) == (4, 3, 1, 1)
    assert rows(out["connection"].where("junction_id = '9'").select("conn_id", "incoming_road", "connecting_road")) == [("0", "2", "100"), ("1", "1", "100"), ("2", "3", "101")]
    assert rows(out["road"].select("road_id", "junction")) == [("1", "-1"), ("100", "9"), ("101", "9"), ("200", "30")]
    assert rows(out["road_link"].select("direction", "element_id")) == [("predecessor", "12"), ("successor", "9")]


def lanelet(i, y0, y1, back=False, **links):
    x = [0.0, 5.0, 10.0]
    x = x[::-1] if back else x
    left, right = (y0, y1) if back else (y1, y0)
    return {"rel_id": i, "left": None, "left_same": False, "right": None, "right_same": False, "lx": x, "ly": [left] * 3, "rx": x, "ry": [right] * 3} | links


def test_adjacency(spark):
    made = [
        lanelet("a", 0, 4, left="b", left_same=True, right="zz", right_same=True), lanelet("b", 4, 8), lanelet("c", 8, 12, back=True, right="b", right_same=True), lanelet("d", 0, 4, back=True, left="a"),
        lanelet("e", 20, 24, left="e"), lanelet("f", 30, 34, right="g", right_same=True), lanelet("g", 26, 30, right="f", right_same=True),
    ]
    schema = "map_id string, rel_id string, ord int, left string, left_same boolean, right string, right_same boolean, lx array<double>, ly array<double>, rx array<double>, ry array<double>"
    data = [("m", r["rel_id"], k, r["left"], bool(r["left_same"]), r["right"], bool(r["right_same"]), *([float(v) for v in r[c]] for c in ("lx", "ly", "rx", "ry"))) for k, r in enumerate(made)]
    got = {r.rel_id: (r.left, r.left_same, r.right, r.right_same) for r in L.sanitize_adjacency(spark.createDataFrame(data, schema)).collect()}
    assert set(got) == set("abcdefg") and got["e"] == got["c"] == (None, False, None, False)
    assert got["a"] == ("b", True, None, False) and got["b"][2:] == ("a", True) and got["c"] == (None, False, None, False) and got["d"][0] is None
    assert (got["f"][2] is None) != (got["g"][2] is None)  # the circle is cut once
    assert L.sanitize_adjacency(spark.createDataFrame([], schema)).count() == 0


def test_settled_links():
    slots = lambda *links: (np.array([t for t, _ in links]), np.array([s for _, s in links]))
    none = (-1, False)
    # 0 has 1 on its right, 2 claims the same slot of 1 and loses; 3 and 1 run opposite ways
    target, same = L.settle_links(*slots(none, (1, True), none, none, none, (1, True), (1, False), none))
    assert target.tolist() == [-1, 1, 0, -1, -1, -1, -1, -1] and same[2]
    # a chain of 40,000 and a ring of 3 take one walk each
    n = 40_000
    chain = [(k, True) for i in range(n) for k in (i - 1, i + 1 if i + 1 < n else -1)]
    ring = [(n + (i + d) % 3, True) for i in range(3) for d in (-1, 1)]
    target, _ = L.settle_links(*slots(*chain, *ring))
    assert (target[: 2 * n] == np.array([t for t, _ in chain])).all()
    assert target[2 * n :].tolist() == [-1, n + 1, n, n + 2, n + 1, -1]


def test_topology_report(spark):
    ll = spark.createDataFrame([("m", "a", "b", True, None, None), ("m", "b", None, None, "a", False), ("m", "c", None, None, None, None)], "map_id string, rel_id string, left string, left_same boolean, right string, right_same boolean")
    links = spark.createDataFrame([("m", "a", "successor", "b"), ("m", "b", "predecessor", "zz")], "map_id string, rel_id string, kind string, target string")
    r = L.topology_report(ll, links).first().asDict()
    assert r == {"map_id": "m", "lanelets": 3, "adjacent_same_direction": 1, "adjacent_opposite_direction": 1, "isolated_lanelets": 1, "successor_links": 1, "predecessor_links": 1, "dangling_links": 1}


def test_curves_and_cuts():
    t = np.linspace(0, np.pi / 2, 60)
    x, y = np.r_[np.linspace(-100, 0, 20), 30 * np.sin(t)[1:]], np.r_[np.zeros(20), 30 * (1 - np.cos(t))[1:]]
    assert R.window_turn(np.array([0.0, 10, 30]), np.zeros(3)) == 0.0
    assert R.window_turn(x, y) == pytest.approx(np.degrees(20 / 30), rel=0.1)
    seg, limit = R.local_limits(x, y)
    assert limit[0] == 90.0 and limit[-1] == 18.0 and len(seg) == len(limit)
    demand = R.cut_demand(x, y)
    cuts = R.cut_fractions(demand)
    ends = np.r_[0, cuts, 1] * seg.sum()
    assert len(cuts) >= 3 and np.diff(ends)[-1] <= 18.5 and np.diff(ends)[0] > 40
    assert len(R.cut_fractions(np.full(400, 0.9))) == 0
    assert np.allclose(R.cut_fractions(np.full(400, 3.2)), [0.25, 0.5, 0.75])


def test_overlap_areas(spark):
    left, right = np.array([(0.0, 1.0), (10.0, 1.0)]), np.array([(0.0, 0.0), (10.0, 0.0)])
    assert D.strip_iou(left, right, left, right) == pytest.approx(1.0)
    assert D.strip_iou(left, right, left + [5, 0], right + [5, 0]) == pytest.approx(1 / 3)
    assert D.strip_iou(left, right, left + [20, 0], right) >= 0 and D.strip_iou(left, right, left + [0, 9], right + [0, 9]) == 0.0
    rng = np.random.default_rng(3)
    for _ in range(5):
        a, b = (np.sort(rng.random((2, 3, 2)), 1) * 4 for _ in range(2))
        tri = [t if D._cross(t[0], t[1], t[2]) > 0 else t[::-1] for t in (a[0] + rng.random((3, 2)), b[0] + rng.random((3, 2)))]
        p = rng.random((200_000, 2)) * 6
        inside = [np.all([D._cross(t[i][None], t[(i + 1) % 3][None], p) >= 0 for i in range(3)], 0) for t in tri]
        assert D.triangle_overlaps(tri[0][None], tri[1][None])[0] == pytest.approx((inside[0] & inside[1]).mean() * 36, abs=0.05)
    pts = lambda a: [{"x": float(x), "y": float(y)} for x, y in a]
    schema = "map_id string, rel_id string, lp array<struct<x:double,y:double>>, rp array<struct<x:double,y:double>>"
    one = spark.createDataFrame([("m", "a", pts(left), pts(right)), ("m", "b", pts(left + [0, 500]), pts(right + [0, 500]))], schema)
    two = spark.createDataFrame([("m", "u", pts(left + [5, 0]), pts(right + [5, 0])), ("m", "v", pts(left + [1, 0]), pts(right + [1, 0]))], schema)
    assert [(r["rel_id"], round(r["iou"], 6)) for r in D.best_overlaps(one, two).orderBy("rel_id").collect()] == [("a", round(9 / 11, 6)), ("b", 0.0)]
    seg = spark.createDataFrame([("m", 0.0, 0.0, 10.0, 0.0)], "map_id string, ax double, ay double, bx double, by double")
    samples = spark.createDataFrame([("m", 1, 5.0, 0.3), ("m", 2, 14.0, 3.0), ("m", 3, 4000.0, 0.0), ("n", 4, 0.0, 0.0)], "map_id string, point_id long, px double, py double")
    assert rows(D.nearest_segment(samples, seg, 5.0)) == [("m", 1, 0.3), ("m", 2, 5.0), ("m", 3, 3990.0), ("n", 4, float("inf"))]
    m = D.roundtrip(one, two, samples.where("point_id < 3"), seg).first()
    assert m["lanelets_original"] == 2 and m["area_original"] == pytest.approx(20.0) and m["match_iou_min"] == 0.0 and m["boundary_dev_max"] == pytest.approx(5.0)


TRACE = [(1, float(t), float(t * 3), 0.0, t < 8) for t in range(12)] + [(2, float(t), 0.0, 0.0, True) for t in range(5)]
TRACE_SCHEMA = "vehicle long, ts double, x double, y double, alive boolean"


def test_trips(spark):
    t = D.trips(spark.createDataFrame(TRACE, TRACE_SCHEMA))
    assert rows(t) == [(1, 8, 21.0, 3.0, 8.0), (2, 5, 0.0, 0.0, None)]
    ends = spark.createDataFrame([(1, True)], "vehicle long, dead_end boolean")
    assert tuple(D.drive_verdict(t, ends).first()) == (2, 1, 1, 0, "PASS")
    assert D.drive_verdict(t, ends.limit(0)).first()["status"] == "WARN"


def test_live_trips(spark, tmp_path):
    from roadloom.streaming.live import live_trips, windowed_counts

    for k in range(3):
        spark.createDataFrame(TRACE[k * 6 : k * 6 + 6], TRACE_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.1)
    stream = spark.readStream.schema(TRACE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = live_trips(stream).writeStream.outputMode("update").format("memory").queryName("trips").start()
    q.processAllAvailable()
    q.stop()
    last = spark.sql("select vehicle, max(samples) as samples, max(distance) as d, max(removed_at) as gone from trips group by vehicle")
    assert rows(last) == [(1, 8, 21.0, 8.0), (2, 5, 0.0, None)]
    at = stream.withColumn("at", F.timestamp_seconds("ts"))
    q = windowed_counts(at, "5 seconds", "1 second").writeStream.outputMode("update").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select sum(samples) from (select window, vehicle, max(samples) as samples from counts group by all)").first()[0] == len(TRACE)


def test_reference_stream(spark, tmp_path):
    import json

    from roadloom.operators.orphans import ReferenceLedger
    from roadloom.streaming.live import follow_references

    data = [[("osm_member", {"member_id": 1, "map_id": 1, "mtype": "way", "ref": "5", "loaded_at": "2024-01-01T00:00:00"})], [("osm_way", {"map_id": 1, "way_id": 5, "loaded_at": "2024-01-02T00:00:00"})]]
    ledger = ReferenceLedger(spark)
    for k, part in enumerate(data):
        spark.createDataFrame([(t, json.dumps(r)) for t, r in part], "table string, row string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("table string, row string").parquet(str(tmp_path / "in"))
        q = follow_references(stream, ledger, str(tmp_path / "checkpoint"))
        q.processAllAvailable()
        q.stop()
        assert [r["reason"] for r in ledger.cases().collect()] == [["missing"], ["late"]][k]


def test_reach(spark):
    links = spark.createDataFrame([("m", "a", "b"), ("m", "b", "a"), ("m", "b", "c"), ("m", "x", "y"), ("m", "y", "x")], "map_id string, src string, dst string")
    starts = links.select("map_id", F.col("src").alias("wp_id")).distinct()
    assert rows(D.dead_end_ahead(starts, links, 5)) == [("m", "a", True), ("m", "b", True), ("m", "x", False), ("m", "y", False)]
    assert rows(D.dead_end_ahead(starts, links, 2)) == [("m", "a", False), ("m", "b", True), ("m", "x", False), ("m", "y", False)]


def test_planview_names_are_used():
    assert V.to_map(1.0, 2.0, np.pi / 2, 3.0, 0.0) == pytest.approx((1.0, 5.0))


def test_overlaps_of_lanelets_with_stray_ends(spark):
    """Lanelets thousands of kilometres wide, which no grid of cells can hold, and sides that lie on one tilted line."""
    pts = lambda ps: [(float(x), float(y)) for x, y in ps]
    schema = "map_id string, rel_id string, lp array<struct<x double, y double>>, rp array<struct<x double, y double>>"
    wide = (pts([(0, 0), (10, 0), (2e6, 2e6)]), pts([(0, 5), (10, 5), (2e6, 2e6 + 5)]))
    one = spark.createDataFrame([("m", "a", *wide), ("m", "b", pts([(20, -50), (30, -50)]), pts([(20, -49), (30, -49)])), ("n", "c", *wide)], schema)
    two = spark.createDataFrame([("m", "k", *wide), ("m", "l", pts([(25, -50), (30, -50)]), pts([(25, -49), (30, -49)]))], schema)
    assert [(r["rel_id"], round(r["iou"], 6)) for r in D.best_overlaps(one, two).orderBy("rel_id").collect()] == [("a", 1.0), ("b", 0.5), ("c", 0.0)]
    at = lambda s, t: [2000 + s * np.cos(0.7) - t * np.sin(0.7), 2000 + s * np.sin(0.7) + t * np.cos(0.7)]
    line = lambda ss, t: np.array([at(s, t) for s in ss])
    for k in range(1, 40):
        assert D.strip_iou(line((0, 7, 1000), 0), line((0, 3 + k, 1000), 1), line((k, 300, 1000 + k), 0), line((k, 77, 1000 + k), 1)) == pytest.approx((1000 - k) / (1000 + k), rel=1e-7)


def test_samples_are_made_in_portions(spark, monkeypatch):
    """Long polylines: no more points at once than a portion holds, or one polyline; the points are the same."""
    assert R.portions(np.array([5, 5, 30, 1, 1]), 10) == [(0, 2), (2, 3), (3, 5)] and R.portions(np.array([], int)) == []
    most, plain = [], R.resample
    monkeypatch.setattr(R, "resample", lambda x, y, b, parts: most.append(int(parts.sum())) or plain(x, y, b, parts))
    lines = [[{"x": 0.0, "y": 0.0}, {"x": float(n), "y": 0.0}] for n in (200_000, 3, 150_000, 100_000, 0)]
    pts = R.pa.array(lines, R.pa.list_(R.pa.struct([("x", R.pa.float64()), ("y", R.pa.float64())])))
    got = list(R.step_batches(iter([pts]), 1.0))
    assert [len(p) for g in got for p in g] == [200_001, 4, 150_001, 100_001, 2] and max(most) <= R.PORTION and len(got) == 2
    both = list(R.shared_batches(iter([(pts, pts)]), 1.0, 3))
    assert [len(p["a"]) for g in both for p in g.to_pylist()] == [200_001, 4, 150_001, 100_001, 3] and max(most) <= R.PORTION
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, pts array<struct<x:double,y:double>>").coalesce(1)
    a, b = R.sample_shared(F.col("pts"), F.col("pts"), 1.0)
    found = df.select("i", F.size(R.sample_step(F.col("pts"), 1.0)), F.size(a), F.element_at(b, -1)["x"]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in found] == [(200_001, 200_001, 200_000.0), (4, 4, 3.0), (150_001, 150_001, 150_000.0), (100_001, 100_001, 100_000.0), (2, 3, 0.0)]


def test_long_straights_are_not_sampled(monkeypatch):
    """Demand of ways with stray ends: the same as with a point every metre, from few points."""
    rng = np.random.default_rng(5)

    def whole(x, y, step, reach):
        return R._stepped(x, y, step)

    for k in range(30):
        x, y = np.cumsum(rng.random((2, 12)) * 8, 1)
        x[rng.integers(12)] += 10.0 ** rng.integers(3, 6)
        y[rng.integers(12)] -= 9000.0 * (k % 3)
        assert len(R.local_limits(x, y)[0]) < 3000
        got = R.cut_demand(x, y)
        with monkeypatch.context() as m:
            m.setattr(R, "_stepped_at_bends", whole)
            assert np.allclose(got, R.cut_demand(x, y), rtol=1e-9)


def pieces_by_walk(refs, x, y, fractions, snap=0.1):
    """Pieces of a way as lists of (a, b, t), one cut after the other."""
    along = [0.0, *np.cumsum(np.hypot(np.diff(x), np.diff(y))).tolist()]
    pieces, here = [], [(refs[0], None, None)]
    done = 0
    for f in [*fractions, None]:
        at = along[-1] if f is None else f * along[-1]
        i = next((i for i in range(len(refs) - 1) if along[i + 1] + 1e-9 >= at), len(refs) - 2)
        t = (at - along[i]) / ((along[i + 1] - along[i]) or 1.0)
        k = i if abs(at - along[i]) <= snap else i + 1 if abs(along[i + 1] - at) <= snap else None
        mark, last = ((refs[i], refs[i + 1], t), i) if k is None else ((refs[k], None, None), k - 1)
        if f is None:
            mark, last = (refs[-1], None, None), len(refs) - 2
        here += [(r, None, None) for r in refs[done + 1 : last + 1]] + [mark]
        pieces.append([q for n, q in enumerate(here) if not n or q != here[n - 1]])
        here, done = [mark], last if k is None and f is not None else last + 1
    return pieces if all(len(q) > 1 for q in pieces) else None


def test_pieces_are_made_in_portions(monkeypatch):
    """Ways of thousands of cuts are given on bit by bit, whole, and as a walk along each way gives them."""
    rng = np.random.default_rng(3)
    ways = []
    for k in range(60):
        n = int(rng.integers(2, 9))
        x, y = np.round(rng.random((2, n)) * (40 if k % 20 else 4000))
        refs = [str(v) for v in rng.integers(0, 30, n)]
        if k == 7:
            refs, x, y = ["5", "6"], np.zeros(2), np.zeros(2)  # without length
        if k == 8:
            refs, x, y = ["5", "5", "6"], np.array([0.0, 0.0, 9.0]), np.zeros(3)
        ways.append((1, str(k), k, "w", refs, x.tolist(), y.tolist(), (np.sort(rng.random(3)) if k % 20 else np.arange(1, 400) / 400).tolist()))
    names = ["map_id", "way_id", "ord", "component", "refs", "xs", "ys", "fractions"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*ways)], names=names)
    monkeypatch.setattr(X, "_CUT_ROWS", 200)
    parts = list(X._cut_ways(iter([batch.slice(0, 30), batch.slice(30), batch.slice(0, 0)])))
    assert len(parts) > 4 and 400 < max(p.num_rows for p in parts) < 200 + 900
    got = pa.Table.from_batches(parts).to_pylist()
    seen = 0
    for _, w, _, _, refs, x, y, fractions in ways:
        mine = [r for r in got if r["way_id"] == w]
        want = pieces_by_walk(refs, np.array(x), np.array(y), fractions)
        seen += want is not None
        if want is None:
            assert [(r["ok"], r["piece"], r["a"]) for r in mine] == [(False, None, None)], w
        else:
            flat = [(k, s, a, b) for k, piece in enumerate(want) for s, (a, b, _) in enumerate(piece)]
            assert [(r["piece"], r["seq"], r["a"], r["b"]) for r in mine] == flat and all(r["ok"] for r in mine), w
            assert np.allclose([r["t"] for r in mine if r["b"]], [t for piece in want for _, b, t in piece if b]), w
    assert 20 < seen < 60


def test_demand_is_carried_as_runs(spark):
    """The greatest of runs is that of the samples; a way without length has none; each is computed once."""
    rng = np.random.default_rng(4)
    every = [np.cumsum(rng.random((2, 9)) * 60, 1) * (1, rng.random())[k % 2] for k in range(20)]
    whole = [R.cut_demand(*line) for line in every]
    lo, hi, v = map(np.concatenate, zip(*map(R.runs, whole)))
    assert len(v) < 20 * 40 and np.array_equal(R.greatest(lo, hi, v), np.max(whole, axis=0))
    lines = [(k, [dict(zip("xy", p)) for p in line.T.tolist()]) for k, line in enumerate(every)] + [(20, [{"x": 1.0, "y": 1.0}] * 2), (21, [])]
    df = spark.createDataFrame(lines, "k int, pts array<struct<x: double, y: double>>")
    demand = df.join(spark.range(30).withColumnRenamed("id", "k"), "k").select("k", R.demand(F.col("pts")).alias("d")).select("k", F.explode("d").alias("r"))
    assert demand._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    found = demand.groupBy("k").agg(F.collect_list("r").alias("d")).select("k", R.fractions(F.col("d")).alias("f")).where(F.size("f") > 0)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 2
    got = dict(map(tuple, found.collect()))
    assert got == {k: f for k, d in enumerate(whole) if (f := R.cut_fractions(d).tolist())} and got
