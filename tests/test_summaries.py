import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.operators import summaries as S
from roadloom.operators.fidelity import nearest_segment
from roadloom.operators.maptables import MapTables
from roadloom.operators.skew import numbered
from roadloom.sinks import writers as W
from roadloom.sources.osm_xml import osm_tables, read_osm
from roadloom.storage import Scratch
from tests.conftest import rows


def test_numbers_within_scopes(spark):
    data = [("big", k) for k in range(500)] + [("small", k) for k in range(3)] + [(None, 7)]
    df = spark.createDataFrame(data, "map_id string, ord long").repartition(7)
    assert rows(numbered(df, "map_id", ["ord"], "n")) == sorted(((m, k, k + 1 if m else 1) for m, k in data), key=str)
    assert numbered(df.limit(0), "map_id", ["ord"], "n").count() == 0


def test_heights_off_and_on(spark):
    p = lambda *z: [(float(i), 0.0, v) for i, v in enumerate(z)]
    schema = "map_id string, rel_id long, lp array<struct<x:double,y:double,ele:double>>, rp array<struct<x:double,y:double,ele:double>>"
    df = spark.createDataFrame([("m", 1, p(1.0, None), p(2.0)), ("m", 2, p(None), p(None)), ("m", 3, [], None)], schema)
    flat, z = S.strip_z(df)
    assert rows(z) == [("m", 1, [1.0, 0.0], [2.0])]
    assert flat.schema["lp"].dataType.elementType.names == ["x", "y"]
    back = {r.rel_id: r for r in S.restore_z(flat, z).collect()}
    assert [q.ele for q in back[1].lp] == [1.0, 0.0] and [q.ele for q in back[2].lp] == [None]


def test_metrics_and_reports(spark):
    m = spark.createDataFrame([("m", 3, 2, 0.91234, 0.5, 0.25, 0.126, 0.5, 2.0)], "map_id string, lanelets_original long, lanelets_roundtrip long, match_iou_p50 double, match_iou_p90 double, match_iou_min double, boundary_dev_p50 double, boundary_dev_p90 double, boundary_dev_max double")
    worst = spark.createDataFrame([("m", "b", 0.3), ("m", "a", 0.1)], "map_id string, rel_id string, iou double")
    doc = json.loads(W.metrics_json(m, worst).first()["json"])
    assert doc["lanelets_original"] == 3 and [w["rel_id"] for w in doc["worst"]] == ["a", "b"]
    assert json.loads(W.metrics_json(m, worst.limit(0)).first()["json"])["worst"] == []
    s = W.metrics_summary(m).first()
    assert s["lanelets"] == "3->2" and s["match_iou_p50/p90/min"] == "0.912/0.500/0.250" and s["boundary_dev_p50/p90/max_m"] == "0.13/0.50/2.00"
    checks = spark.createDataFrame([("m", "c2", "FAIL", "x"), ("m", "c1", "PASS", "y")], "map_id string, check string, status string, detail string")
    r = W.simulator_report(checks, spark.createDataFrame([("m", 1.5), ("n", 2.0)], "map_id string, import_seconds double")).orderBy("map_id").collect()
    assert r[0]["summary"] == "import check: 1 PASS, 0 WARN, 1 FAIL of 2" and [c["check"] for c in json.loads(r[0]["json"])["results"]] == ["c1", "c2"]
    assert r[1]["summary"].endswith("0 FAIL of 0")


def test_maps_of_one_file_name(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / "in" / f"town{k}").mkdir(parents=True)
        (tmp_path / "in" / f"town{k}" / "lanelet2_map.osm").write_text(f'<osm><node id="{k}" lat="1" lon="2"><tag k="local_x" v="{k}"/><tag k="local_y" v="0"/></node></osm>')
    t = osm_tables(read_osm(spark, str(tmp_path / "in")))
    files = W.write_osm(t, str(tmp_path / "out"), root=str(tmp_path / "in"))
    assert sorted(r["file"] for r in files.collect()) == ["town1/lanelet2_map.osm", "town2/lanelet2_map.osm"]
    assert sorted(r["node_id"] for r in osm_tables(read_osm(spark, str(tmp_path / "out"))).node.collect()) == ["1", "2"]
    assert not list((tmp_path / "out").rglob("*.draft"))
    assert W.map_file("file:/a/b/x.osm") == "a/b/x.osm" and W.map_file(7) == "7.osm" and W.map_file("../x", "") == "x.osm"


def test_nearest_segment_far_and_long(spark):
    seg = [("m", 0.0, 0.0, 1e5, 1e5), ("m", 5.0, 0.0, 5.0, 3.0), ("n", 0.0, 0.0, 0.0, 0.0)]
    pts = [("m", 1, 6.0, 1.0), ("m", 2, -4e5, 0.0), ("m", 3, 5e4, 5e4 + 2), ("n", 4, 3.0, 4.0), ("none", 5, 0.0, 0.0), ("m", 6, None, 0.0)]
    got = {r.point_id: r.dist for r in nearest_segment(spark.createDataFrame(pts, "map_id string, point_id long, px double, py double"), spark.createDataFrame(seg, "map_id string, ax double, ay double, bx double, by double"), 5.0).collect()}
    assert got == {1: pytest.approx(1.0), 2: pytest.approx(4e5), 3: pytest.approx(2**0.5), 4: pytest.approx(5.0), 5: float("inf"), 6: float("inf")}


def test_fixed_text(spark):
    df = spark.createDataFrame([(-281.04245,), (0.00005,), (2.5,), (None,), (-0.00001,)], "v double")
    assert [r[0] for r in df.select(W.fixed_text("v")).collect()] == ["-281.0424", "0.0001", "2.5000", None, "-0.0000"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_segment_sends_few_probes(spark, monkeypatch):
    """Many points times many sizes of segments: their probes are no broadcast, though the points' file is small."""
    plans, save = {}, Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: plans.update({name: plan_of(df)}) or save(self, df, name))
    rng = np.random.default_rng(1)
    seg = np.array([(0.0, -30.0 * k, 20.0 * 2**k, -30.0 * k) for k in range(12)])
    at = np.r_[rng.random((1200, 2)) * [2000, 1.0] - [0, 300], [[-500.0, 0.0]]]
    pts = spark.createDataFrame([("m", i, float(x), float(y)) for i, (x, y) in enumerate(at)], "map_id string, point_id long, px double, py double")
    got = nearest_segment(pts, spark.createDataFrame([("m", *map(float, s)) for s in seg], "map_id string, ax double, ay double, bx double, by double"), 5.0).collect()
    beside = np.maximum(np.maximum(seg[None, :, 0] - at[:, :1], at[:, :1] - seg[None, :, 2]), 0)
    want = np.hypot(beside, at[:, 1:] - seg[None, :, 1]).min(1)
    assert len(got) == len(at) and all(r.dist == pytest.approx(want[r.point_id]) for r in got)
    assert "SortMergeJoin" in plans["near-0"] and "Broadcast" not in plans["near-0"]
    assert "BroadcastHashJoin" in plans[max((n for n in plans if n.startswith("near-")), key=lambda n: int(n[5:]))]


def test_polylines_send_no_refs(spark, tmp_path):
    """Refs are many more rows than the ways whose file Spark estimates them by; they are no broadcast."""
    spark.createDataFrame([("m", 1, [3, 1, 2]), ("m", 2, [2, 9])], "map_id string, way_id long, nd array<long>").write.parquet(str(tmp_path / "way"))
    spark.createDataFrame([("m", k, float(k), 0.0, 0.0) for k in (1, 2, 3)], "map_id string, node_id long, x double, y double, ele double").write.parquet(str(tmp_path / "node"))
    way = spark.read.parquet(str(tmp_path / "way"))
    refs = way.select("map_id", "way_id", F.posexplode("nd").alias("seq", "node_id"))
    lines = MapTables(spark.read.parquet(str(tmp_path / "node")), way, refs, None, None).polylines
    assert {r.way_id: [p.x for p in r.pts] for r in lines.collect()} == {1: [3.0, 1.0, 2.0], 2: [2.0]}
    assert "SortMergeJoin" in plan_of(lines) and "Broadcast" not in plan_of(lines)
