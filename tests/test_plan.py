import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.functions import planview as V
from roadloom.plans.pipeline import check_plan_files
from roadloom.sinks.writers import plan_road_xml, with_georeference
from roadloom.sources.xodr_xml import PlanTables, read_xodr

LINE = V.Prim("line", 0.0, 0.0, 0.0, 10.0)
ARC = V.Prim("arc", 1.0, 2.0, 0.5, 8.0, curvature=0.1)
CUBIC = V.Prim("paramPoly3", 3.0, 1.0, 0.3, V.chord_length((0.0, 10.0, 0.0, 0.0), (0.0, 0.0, 2.0, -1.0)), u=(0.0, 10.0, 0.0, 0.0), v=(0.0, 0.0, 2.0, -1.0))


@pytest.mark.parametrize("p", [LINE, ARC, CUBIC])
@pytest.mark.parametrize("share", [0.2, 0.7])
def test_cutting_and_reversing(p, share):
    one, two = V.between(p, 0.0, share * p.length), V.between(p, share * p.length, p.length)
    assert one.length + two.length == pytest.approx(p.length, abs=1e-4)
    assert V.end_pose(one)[:2] == pytest.approx((two.x, two.y), abs=1e-6)
    assert V.end_pose(two)[:2] == pytest.approx(V.end_pose(p)[:2], abs=1e-6)
    back = V.between(p, 0.0, p.length, backwards=True)
    assert (back.x, back.y) == pytest.approx(V.end_pose(p)[:2])
    assert V.end_pose(back)[:2] == pytest.approx((p.x, p.y), abs=1e-9)
    turn = (V.end_pose(back)[2] - p.hdg - math.pi) / (2 * math.pi)
    assert turn == pytest.approx(round(turn), abs=1e-9)


def test_unsupported():
    over_length = V.Prim("paramPoly3", 0.0, 0.0, 0.0, 5.0, u=(0, 1, 0, 0), normalized=False)
    spiral = V.Prim("spiral", 0.0, 0.0, 0.0, 5.0)
    for p in (over_length, spiral):
        assert V.end_pose(p) is None and V.between(p, 0.0, 1.0) is None and V.between(p, 0.0, 5.0, backwards=True) is None and V.piece([p], 0.0, 2.0) == ([p], 5.0) and V.piece([p], 1.0, 2.0) == ([], 0.0)


def test_pieces():
    road = [V.Prim("line", 10.0, 0.0, 0.0, 5.0, s=10.0), LINE]
    got, length = V.piece(road, 8.0, 12.0)
    assert length == pytest.approx(4.0) and [p.s for p in got] == pytest.approx([0.0, 2.0]) and [p.x for p in got] == pytest.approx([8.0, 10.0])
    got, length = V.piece(road, 8.0, 12.0, backwards=True)
    assert length == pytest.approx(4.0) and got[0].x == pytest.approx(12.0) and got[0].hdg == pytest.approx(math.pi)
    assert V.piece(road, 20.0, 30.0) == ([], 0.0)


def test_widths_and_offsets():
    widths = {1: [(0.0, (3.0, 0.1, 0.0, 0.0)), (10.0, (4.0, 0.0, 0.0, 0.0))], 2: [(5.0, (2.0, 0.0, 0.0, 0.0))], -1: [(0.0, (3.5, 0.0, 0.0, 0.0))]}
    at = lambda k, s: float(V.widths_at(widths.get(k, []), np.array([s]))[0])
    inner = lambda k, s: float(V.inner_offsets(widths, k, np.array([s]))[0])
    assert at(1, 5.0) == pytest.approx(3.5) and at(1, 10.0) == 4.0 and at(2, 0.0) == 2.0 and at(7, 1.0) == 0.0
    assert inner(3, 5.0) == pytest.approx(5.5) and inner(-2, 0.0) == -3.5 and inner(-1, 0.0) == 0.0


def test_polynomials():
    p = (1.0, 2.0, -1.0, 0.5)
    for t in (0.0, 0.3, 1.7):
        assert V.value(V.shifted(p, 0.4), t) == pytest.approx(V.value(p, 0.4 + t))
        assert V.value(V.scaled(p, -1.5), t) == pytest.approx(V.value(p, -1.5 * t))
        assert V.value(tuple(V.composed(np.array(p), 0.4, -1.5)), t) == pytest.approx(V.value(p, 0.4 - 1.5 * t))


def road(body, road_id="1", length=10.0, **attrs):
    more = "".join(f' {k}="{v}"' for k, v in ({"junction": "-1"} | attrs).items())
    return f'<road id="{road_id}" length="{length}"{more}>{body}</road>'


GEO = '<planView><geometry s="0" x="0" y="0" hdg="0" length="10"><line/></geometry></planView>'
LANES = '<lanes><laneSection s="0"><center><lane id="0"/></center><right><lane id="-1"><width sOffset="0" a="3.5" b="0" c="0" d="0"/></lane></right></laneSection></lanes>'
HEAD = '<header revMajor="1" revMinor="4"><geoReference><![CDATA[+proj=utm +zone=32 +datum=WGS84]]></geoReference></header>'


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("plans")
    spiral = '<planView><geometry s="0" x="0" y="0" hdg="0" length="6"><spiral curvStart="0" curvEnd="0"/></geometry><geometry s="6" x="6" y="0.01" hdg="0" length="4"><arc curvature="0.1"/></geometry></planView>'
    good = road(f'<link><successor elementType="road" elementId="2"/></link>{GEO}{LANES}') + road(spiral + LANES, "2") + road(GEO + LANES, "3", junction="9")
    good += '<junction id="9"><connection id="0" incomingRoad="1" connectingRoad="3"><laneLink from="-1" to="-1"/></connection></junction>'
    (at / "good.xodr").write_text("﻿<?xml version='1.0' encoding='UTF-8'?><OpenDRIVE>" + HEAD + good + "</OpenDRIVE>", encoding="utf-8")
    gap = GEO.replace('length="10"', 'length="4"').replace("</planView>", '<geometry s="4" x="4.2" y="0" hdg="nan" length="6"><mystery/></geometry></planView>')
    bad = road(f'<link><predecessor elementType="junction" elementId="7"/><successor elementType="road" elementId="3"/></link>{gap}{LANES.replace("<width", "<link><successor id=\"-5\"/></link><width")}')
    bad += road(GEO.replace('length="10"', 'length="9"') + LANES.replace('id="-1"', 'id="-2"'), "2") + road("", "2") + road(GEO + LANES.replace('a="3.5"', 'a="-1"'), "3", junction="8")
    bad += '<junction id="8"><connection id="0" incomingRoad="1" connectingRoad="2"/><connection id="1" incomingRoad="1" linkedRoad="2"/></junction><junction id="10"/>'
    (at / "bad.xodr").write_text("<OpenDRIVE><header revMajor='1' revMinor='4'><geoReference>+lat_0=1 +lon_0=2</geoReference></header>" + bad + "</OpenDRIVE>")
    (at / "spaced.xodr").write_text('<OpenDRIVE xmlns="urn:x"><header revMajor="1" revMinor="4"/></OpenDRIVE>')
    (at / "broken.xodr").write_text("<OpenDRIVE><road>")
    return {(r["map_id"].rsplit("/", 1)[1][:-5], r["req_id"][5:] if r["req_id"] != "parse" else "parse"): (r["status"], r["offenders"], r["total"]) for r in check_plan_files(spark, str(at)).collect()}


def test_good_plan(results):
    want = {"01": ("PASS", 0, 0), "02": ("PASS", 0, 0), "03": ("PASS", 0, 3), "04": ("PASS", 0, 3), "05": ("PASS", 0, 1), "06": ("PASS", 0, 3), "07": ("PASS", 0, 1), "08": ("PASS", 0, 0), "09": ("PASS", 0, 1), "10": ("PASS", 0, 1)}
    assert {k: results["good", k] for k in want} == want
    assert results["good", "11"][:2] == ("PASS", 0)


def test_bad_plan(results):
    want = {"02": ("FAIL", 0, 0), "03": ("FAIL", 1, 4), "05": ("FAIL", 1, 1), "07": ("FAIL", 1, 2), "08": ("FAIL", 1, 1), "09": ("FAIL", 3, 2), "10": ("FAIL", 1, 1)}
    assert {k: results["bad", k] for k in want} == want
    assert results["bad", "04"] == ("FAIL", 3, 4) and results["bad", "06"][0] == "FAIL"
    assert results["bad", "11"][:2] == ("FAIL", 1)


def test_namespace_and_broken(results):
    assert results["spaced", "01"][0] == "FAIL" and results["spaced", "09"][0] == "SKIP"
    assert results["broken", "parse"][0] == "FAIL"


def test_spiral_and_cubic_ends(spark, tmp_path):
    rows = [("arcLength", 4.0, 2.0, 0.0), ("normalized", 4.0, 10.0, 0.0)]
    g = "".join(f'<geometry s="0" x="1" y="2" hdg="0" length="{length}"><paramPoly3 pRange="{kind}" aU="0" bU="{b}" cU="0" dU="0" aV="0" bV="0" cV="1" dV="0"/></geometry>' for kind, length, b, _ in rows)
    (tmp_path / "a.xodr").write_text(f"<OpenDRIVE><header/>{road('<planView>' + g + '</planView>')}</OpenDRIVE>")
    t = PlanTables(read_xodr(spark, str(tmp_path)))
    ends = [tuple(r[0]) for r in t.geometry.orderBy("ord").select(V.end_point()).collect()]
    assert ends == [(9.0, 18.0), (11.0, 3.0)]
    x, y = V.spiral_end(0.0, 0.0, 0.0, 10.0, 0.05, 0.05)  # a spiral of one curvature is an arc
    assert (x, y) == pytest.approx((math.sin(0.5) / 0.05, (1 - math.cos(0.5)) / 0.05), abs=1e-4)


def test_text_writers(spark, tmp_path):
    xml = with_georeference("<OpenDRIVE><header a='1'/></OpenDRIVE>", "+proj=tmerc")
    assert xml == "<OpenDRIVE><header a='1'><geoReference><![CDATA[+proj=tmerc]]></geoReference></header></OpenDRIVE>"
    assert with_georeference(xml, "+proj=utm").count("geoReference") == 2
    body = plan_road_xml("a & b", "7", 18.0, [LINE, ARC])
    (tmp_path / "r.xodr").write_text(f"<OpenDRIVE><header/>{body}</OpenDRIVE>")
    t = PlanTables(read_xodr(spark, str(tmp_path)))
    assert t.road.first()["name"] == "a & b" and t.geometry.where(F.col("kind") == "arc").first()["curvature"] == 0.1
