import json

import pytest

from roadloom.operators.nested import TABLES, flatten_records, parse_deep, table_of, unusable_records, visit, write_tables
from tests.conftest import rows


def test_roads():
    lane = {"@id": 1, "width": {"@sOffset": " 1.2345 "}, "roadMark": [{"sOffset": None, "userData": {"width": {"sOffset": 1}}}, {"sOffset": "n/a"}, {"@sOffset": 2}]}
    road = {"id": " 7 ", "lanes": {"laneSection": [None, {"left": {"lane": [lane, {"id": 2.50}]}, "right": None, "center": {"lane": {"id": "0", "width": []}}}]}}
    want = [("width", "7/1/left/1", 0, "1234"), ("road_mark", "7/1/left/1", 0, ""), ("road_mark", "7/1/left/1", 1, ""), ("road_mark", "7/1/left/1", 2, "2000")]
    assert list(visit("road", json.dumps({"data": {"OpenDRIVE": {"road": road}}}))) == want
    assert list(visit("road", json.dumps({"batch": {"items": [{"payload": {"road": [road, road]}}]}}))) == want * 2
    assert list(visit("road", json.dumps({"road": {"lanes": {"laneSection": {"left": {"lane": {"width": {"sOffset": 0}}}}}}}))) == [("width", "/0/left/", 0, "0")]


def test_junctions_and_relations():
    junction = {"_id": "92", "connection": [{"_id": "0", "_connectingRoad": None, "laneLink": {"_from": -1, "_to": "2"}}, {"_connectingRoad": " 5"}], "controller": {"connection": {"connectingRoad": "77"}}}
    want = [("connection", "92", 0, ""), ("lane_link", "92/0", 0, "-1:2"), ("connection", "92", 1, "5")]
    assert list(visit("junction", json.dumps({"junction": junction}))) == want
    relation = {"id": 3, "member": [{"type": "way", "role": " left "}, {"role": None}, "odd"], "tag": {"k": "role", "v": "x"}}
    assert list(visit("relation", json.dumps({"osm": {"relation": relation}}))) == [("member", "3", 0, "left"), ("member", "3", 1, "")]


def test_numbers():
    road = lambda v: {"road": {"id": 1, "lanes": {"laneSection": {"left": {"lane": {"id": 1, "width": {"sOffset": v}}}}}}}
    want = {"1e1": "10000", "-0.0014": "-1", "0.0005": "0", "1_0": "", "nan": "", "Infinity": "", "1e400": "", "1e30": "1" + "0" * 33, "1.8e308": "", "-1e-4": "0", "0.0015": "2", "0.0025": "2", "00.5": "500", "123456789012345678901234567890123.4567": "123456789012345678901234567890123457", "1" + "0" * 400 + "e-400": "1000", "." + "0" * 400 + "1e401": "1000", "1e-400": "0", "0": "0", ".5": "500", "٣": "", True: "", 0.1: "100", 12: "12000"}
    for value, text in want.items():
        assert [r[3] for r in visit("road", json.dumps(road(value)))] == [text], value
    assert list(visit("road", '{"road": {"id": NaN, "lanes": {"laneSection": {"left": {"lane": {"width": {}}}}}}}')) == []
    assert list(visit("relation", '{"relation": {"id": 1, "member": {"role": "a\\ud800é"}}}')) == [("member", "1", 0, "a?é")]


def test_unusable():
    for kind, payload in [("road", None), ("road", ""), ("road", "<road/>"), ("road", "null"), ("road", "[1, 2]"), ("road", '{"road": '), ("road", '{"junction": {}}'), (None, '{"road": {}}'), ("lane", '{"lane": {}}'), ("road", '{"road": [null, 3, {}]}'), ("road", "[" * 100000)]:
        assert list(visit(kind, payload)) == []


def test_tables(spark, tmp_path):
    payload = json.dumps({"junction": [{"id": 1, "connection": {"connectingRoad": 9, "laneLink": [{"from": 1, "to": 2}]}}, {"id": 1, "connection": {"connectingRoad": 9}}]})
    df = spark.createDataFrame([(5, "junction", payload, "extra"), (6, "junction", None, None)], "record_id long, kind string, payload string, elem string")
    tagged = flatten_records(df)
    assert rows(tagged) == [(5, "connection", "1", 0, "9"), (5, "lane_link", "1/0", 0, "1:2")]
    write_tables(tagged, str(tmp_path / "t"))
    back = spark.read.schema(tagged.schema).parquet(str(tmp_path / "t"))
    for elem in TABLES:
        assert rows(table_of(back, elem)) == rows(table_of(tagged, elem))
    assert rows(table_of(back, "connection")) == [(5, "1", 0, "1/0", "9")]
    assert flatten_records(df.limit(0)).count() == 0


def test_any_depth():
    inner = '{"relation": {"id": 3, "member": [{"role": "left"}]}}'
    for depth in (10, 500, 501, 5000, 200_000):
        assert list(visit("relation", '{"w": [' * depth + inner + "]}" * depth)) == [("member", "3", 0, "left")], depth
    assert list(visit("relation", '{"w": [' * 5000 + inner + "]}" * 4999)) == []


def test_own_parser_agrees():
    good = ['{"a": [1, -2.50e+3, "x\\u00e9\\n", true, false, null, {}, [], {"b": {"c": [[]]}}]}', " [ ] ", "3", '"x"', "null ", '{"a": 1, "a": 2}']
    for text in good:
        assert parse_deep(text) == json.loads(text, parse_float=str, parse_int=str), text
    for text in ["", "[", "[1,]", "[1 2]", "{,}", '{"a"}', '{"a": }', "{1: 2}", "]", "01", "1 1", '"a\nb"', '"\\x"', "[1]]", "NaN", "{} {}", '{"a": 1,}', "[}", "tru"]:
        with pytest.raises(ValueError):
            parse_deep(text)


def test_unusable_are_counted(spark):
    made = [(1, "road", None), (2, "road", "{"), (3, "lane", "{}"), (4, None, "{}"), (5, "road", "{}"), (6, "road", '{"road": {}}'), (7, "road", "")]
    df = spark.createDataFrame(made, "record_id long, kind string, payload string")
    assert rows(unusable_records(df)) == [(1, "empty"), (2, "not json"), (3, "kind"), (4, "kind"), (5, "no element"), (7, "empty")]
