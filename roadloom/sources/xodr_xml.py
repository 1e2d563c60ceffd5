"""Plan-view XML maps as tables: one depth-first pass per file emits tagged rows with the keys of all their parents."""

from __future__ import annotations

import io
import math
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.sources.osm_xml import files

ROWS = "map_id string, elem string, ord bigint, keys map<string,string>, attrs map<string,string>, text string"
# Attributes that hold words or ids, left out of the test for finite numbers.
WORD_ATTRIBUTES = {
    "id", "name", "type", "junction", "elementId", "elementType", "contactPoint", "from", "to", "incomingRoad", "connectingRoad", "level", "weight", "color", "date", "version",
    "revMajor", "revMinor", "subtype", "country", "unit", "dynamic", "orientation", "countryRevision", "pRange", "laneChange", "rule",
}
#: Table of an element by the end of its path.
_TABLES = {
    "header": "header", "header/geoReference": "georef", "road": "road", "road/link/predecessor": "road_link", "road/link/successor": "road_link", "road/type": "road_type",
    "planView/geometry": "geometry", "lanes/laneOffset": "lane_offset", "lanes/laneSection": "lane_section", "left/lane": "lane", "center/lane": "lane", "right/lane": "lane", "lane/width": "width",
    "lane/roadMark": "road_mark", "lane/link/predecessor": "lane_link", "lane/link/successor": "lane_link", "junction": "junction", "junction/connection": "connection", "connection/laneLink": "junction_lane_link",
}


def _table(path: list[str]) -> str | None:
    if len(path) == 1:
        return _TABLES.get(path[0])
    for n in (3, 2):
        if len(path) >= n and (t := _TABLES.get("/".join(path[-n:]))):
            return t
    return None


def _rows(name: str, content: bytes) -> Iterator[tuple]:
    """Rows of one file in document order. Keys name the parents: road, section, side, lane, junction, connection."""
    path: list[str] = []
    ords, counts, numbers, unfinite = 0, [0], 0, 0
    keys: list[dict[str, str]] = [{}]
    root = None
    try:
        for event, el in ET.iterparse(io.BytesIO(content), events=("start", "end")):
            if event == "start":
                if root is None:
                    root = el.tag
                else:
                    path.append(el.tag)
                here = dict(keys[-1])
                counts[-1] += 1
                here["seq"] = str(counts[-1])
                counts.append(0)
                if path:
                    ords += 1
                    here["ord"] = str(ords)
                if len(path) == 1 and el.tag in ("road", "junction"):
                    here |= {"owner": el.get("id"), "owner_ord": str(ords)}
                elif el.tag == "laneSection":
                    here["section"] = str(ords)
                elif el.tag in ("left", "center", "right"):
                    here["side"] = el.tag
                elif el.tag == "lane":
                    here |= {"lane": el.get("id"), "lane_ord": str(ords)}
                elif el.tag == "connection":
                    here |= {"connection": el.get("id"), "connection_ord": str(ords)}
                keys.append(here)
                for k, v in el.attrib.items():
                    if k not in WORD_ATTRIBUTES:
                        try:
                            number = float(v)
                        except ValueError:
                            continue
                        numbers += 1
                        unfinite += not math.isfinite(number)
            else:
                here = keys.pop()
                counts.pop()
                if path:
                    table = _table(path)
                    if table:
                        attrs = dict(el.attrib)
                        if table == "geometry":
                            child = el[0] if len(el) else None
                            attrs |= {"kind": child.tag, **{f"p_{k}": v for k, v in child.attrib.items()}} if child is not None else {}
                        if table in ("road_link", "lane_link"):
                            attrs["direction"] = el.tag
                        yield name, table, int(here["ord"]), here, attrs, el.text
                    path.pop()
                    if len(path) < 2 and table != "geometry" or el.tag == "geometry":
                        el.clear()
        yield name, "file", 0, {}, {"root": root, "numbers": str(numbers), "unfinite": str(unfinite)}, None
    except ET.ParseError as e:
        yield name, "error", -1, {}, {}, str(e)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pa.map_(pa.string(), pa.string())
    schema = pa.schema([("map_id", pa.string()), ("elem", pa.string()), ("ord", pa.int64()), ("keys", pairs), ("attrs", pairs), ("text", pa.string())])
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = [(m, t, o, list(k.items()), list(a.items()), x) for m, t, o, k, a, x in _rows(name, content)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_xodr(spark: SparkSession, path: str) -> DataFrame:
    """Tagged rows of all files below ``path``. Elements match by their bare name, so those in a default namespace are
    not found, which the header check then reports. A broken file gives one row ``error`` after what could be read."""
    return files(spark, path, ".xodr").mapInArrow(_parse, ROWS)


@dataclass
class PlanTables:
    """Plan-view maps as tables, every attribute cast once; a missing or unreadable number is null."""

    rows: DataFrame

    def _of(self, elem: str, *cols: Column) -> DataFrame:
        return self.rows.where(F.col("elem") == elem).select("map_id", "ord", *cols)

    @staticmethod
    def text(name: str, alias: str | None = None) -> Column:
        return F.col("attrs")[name].alias(alias or name)

    @staticmethod
    def number(name: str, alias: str | None = None) -> Column:
        value = F.col("attrs")[name].try_cast("double")
        return F.when(~F.isnan(value), value).alias(alias or name)

    @staticmethod
    def key(name: str, alias: str) -> Column:
        return F.col("keys")[name].alias(alias)

    @cached_property
    def file(self) -> DataFrame:
        return self._of("file", self.text("root"), self.number("numbers"), self.number("unfinite"))

    @cached_property
    def header(self) -> DataFrame:
        return self._of("header", self.text("revMajor"), self.text("revMinor"), self.text("name"))

    @cached_property
    def georef(self) -> DataFrame:
        return self._of("georef", F.trim("text").alias("text"))

    @cached_property
    def road(self) -> DataFrame:
        return self._of("road", self.text("id", "road_id"), self.text("name"), self.number("length"), self.text("junction"), self.text("rule"))

    @cached_property
    def geometry(self) -> DataFrame:
        n, t = self.number, self.text
        poly = [n(f"p_{c}", c.lower()) for c in ("aU", "bU", "cU", "dU", "aV", "bV", "cV", "dV")]
        return self._of("geometry", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), n("s"), n("x"), n("y"), n("hdg"), n("length"), t("kind"), n("p_curvature", "curvature"), n("p_curvStart", "curv_start"), n("p_curvEnd", "curv_end"), t("p_pRange", "p_range"), *poly)

    @cached_property
    def section(self) -> DataFrame:
        return self._of("lane_section", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), self.number("s"))

    @cached_property
    def lane(self) -> DataFrame:
        return self._of("lane", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), self.key("section", "section"), self.key("side", "side"), self.text("id", "lane_id"), self.text("type"), self.text("level"))

    @cached_property
    def width(self) -> DataFrame:
        return self._of("width", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), self.key("section", "section"), self.key("side", "side"), self.key("lane_ord", "lane_ord"), self.key("lane", "lane_id"), self.number("sOffset", "s_offset"), *[self.number(c) for c in "abcd"])

    @cached_property
    def road_mark(self) -> DataFrame:
        return self._of("road_mark", self.key("owner", "road_id"), self.key("lane_ord", "lane_ord"), self.key("lane", "lane_id"), self.number("sOffset", "s_offset"), self.text("type"), self.text("color"), self.text("laneChange", "lane_change"), self.number("width"))

    @cached_property
    def road_link(self) -> DataFrame:
        return self._of("road_link", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), self.text("direction"), self.text("elementType", "element_type"), self.text("elementId", "element_id"), self.text("contactPoint", "contact_point"))

    @cached_property
    def lane_link(self) -> DataFrame:
        return self._of("lane_link", self.key("owner", "road_id"), self.key("owner_ord", "road_ord"), self.key("lane_ord", "lane_ord"), self.key("lane", "lane_id"), self.text("direction"), self.text("id", "target"))

    @cached_property
    def junction(self) -> DataFrame:
        return self._of("junction", self.text("id", "junction_id"), self.text("name"))

    @cached_property
    def connection(self) -> DataFrame:
        return self._of("connection", self.key("owner", "junction_id"), self.key("owner_ord", "junction_ord"), self.text("id", "conn_id"), self.text("incomingRoad", "incoming_road"), self.text("connectingRoad", "connecting_road"), self.text("linkedRoad", "linked_road"), self.text("contactPoint", "contact_point"))

    @cached_property
    def junction_lane_link(self) -> DataFrame:
        return self._of("junction_lane_link", self.key("owner", "junction_id"), self.key("connection_ord", "connection_ord"), self.text("from", "from_lane"), self.text("to", "to_lane"))

    @cached_property
    def lanes_of_road(self) -> DataFrame:
        """(map_id, road_id, lane_id, ord): one lane per id and road, the last in the document."""
        return self.lane.groupBy("map_id", "road_id", "lane_id").agg(F.max("ord").alias("ord"))
