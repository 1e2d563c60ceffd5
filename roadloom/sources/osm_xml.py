"""Lane-level XML maps as tables: one pass over each file, every element with its tags, refs and members."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators.keys import read_decimal
from roadloom.operators.maptables import MapTables, node_xy

ELEMENTS = "map_id string, ord bigint, elem string, id string, lat string, lon string, tags map<string,string>, nds array<string>, members array<struct<mtype:string,ref:string,role:string>>, error string"
_KINDS = pa.schema([
    ("map_id", pa.string()), ("ord", pa.int64()), ("elem", pa.string()), ("id", pa.string()), ("lat", pa.string()), ("lon", pa.string()), ("tags", pa.map_(pa.string(), pa.string())),
    ("nds", pa.list_(pa.string())), ("members", pa.list_(pa.struct([("mtype", pa.string()), ("ref", pa.string()), ("role", pa.string())]))), ("error", pa.string()),
])


def _elements(name: str, content: bytes) -> Iterator[tuple]:
    depth = ord_ = 0
    try:
        for event, el in ET.iterparse(io.BytesIO(content), events=("start", "end")):
            depth += 1 if event == "start" else -1
            if event == "end" and depth == 1:
                ord_ += 1
                if el.tag in ("node", "way", "relation"):
                    tags = {t.get("k"): t.get("v") for t in el.iterfind("tag") if t.get("k") is not None}
                    nds = [d.get("ref") for d in el.iterfind("nd")]
                    members = [{"mtype": m.get("type"), "ref": m.get("ref"), "role": m.get("role")} for m in el.iterfind("member")]
                    yield name, ord_, el.tag, el.get("id"), el.get("lat"), el.get("lon"), list(tags.items()), nds, members, None
                el.clear()
    except ET.ParseError as e:
        yield name, -1, "error", None, None, None, [], [], [], str(e)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows: list[tuple] = []
            for row in _elements(name, content):
                rows.append(row)
                if len(rows) == 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KINDS)], schema=_KINDS)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KINDS)], schema=_KINDS)


def files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """(map_id, content) of all files below a path; the map id is the file's path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("map_id"), "content")


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    """All elements of all files below ``path``. A repeated tag key takes its last value. A file that is not well formed
    gives its elements up to there and one row ``error``; other files are not affected."""
    return files(spark, path, ".osm").mapInArrow(_parse, ELEMENTS)


def osm_tables(elements: DataFrame) -> MapTables:
    """The map tables of parsed elements. Ids stay text."""
    tag = lambda k: F.col("tags")[k]
    nodes = elements.where("elem = 'node'")
    x, y = node_xy(tag("local_x"), tag("local_y"), F.col("lon").try_cast("double"), F.col("lat").try_cast("double"))
    node = nodes.select("map_id", F.col("id").alias("node_id"), "ord", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"), x.alias("x"), y.alias("y"), read_decimal(tag("ele")).alias("ele"), "tags")
    ways = elements.where("elem = 'way'")
    way = ways.select("map_id", F.col("id").alias("way_id"), "ord", tag("type").alias("type"), tag("subtype").alias("subtype"), tag("lane_change").alias("lane_change"), "tags")
    refs = ways.select("map_id", F.col("id").alias("way_id"), F.posexplode("nds").alias("seq", "node_id"))
    rels = elements.where("elem = 'relation'")
    names = ("type", "subtype", "location", "one_way", "speed_limit", "turn_direction", "intersection_area")
    rel = rels.select("map_id", F.col("id").alias("rel_id"), "ord", *[tag(k).alias(k) for k in names], tag("participant:pedestrian").alias("pedestrian"), "tags")
    member = rels.select("map_id", F.col("id").alias("rel_id"), F.posexplode("members").alias("seq", "m")).select("map_id", "rel_id", "seq", "m.mtype", "m.ref", "m.role")
    return MapTables(node, way, refs, rel, member)


def node_samples(node: DataFrame, most: int = 2000) -> DataFrame:
    """Every k-th node of a map by document order, k = max(1, nodes // most), of those the ones with all coordinates."""
    from roadloom.operators.skew import numbered

    total = node.groupBy("map_id").agg(F.greatest(F.lit(1), F.floor(F.count("*") / most)).alias("_k"))
    rows = numbered(node, "map_id", ["ord"], "_rn").join(total, "map_id").where("(_rn - 1) % _k = 0").drop("_rn", "_k")
    return rows.where("lat is not null and lon is not null and tags['local_x'] is not null and tags['local_y'] is not null")
