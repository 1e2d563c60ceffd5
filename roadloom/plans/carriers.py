"""The given tables in the shape of maps: current rows, ids read, words normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows, read_decimal, read_id, read_word
from roadloom.operators.maptables import MapTables, node_xy


def current(spark: SparkSession, sf: str, table: str, keys: list[str]) -> DataFrame:
    return current_rows(spark.read.parquet(f"{sf}/{table}.parquet"), keys)


def map_tables(spark: SparkSession, sf: str) -> MapTables:
    """Nodes, ways, refs, relations and members of the given tables; deleted ways and relations are left out."""
    x, y = node_xy(F.col("local_x"), F.col("local_y"), F.col("lon"), F.col("lat"))
    node = current(spark, sf, "osm_node", ["map_id", "node_id"]).select("map_id", "node_id", x.alias("x"), y.alias("y"), read_decimal(F.col("ele")).alias("ele"))
    way = current(spark, sf, "osm_way", ["map_id", "way_id"]).where("deleted_at is null")
    refs = way.select("map_id", "way_id", F.posexplode("nd").alias("seq", "_nd")).select("map_id", "way_id", "seq", read_id(F.col("_nd.ref")).alias("node_id")).where("node_id is not null")
    way = way.select("map_id", "way_id", F.col("way_id").alias("ord"), F.col("way_type").alias("type"), "subtype", "lane_change")
    rel = current(spark, sf, "osm_relation", ["map_id", "rel_id"]).where("deleted_at is null")
    none = F.lit(None).cast("string")
    rel = rel.select("map_id", "rel_id", F.col("rel_id").alias("ord"), F.col("rel_type").alias("type"), "subtype", "location", "one_way", "speed_limit", "turn_direction", none.alias("intersection_area"), none.alias("pedestrian"))
    member = current(spark, sf, "osm_member", ["member_id"])
    member = member.select("map_id", "rel_id", F.struct("seq", "member_id").alias("seq"), read_word(F.col("mtype")).alias("mtype"), read_id(F.col("ref")).alias("ref"), read_word(F.col("role")).alias("role")).where("ref is not null")
    return MapTables(node, way, refs, rel, member)
