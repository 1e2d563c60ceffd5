"""Queries p2, p3 and p4 over the given tables, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import keys, nearby, nested, orphans
from roadloom.storage import Scratch

READS_ID = "case when regexp_full_match({0}, '\\s*[0-9]+\\s*') then try_cast(trim({0}) as bigint) end"
PLACED = r"""placed as (
  select map_id, node_id, try_cast(trim(local_x) as double) as x, try_cast(trim(local_y) as double) as y
  from (select *, row_number() over (partition by map_id, node_id order by loaded_at desc) as rn from osm_node)
  where rn = 1 and regexp_full_match(local_x, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*')
    and regexp_full_match(local_y, '\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'))"""


def tables(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in names}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return nearby.close_nodes(spark.read.parquet(f"{sf}/osm_node.parquet"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    names = ("osm_member", "junction_connection", "road_link", "osm_node", "osm_way", "osm_relation", "road", "junction")
    return orphans.orphan_cases(spark, tables(spark, sf, *names))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return nested.flatten_records(nested.current_records(spark.read.parquet(f"{sf}/raw_map_record.parquet")))


def p2_regions(spark: SparkSession, sf: str) -> DataFrame:
    """How many placed nodes the box round each way's placed points holds."""
    nodes = nearby.placed_nodes(spark.read.parquet(f"{sf}/osm_node.parquet"))
    ways = keys.current_rows(spark.read.parquet(f"{sf}/osm_way.parquet").select("map_id", "way_id", "nd", "loaded_at"), ["map_id", "way_id"])
    refs = ways.select("map_id", "way_id", F.explode("nd.ref").alias("ref")).select("map_id", "way_id", keys.read_id(F.col("ref")).alias("node_id"))
    at = refs.join(nodes, ["map_id", "node_id"]).groupBy("map_id", "way_id").agg(F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"))
    return nearby.points_in_boxes(nodes, at, 5.0, "map_id").groupBy("map_id", "way_id").agg(F.count("*").alias("nodes"))


def p4_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables of p4 written by tag, read back under their own names, and counted."""
    store = Scratch(spark, "nested")
    nested.write_tables(p4_found(spark, sf), store.path("tagged"))
    tagged = spark.read.schema(nested.TAGGED).parquet(store.path("tagged"))
    every = []
    for elem, (parent, value) in nested.TABLES.items():
        t = nested.table_of(tagged, elem)
        every.append(t.agg(F.lit(elem).alias("elem"), F.count("*").alias("n"), F.count_distinct("record_id", f"{parent}_key").alias("parents"), F.count(F.when(F.col(value).cast("string") != "", 1)).alias("with_value")))
    return reduce(DataFrame.unionByName, every)


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p2_regions": p2_regions, "p4_tables": p4_tables}

_WORD = "nullif(lower(trim({0}, ' \t\n\r')), '')"
SQL = {
    "p2_found": f"""with {PLACED}
select a.map_id, a.node_id as node_id_a, b.node_id as node_id_b
from (select *, unnest([-1, 0, 1]) as i from placed) a, (select unnest([-1, 0, 1]) as j) s, placed b
where a.map_id = b.map_id and cast(floor(a.x) as bigint) + i = cast(floor(b.x) as bigint)
  and cast(floor(a.y) as bigint) + j = cast(floor(b.y) as bigint) and a.node_id < b.node_id
  and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.25""",
    "p3_found": f"""with refs as (
  select 'osm_member' as ref_table, member_id as ref_id, map_id, ref as t, {_WORD.format("mtype")} as kind, loaded_at from osm_member
  union all select 'junction_connection', connection_id, map_id, connecting_road, 'road', loaded_at from junction_connection
  union all select 'road_link', link_id, map_id, element_id, {_WORD.format("element_type")}, loaded_at from road_link),
cur as (
  select *, {READS_ID.format("t")} as k from refs qualify row_number() over (partition by ref_table, ref_id order by loaded_at desc) = 1),
recs as (
  select 'node' as kind, map_id, node_id as k, loaded_at, false as gone from osm_node
  union all select 'way', map_id, way_id, loaded_at, deleted_at is not null from osm_way
  union all select 'relation', map_id, rel_id, loaded_at, deleted_at is not null from osm_relation
  union all select 'road', map_id, {READS_ID.format("road_id")}, loaded_at, deleted_at is not null from road
  union all select 'junction', map_id, {READS_ID.format("junction_id")}, loaded_at, deleted_at is not null from junction),
par as (select kind, map_id, k, min(loaded_at) as first_at, arg_max(gone, loaded_at) as gone from recs group by all),
res as (
  select c.ref_table, c.ref_id, case when p.kind is null then 'missing' when p.gone then 'deleted' when p.first_at > c.loaded_at then 'late' end as reason,
    strftime(c.loaded_at, '%Y-%m') as period
  from cur c left join par p on p.kind = c.kind and p.map_id = c.map_id and p.k = c.k
  where c.kind is not null and trim(c.t, ' \t\n\r') <> '')
select ref_table, ref_id, reason, period from res where reason is not null""",
    "p4_found": r"""with cur as (select * from raw_map_record qualify row_number() over (partition by record_id order by loaded_at desc) = 1),
ok as (select record_id, kind, payload from cur where payload is not null and json_valid(payload)),
t as (select o.record_id, o.kind, j.key, j.fullkey, j.path, j.type, trim(j.atom ->> '$', ' ' || chr(9) || chr(10) || chr(13)) as v from ok o, json_tree(o.payload) j),
att as (select record_id, path, max(v) filter (key in ('id', '@id', '_id')) as id, max(v) filter (key in ('sOffset', '@sOffset', '_sOffset')) as s, max(v) filter (key in ('connectingRoad', '@connectingRoad', '_connectingRoad')) as road,
  max(v) filter (key in ('from', '@from', '_from')) as f, max(v) filter (key in ('to', '@to', '_to')) as o, max(v) filter (key in ('role', '@role', '_role')) as role from t where path is not null group by all),
el as (select record_id, kind, fullkey, coalesce(try_cast(regexp_extract(fullkey, '\[(\d+)\]$', 1) as int), 0) as pos, regexp_extract(fullkey, '^(.*)\.\w+(?:\[\d+\])?$', 1) as up from t where type = 'OBJECT'),
top as (select record_id, kind, fullkey from el where regexp_full_match(fullkey, '.*\.' || kind || '(\[\d+\])?')),
lane as (
  select e.record_id, e.fullkey, coalesce(r.id, '') || '/' || coalesce(nullif(regexp_extract(e.fullkey, '\.laneSection\[(\d+)\]\.\w+\.lane(?:\[\d+\])?$', 1), ''), '0') || '/' || regexp_extract(e.fullkey, '\.(left|center|right)\.lane(?:\[\d+\])?$', 1) || '/' || coalesce(a.id, '') as parent
  from el e join top p on p.record_id = e.record_id and p.kind = 'road' and regexp_full_match(substr(e.fullkey, len(p.fullkey) + 1), '\.lanes\.laneSection(\[\d+\])?\.(left|center|right)\.lane(\[\d+\])?') and starts_with(e.fullkey, p.fullkey)
  left join att r on r.record_id = p.record_id and r.path = p.fullkey left join att a on a.record_id = e.record_id and a.path = e.fullkey),
con as (
  select e.record_id, e.fullkey, coalesce(r.id, '') as parent, e.pos, coalesce(a.road, '') as val
  from el e join top p on p.record_id = e.record_id and p.kind = 'junction' and e.up = p.fullkey and regexp_full_match(e.fullkey, '.*\.connection(\[\d+\])?') left join att r on r.record_id = p.record_id and r.path = p.fullkey left join att a on a.record_id = e.record_id and a.path = e.fullkey)
select distinct e.record_id, case when regexp_full_match(e.fullkey, '.*\.width(\[\d+\])?') then 'width' else 'road_mark' end as elem, l.parent, e.pos,
  case when regexp_full_match(a.s, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') then cast(cast(round_even(cast(a.s as double) * 1000, 0) as bigint) as varchar) else '' end as val
from el e join lane l on l.record_id = e.record_id and l.fullkey = e.up and regexp_full_match(e.fullkey, '.*\.(width|roadMark)(\[\d+\])?') left join att a on a.record_id = e.record_id and a.path = e.fullkey
union all select distinct record_id, 'connection', parent, pos, val from con
union all select distinct e.record_id, 'lane_link', c.parent || '/' || c.pos, e.pos, coalesce(a.f, '') || ':' || coalesce(a.o, '') from el e join con c on c.record_id = e.record_id and c.fullkey = e.up and regexp_full_match(e.fullkey, '.*\.laneLink(\[\d+\])?') left join att a on a.record_id = e.record_id and a.path = e.fullkey
union all select distinct e.record_id, 'member', coalesce(r.id, ''), e.pos, coalesce(a.role, '') from el e join top p on p.record_id = e.record_id and p.kind = 'relation' and e.up = p.fullkey and regexp_full_match(e.fullkey, '.*\.member(\[\d+\])?')
  left join att r on r.record_id = p.record_id and r.path = p.fullkey left join att a on a.record_id = e.record_id and a.path = e.fullkey""",
}

SQL["p2_regions"] = f"""with {PLACED},
w as (select map_id, way_id, unnest(nd).ref as ref from (select map_id, way_id, nd from osm_way qualify row_number() over (partition by map_id, way_id order by loaded_at desc) = 1)),
b as (select w.map_id, w.way_id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from w join placed p on p.map_id = w.map_id and p.node_id = {READS_ID.format("ref")} group by all)
select b.map_id, b.way_id, count(*) as nodes from b join placed p on p.map_id = b.map_id and p.x between x0 and x1 and p.y between y0 and y1 group by all"""
SQL["p4_tables"] = f"""select k.elem, count(t.elem) as n, count(distinct (t.record_id, t.parent)) filter (t.elem is not null) as parents, count(*) filter (t.val <> '') as with_value
from (select unnest(['width', 'road_mark', 'connection', 'lane_link', 'member']) as elem) k left join ({SQL["p4_found"]}) t using (elem) group by k.elem"""
