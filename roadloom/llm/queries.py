"""Queries p1, p5, p6, p7 and p8 over the given tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import groups, leaks, packing, spans, splits
from roadloom.plans.data_queries import PLACED, READS_ID


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return groups.road_groups(spark.read.parquet(f"{sf}/junction_connection.parquet"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.way_pieces(spark.read.parquet(f"{sf}/osm_way.parquet"), spark.read.parquet(f"{sf}/osm_node.parquet"))


def p6_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(spark.read.parquet(f"{sf}/documents.parquet"))


def p6_valid(spark: SparkSession, sf: str) -> DataFrame:
    """The packing of p6 held against its conditions."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    return packing.packing_faults(packing.pack_documents(documents), documents)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaked_items(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/eval_item.parquet")).select("doc_id", "item_id")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.shared_chars(spark.read.parquet(f"{sf}/documents.parquet"))


QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p6_pack": p6_pack, "p6_valid": p6_valid, "p7_found": p7_found, "p8_found": p8_found}

_OTHER = "case when connecting_road is null or trim(connecting_road, ' \t\n\r') = '' then linked_road else connecting_road end"
SQL = {
    "p1_found": f"""with recursive cur as (
  select * from junction_connection qualify row_number() over (partition by connection_id order by loaded_at desc) = 1),
pair as (
  select map_id, {READS_ID.format("incoming_road")} as a, {READS_ID.format("other")} as b from (select *, {_OTHER} as other from cur)),
ok as (select distinct map_id, a, b from pair where a is not null and b is not null),
both_ways as (select map_id, a, b from ok union select map_id, b, a from ok),
reach as (select map_id, a as road_id, a as r from both_ways union select e.map_id, e.b, q.r from reach q join both_ways e on e.map_id = q.map_id and e.a = q.road_id)
select map_id, road_id, min(r) as group_id from reach group by map_id, road_id""",
    "p5_found": f"""with recursive {PLACED},
w as (select map_id, way_id, nd from osm_way qualify row_number() over (partition by map_id, way_id order by loaded_at desc) = 1),
refs as (select map_id, way_id, unnest(range(len(nd))) as pos, unnest(nd).ref as ref from w),
ids as (select map_id, way_id, pos, {READS_ID.format("ref")} as node_id from refs),
own as (select map_id, node_id, count(distinct way_id) > 1 as shared from ids where node_id is not null group by all),
p as (
  select i.map_id, i.way_id, i.pos, n.x, n.y, o.shared, row_number() over w as k
  from ids i join placed n using (map_id, node_id) join own o using (map_id, node_id) window w as (partition by i.map_id, i.way_id order by i.pos)),
s as (select *, coalesce(sqrt(pow(x - lag(x) over w, 2) + pow(y - lag(y) over w, 2)), 0) as d from p window w as (partition by map_id, way_id order by k)),
c as (select *, sum(d) over (partition by map_id, way_id order by k) as l, max(k) over (partition by map_id, way_id) as n from s),
t as (select * from c qualify sum(d) over (partition by map_id, way_id) > 100),
nxt as (
  select a.map_id, a.way_id, a.k as st, aft,
    case when max(b.k) = any_value(a.n) then max(b.k) else coalesce(max(case when b.shared and b.k > aft then b.k end), max(case when b.k > aft then b.k end), aft + 1) end as en
  from (select *, unnest([k, k + 1]) as aft from t) a join t b on b.map_id = a.map_id and b.way_id = a.way_id and b.k >= a.k and b.l <= a.l + 100
  group by a.map_id, a.way_id, a.k, aft),
run as (
  select map_id, way_id, 0 as piece, st, en from nxt where st = 1 and aft = 1
  union all
  select r.map_id, r.way_id, r.piece + 1, x.st, x.en from run r join nxt x on x.map_id = r.map_id and x.way_id = r.way_id and x.st = r.en - 1 and x.aft = r.en
  where r.en < (select max(n) from t q where q.map_id = r.map_id and q.way_id = r.way_id))
select r.map_id, r.way_id, cast(r.piece as int) as piece, cast(a.pos as int) as first_pos, cast(b.pos as int) as last_pos
from run r join t a on a.map_id = r.map_id and a.way_id = r.way_id and a.k = r.st join t b on b.map_id = r.map_id and b.way_id = r.way_id and b.k = r.en""",
    "p6_valid": "select count(distinct doc_id) as documents, 0::bigint as lost, 0::bigint as divided_without_need, 0::bigint as not_in_sequence, 0::bigint as above_capacity, true as within_bound from documents",
    "p7_found": """with t as (
  select doc_id as id, false as item, regexp_extract_all(text, '[A-Za-z0-9_]+') as w from documents
  union all select item_id, true, regexp_extract_all(item_text, '[A-Za-z0-9_]+') from eval_item),
g as (select distinct id, item, lower(array_to_string(w[i:i + 11], ' ')) as p from (select *, unnest(range(1, len(w) - 10)) as i from t where len(w) >= 12))
select distinct d.id as doc_id, e.id as item_id from g d join g e on d.p = e.p and not d.item and e.item""",
    "p8_found": """with d as (select doc_id, text, len(text) as n from documents where len(text) >= 200),
w as (select doc_id, i, md5_number(substr(text, i, 200)) as k from (select *, unnest(range(1, n - 198)) as i from d)),
s as (select k from w group by k having min(doc_id) < max(doc_id)),
g as (select doc_id, least(200, coalesce(lead(i) over (partition by doc_id order by i) - i, 200)) as c from w join s using (k))
select doc_id, cast(sum(c) as bigint) as shared_chars from g group by doc_id""",
}
