"""The structural checks of plan-view maps as queries: the given road tables in the shape of parsed files, with SQL.

Each road is drawn as two straight primitives along the x axis; every fifth road has a gap between them and every
seventh an unreadable length on the second. Lanes are 0, 1 .. road % 3 on the left and -1 .. -(road % 4) on the right,
with one width each; every eleventh road misses lane 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.operators import plan_checks as K
from roadloom.plans.more_queries import _ROADS, connections, junctions, links, roads
from roadloom.sources.xodr_xml import PlanTables


def plan_tables(spark: SparkSession, sf: str) -> PlanTables:
    text = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, elem: str, ord_, keys: dict, attrs: dict) -> DataFrame:
        pack = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), text(v))]) if d else F.create_map(F.lit("-"), none)
        return df.select("map_id", F.lit(elem).alias("elem"), ord_.cast("bigint").alias("ord"), pack(keys).alias("keys"), pack(attrs).alias("attrs"), none.alias("text"))

    r = roads(spark, sf)
    key = {"owner": "road_id", "owner_ord": "road_id"}
    per_map = r.groupBy("map_id").agg(F.count("*").alias("n"), F.count_if(F.col("length").isNull()).alias("bad"))
    out = rows(per_map, "file", F.lit(0), {}, {"root": F.lit("OpenDRIVE"), "numbers": "n", "unfinite": "bad"})
    out = out.union(rows(per_map, "header", F.lit(1), {}, {"revMajor": F.when(F.col("map_id") % 3 > 0, "1"), "revMinor": F.lit("4")}))
    out = out.union(rows(r, "road", F.col("road_id"), {}, {"id": "road_id", "length": "length", "junction": F.coalesce(text("junction"), F.lit("-1")), "name": "name"}))
    half = F.col("length") / 2
    one = rows(r, "geometry", F.col("road_id") * 10, key, {"s": F.lit("0"), "x": F.lit("0"), "y": F.lit("0"), "hdg": F.lit("0"), "length": half, "kind": F.lit("line")})
    two = rows(r, "geometry", F.col("road_id") * 10 + 1, key, {"s": half, "x": half + F.when(F.col("road_id") % 5 == 0, 0.1).otherwise(0.0), "y": F.lit("0"), "hdg": F.lit("0"), "length": F.when(F.col("road_id") % 7 > 0, half), "kind": F.lit("line")})
    out = out.union(one).union(two).union(rows(r, "lane_section", F.col("road_id") * 10 + 2, key, {"s": F.lit("0")}))
    lanes = r.select("map_id", "road_id", F.explode(F.expr("sequence(-cast(road_id % 4 as int), cast(road_id % 3 as int))")).alias("lane")).where("lane <> 1 or road_id % 11 > 0")
    side = F.when(F.col("lane") > 0, "left").when(F.col("lane") < 0, "right").otherwise("center")
    at = F.col("road_id") * 1000 + 500 + F.col("lane")
    lane_key = key | {"section": F.col("road_id") * 10 + 2, "side": side, "lane": "lane", "lane_ord": at}
    out = out.union(rows(lanes, "lane", at, lane_key, {"id": "lane", "type": F.lit("driving")}))
    out = out.union(rows(lanes.where("lane <> 0"), "width", at * 10, lane_key, {"sOffset": F.lit("0"), "a": F.when(F.col("road_id") % 13 > 0, 3.5).otherwise(-1.0)}))
    l = links(spark, sf)  # noqa: E741
    out = out.union(rows(l, "road_link", F.col("link_id"), key, {"direction": "direction", "elementType": "element_type", "elementId": "element_id", "contactPoint": "contact_point"}))
    to = lanes.join(l.select("map_id", "road_id", "direction", "link_id"), ["map_id", "road_id"]).where("lane <> 0")
    out = out.union(rows(to, "lane_link", F.col("link_id") * 10 + F.col("lane") + 5, lane_key, {"direction": "direction", "id": "lane"}))
    out = out.union(rows(junctions(spark, sf), "junction", F.col("junction_id"), {}, {"id": "junction_id"}))
    c = connections(spark, sf).where("junction_id is not null")
    ck = {"owner": "junction_id", "owner_ord": "junction_id", "connection_ord": "ord"}
    out = out.union(rows(c, "connection", F.col("ord"), ck, {"id": "conn_id", "incomingRoad": "incoming_road", "connectingRoad": "connecting_road"}))
    return PlanTables(out.union(rows(c, "junction_lane_link", F.col("ord"), ck, {"from": F.lit("-1"), "to": F.lit("-1")})))


_LANES = "ln as (select map_id, road_id, unnest(range(-(road_id % 4), road_id % 3 + 1)) as lane from rd), la as (select * from ln where lane <> 1 or road_id % 11 > 0), maps as (select distinct map_id from rd)"


def _sql(req: str, body: str, status: str, bad: str = "coalesce(bad, 0)", total: str = "coalesce(total, 0)") -> str:
    return f"with {_ROADS}, {_LANES}, found as ({body}) select m.map_id, '{req}' as req_id, {status} as status, cast({bad} as bigint) as offenders, cast({total} as bigint) as total from maps m left join found f using (map_id)"


_V = "case when coalesce(bad, 0) = 0 then 'PASS' else 'FAIL' end"
_SQL = {
    "xodr-01": _sql("xodr-01", "select map_id from maps", "case when map_id % 3 > 0 then 'PASS' else 'FAIL' end", "0", "0"),
    "xodr-02": _sql("xodr-02", "select map_id from maps", "'SKIP'", "0", "0"),
    "xodr-03": _sql("xodr-03", "select map_id, count(*) as total, 0 as bad from rd group by map_id", _V),
    "xodr-04": _sql("xodr-04", "select map_id, count(*) as total, count(*) filter (length is null or isnan(length) or length <= 0 or road_id % 7 = 0) as bad from rd group by map_id", _V),
    "xodr-05": _sql("xodr-05", "select map_id, count(*) as total, count(*) filter (not isnan(length) and road_id % 5 = 0) as bad, count(*) filter (length is null or isnan(length)) as unknown from rd group by map_id", "case when unknown > 0 and bad = 0 then 'SKIP' when bad = 0 then 'PASS' else 'FAIL' end", "bad", "case when unknown > 0 and bad = 0 then 0 else total end"),
    "xodr-06": _sql("xodr-06", """select map_id, count(*) as total, count(*) filter (road_id % 13 = 0 and (l > 0 or r > 0) or (l > 0 and road_id % 11 = 0 and road_id % 3 = 2) or (l = 0 and r = 0) or (not isnan(length) and length is not null and length + 0.000001 <= 0 and (l > 0 or r > 0))) as bad
  from (select rd.map_id, rd.road_id, any_value(length) as length, count(*) filter (lane > 0) as l, count(*) filter (lane < 0) as r from rd left join la on la.map_id = rd.map_id and la.road_id = rd.road_id group by rd.map_id, rd.road_id) group by map_id""", _V),
    "xodr-07": _sql("xodr-07", "select map_id, count(*) as total, count(*) filter (not exists (select 1 from (select map_id, 'road' as t, road_id as i from rd union all select map_id, 'junction', junction_id from jn) k where k.map_id = lk.map_id and k.t = lk.element_type and k.i = lk.element_id)) as bad from lk group by map_id", _V),
    "xodr-08": _sql("xodr-08", """select map_id, count(*) as total, count(*) filter (exists (select 1 from rd r where r.map_id = x.map_id and r.road_id = x.to_road) and not exists (select 1 from la b where b.map_id = x.map_id and b.road_id = x.to_road and b.lane = x.lane)) as bad
  from (select lk.map_id, lk.road_id, lk.link_id, la.lane, t.to_road from lk join la on la.map_id = lk.map_id and la.road_id = lk.road_id and la.lane <> 0 left join (select map_id, road_id, direction, arg_max(element_id, link_id) as to_road from lk where element_type = 'road' group by all) t on t.map_id = lk.map_id and t.road_id = lk.road_id and t.direction = lk.direction) x group by map_id""", _V),
    "xodr-09": _sql("xodr-09", """select map_id, any_value(total) as total, any_value(c) + count(*) filter (not exists (select 1 from cn where cn.map_id = jn.map_id and cn.junction_id = jn.junction_id)) as bad from jn left join (
    select c.map_id, count(*) as total, count(*) filter (i.road_id is null or r.road_id is null or r.junction is distinct from c.junction_id or not exists (select 1 from la where la.map_id = c.map_id and la.road_id = c.incoming_road and lane = -1) or not exists (select 1 from la where la.map_id = c.map_id and la.road_id = c.connecting_road and lane = -1)) as c
    from cn c left join rd i on i.map_id = c.map_id and i.road_id = c.incoming_road left join rd r on r.map_id = c.map_id and r.road_id = c.connecting_road where c.junction_id is not null group by c.map_id) using (map_id) group by map_id""", "case when bad is null then 'SKIP' when bad = 0 then 'PASS' else 'FAIL' end"),
    "xodr-10": _sql("xodr-10", "select map_id, count(*) as total, count(*) filter (not exists (select 1 from cn c where c.map_id = rd.map_id and c.junction_id = rd.junction and c.connecting_road = rd.road_id)) as bad from rd where junction is not null group by map_id", "case when coalesce(total, 0) = 0 then 'SKIP' when bad = 0 then 'PASS' else 'FAIL' end"),
    "xodr-11": _sql("xodr-11", "select map_id, count(*) as total, count(*) filter (length is null or isnan(length)) as bad from rd group by map_id", _V),
}


def _check(req: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: K.CHECKS[req](plan_tables(spark, sf)).select("map_id", "req_id", "status", "offenders", "total")


QUERIES = {f"check_{r.replace('-', '_')}": _check(r) for r in K.CHECKS}
SQL = {f"check_{r.replace('-', '_')}": s for r, s in _SQL.items()}
