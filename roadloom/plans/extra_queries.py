"""Further rows of the inventory as queries over the given tables, with SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import polyline as P
from roadloom.operators import fidelity as D
from roadloom.operators import links as L
from roadloom.operators import map_checks as C
from roadloom.operators import maptables as T
from roadloom.operators import passes as X
from roadloom.operators import summaries as S
from roadloom.operators.keys import read_decimal
from roadloom.operators.projection import fit_projections
from roadloom.plans.carriers import current, map_tables
from roadloom.plans.map_queries import _PAIRS, BASE
from roadloom.plans.more_queries import _ROADS, connections, degrees, edges, lanes, links, roads
from roadloom.sinks import writers as W
from roadloom.sources.config import DEFAULTS, speed_kmh
from roadloom.sources.osm_xml import osm_tables, read_osm
from roadloom.storage import Scratch

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = BASE):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = f"with {base}{sql}" if base else sql
        return f

    return add


@query("f01_tag_pivot", """ select map_id, rel_id, subtype, location, one_way from rel0 where subtype is not null or location is not null or one_way is not null""")
def f01(spark, sf):
    r = current(spark, sf, "osm_relation", ["map_id", "rel_id"])
    tags = r.select("map_id", "rel_id", F.expr("stack(3, 'subtype', subtype, 'location', location, 'one_way', one_way) as (k, v)")).where("v is not null")
    old = tags.withColumns({"ord": F.lit(0), "v": F.lit("an earlier value")})
    return T.pivot_tags(old.unionByName(tags.withColumn("ord", F.lit(1))), ["map_id", "rel_id"], ["subtype", "location", "one_way"])


@query("f04_road_lanelets", " select map_id, rel_id, subtype, turn_direction is not null as connector from ll where subtype in ('road', 'road_shoulder')")
def f04(spark, sf):
    return S.road_lanelets(map_tables(spark, sf)).select("map_id", "rel_id", "subtype", "connector")


@query("f06_regulatory_kinds", " select map_id, subtype, count(*) as n from reg group by all")
def f06(spark, sf):
    return S.regulatory_kinds(map_tables(spark, sf))


@query("f07_exempt_lanelets", """ select l.map_id, l.rel_id, b.l is null or b.r is null or coalesce(subtype in ('walkway', 'crosswalk'), false) or turn_direction is not null as exempt from ll l left join bnd b using (map_id, rel_id)""")
def f07(spark, sf):
    return C.exempt(map_tables(spark, sf)).select("map_id", "rel_id", "exempt")


@query("f08_real_lanelets", " select b.map_id, b.rel_id from bnd b left join len x on x.map_id = b.map_id and x.way_id = b.l left join len y on y.map_id = b.map_id and y.way_id = b.r where greatest(coalesce(x.len, 0), coalesce(y.len, 0)) >= 1")
def f08(spark, sf):
    s = map_tables(spark, sf).shaped
    return s.where(F.greatest(P.length(F.col("lp")), P.length(F.col("rp"))) >= M.MIN_BOUNDARY).select("map_id", "rel_id")


@query("f09_subtype_boundaries", " select s.map_id, l.subtype, count(*) as lines from side s join ll l using (map_id, rel_id) join len using (map_id, way_id) where len.n >= 2 and len.len >= 1 group by all")
def f09(spark, sf):
    return S.subtype_boundaries(map_tables(spark, sf)).groupBy("map_id", "subtype").agg(F.count("*").alias("lines"))


_DEG = "(select map_id, node_id, lat, lon from node0)"


@query("f13_repaired_ends", f""", o as (select map_id, way_id from side join ll using (map_id, rel_id) group by all having bool_and(coalesce(subtype in ('walkway', 'road_shoulder'), false))),
q as (select w.map_id, w.way_id, w.seq, d.lat, d.lon, row_number() over v as k, count(*) over (partition by w.map_id, w.way_id) as n, count(d.lat + d.lon) over (partition by w.map_id, w.way_id) as c, lead(d.lat) over v as la, lead(d.lon) over v as lo
  from wn w join o using (map_id, way_id) left join {_DEG} d using (map_id, node_id) window v as (partition by w.map_id, w.way_id order by w.seq)),
g as (select map_id, way_id, any_value(n) as n, cast(bool_or(k = 1 and far) as int) + cast(bool_or(k = n - 1 and far) as int) as d from (select *, 2 * 6378137 * asin(sqrt(power(sin(radians(la - lat) / 2), 2) + cos(radians(lat)) * cos(radians(la)) * power(sin(radians(lo - lon) / 2), 2))) > 30 as far from q where n >= 3 and c = n) group by map_id, way_id)
select map_id, count(*) as ways_trimmed, cast(sum(d) as bigint) as endpoints_dropped from g where d > 0 and n - d >= 2 group by map_id""")
def f13(spark, sf):
    t = map_tables(spark, sf)
    t.node = t.node.join(degrees(spark, sf), ["map_id", "node_id"], "left")
    return X.repair_ends(t)[1].withColumn("endpoints_dropped", F.col("endpoints_dropped").cast("bigint"))


@query("f27_valid_edges", " select map_id, src_road, src_lane, dst_road, dst_lane, ord from ed", _ROADS)
def f27(spark, sf):
    return L.valid_edges(edges(spark, sf), lanes(spark, sf))


@query("j02_lanelet_sides", " select b.map_id, b.rel_id, coalesce(x.n, 0) as left_points, coalesce(y.n, 0) as right_points from bnd b left join len x on x.map_id = b.map_id and x.way_id = b.l left join len y on y.map_id = b.map_id and y.way_id = b.r")
def j02(spark, sf):
    s = map_tables(spark, sf).shaped.where("left is not null or right is not null")
    return s.select("map_id", "rel_id", F.greatest(F.size("lp"), F.lit(0)).cast("bigint").alias("left_points"), F.greatest(F.size("rp"), F.lit(0)).cast("bigint").alias("right_points"))


@query("j03_ruled_speed", " select distinct m.map_id, m.rel_id from mem m join reg g on g.map_id = m.map_id and g.rel_id = m.ref where g.subtype = 'speed_limit' and m.mtype = 'relation'")
def j03(spark, sf):
    return C.ruled_lanelets(map_tables(spark, sf))


@query("j04_loose_crosswalks", " select map_id, rel_id from ll l where subtype = 'crosswalk' and not exists (select 1 from mem m join reg g on g.map_id = m.map_id and g.rel_id = m.rel_id where m.map_id = l.map_id and m.ref = l.rel_id and m.role = 'refers' and g.subtype = 'crosswalk')")
def j04(spark, sf):
    return C.loose_crosswalks(map_tables(spark, sf)).select("map_id", "rel_id")


@query("j12_shoulder_twins", ", " + _PAIRS + """, subl as (select distinct s.map_id, s.way_id, l.subtype from side s join ll l using (map_id, rel_id) join lines using (map_id, way_id))
select distinct p.map_id, least(p.a, p.b) as a, greatest(p.a, p.b) as b from pair p join subl x on x.map_id = p.map_id and x.way_id = p.a and x.subtype = 'road' join subl y on y.map_id = p.map_id and y.way_id = p.b and y.subtype = 'road_shoulder' where least(fwd, rev) < 2""")
def j12(spark, sf):
    t = map_tables(spark, sf)
    sub = t.sides.join(t.lanelets.select("map_id", "rel_id", "subtype"), ["map_id", "rel_id"])
    of = lambda s: t.boundary_lines.join(sub.where(F.col("subtype") == s).select("map_id", "way_id"), ["map_id", "way_id"], "left_semi")
    return T.twins(of("road"), of("road_shoulder"), 2.0)


@query("j21_way_pairs", " select b.map_id, b.rel_id as cr_id, m.rel_id from bnd b join (select map_id, l, r, max(rel_id) as rel_id from bnd group by all) m on m.map_id = b.map_id and m.l = b.l and m.r = b.r")
def j21(spark, sf):
    b = map_tables(spark, sf).bounds.withColumnsRenamed({"left": "left_way", "right": "right_way"})
    return L.way_pair_mapping(b.select("map_id", F.col("rel_id").alias("cr_id"), "left_way", "right_way"), b.withColumn("ord", F.col("rel_id")))


@query("a30_directions", """, e as (select b.map_id, b.rel_id, (a1.x + c1.x) / 2 - (a0.x + c0.x) / 2 as dx, (a1.y + c1.y) / 2 - (a0.y + c0.y) / 2 as dy from bnd b join pt a0 on a0.map_id = b.map_id and a0.way_id = b.l and a0.k = 1 join pt a1 on a1.map_id = b.map_id and a1.way_id = b.l and a1.k = a1.n
  join pt c0 on c0.map_id = b.map_id and c0.way_id = b.r and c0.k = 1 join pt c1 on c1.map_id = b.map_id and c1.way_id = b.r and c1.k = c1.n)
select map_id, rel_id, round(dx / sqrt(dx * dx + dy * dy), 6) as x, round(dy / sqrt(dx * dx + dy * dy), 6) as y from e where dx <> 0 or dy <> 0""")
def a30(spark, sf):
    s = map_tables(spark, sf).shaped.where("size(lp) > 0 and size(rp) > 0").withColumn("d", P.direction(F.col("lp"), F.col("rp")))
    return s.where("d is not null").select("map_id", "rel_id", F.round("d.x", 6).alias("x"), F.round("d.y", 6).alias("y"))


@query("a41_topology_report", """, p as (select map_id, road_id, lag(road_id) over w as l, lead(road_id) over w as r from rd window w as (partition by map_id order by road_id)),
q as (select map_id, road_id, direction as kind, element_id as target from lk where element_type = 'road' and element_id is not null)
select p.map_id, count(*) as lanelets, cast(sum(cast(l is not null and road_id % 2 = 0 as int) + cast(r is not null and road_id % 2 = 0 as int)) as bigint) as adjacent_same_direction, cast(sum(cast(l is not null and road_id % 2 = 1 as int) + cast(r is not null and road_id % 2 = 1 as int)) as bigint) as adjacent_opposite_direction,
  count(*) filter (l is null and r is null and not exists (select 1 from q where q.map_id = p.map_id and q.road_id = p.road_id)) as isolated_lanelets, any_value(s) as successor_links, any_value(e) as predecessor_links, any_value(d) as dangling_links
from p join (select map_id, count(*) filter (kind = 'successor') as s, count(*) filter (kind = 'predecessor') as e, count(*) filter (not exists (select 1 from rd where rd.map_id = q.map_id and rd.road_id = q.target)) as d from q group by map_id) z using (map_id) group by p.map_id""", _ROADS)
def a41(spark, sf):
    w = Window.partitionBy("map_id").orderBy("road_id")
    even = F.col("road_id") % 2 == 0
    ll = roads(spark, sf).select("map_id", F.col("road_id").alias("rel_id"), F.lag("road_id").over(w).alias("left"), even.alias("left_same"), F.lead("road_id").over(w).alias("right"), even.alias("right_same"))
    l = links(spark, sf).where("element_type = 'road' and element_id is not null").select("map_id", F.col("road_id").alias("rel_id"), F.col("direction").alias("kind"), F.col("element_id").alias("target"))  # noqa: E741
    return L.topology_report(ll, l)


@query("a42_projection_fit")
def a42(spark, sf):
    """The best of each map's own candidate projections with its errors, and whether it is accepted."""
    n = current(spark, sf, "osm_node", ["map_id", "node_id"])
    n = n.select("map_id", "lat", "lon", read_decimal(F.col("local_x")).alias("x"), read_decimal(F.col("local_y")).alias("y"))
    return fit_projections(n).select("map_id", "candidate", "source", F.round("rmse", 4).alias("rmse"), F.round("max_error", 4).alias("max_error"), "nodes")


@query("a44_map_centres", " select map_id, round_even((min(lat) + max(lat)) / 2, 6) as lat, round_even((min(lon) + max(lon)) / 2, 6) as lon from (select * from node0 where lat is not null and lon is not null) group by map_id")
def a44(spark, sf):
    return S.map_centres(degrees(spark, sf))


@query("a48_busiest_junction", " select map_id, junction_id, n from (select *, row_number() over (partition by map_id order by n desc, junction_id) as k from (select map_id, junction_id, count(*) as n from cn where junction_id is not null group by all)) where k = 1", _ROADS)
def a48(spark, sf):
    return S.busiest(connections(spark, sf), "junction_id")


@query("a49_extent", " select map_id, count(distinct way_id) as ways, count(distinct node_id) as nodes, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1, count(*) filter (ele is null) as without_ele from pt group by map_id")
def a49(spark, sf):
    t = map_tables(spark, sf)
    return S.extent(t.way_node.join(t.node, ["map_id", "node_id"]), ["way_id", "node_id"], "ele")


@query("c15_fixed_decimals", " select map_id, node_id, floor(x * 10000 + 0.5) / 10000 as x, floor(y * 10000 + 0.5) / 10000 as y, floor(coalesce(ele, 0) * 10000 + 0.5) / 10000 as ele from node")
def c15(spark, sf):
    return map_tables(spark, sf).node.select("map_id", "node_id", *[S.fixed(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("x", "y", "ele")])


@query("c18_greatest_id", " select map_id, max(i) as top from (select map_id, node_id as i from node union all select map_id, way_id from way union all select map_id, rel_id from rel) group by map_id")
def c18(spark, sf):
    return X.greatest_id(map_tables(spark, sf))


_DEFAULT = "case location " + " ".join(f"when '{k}' then {v}" for k, v in DEFAULTS.items()) + " end"


@query("s10_speed_limits", f""" select map_id, rel_id, round(coalesce(try_cast(nullif(regexp_extract(speed_limit, '^\\s*([0-9]+(?:\\.[0-9]+)?)\\s*(?:km/?h|kmh|mph)?\\s*$', 1), '') as double) * case when lower(speed_limit) like '%mph%' then 1.609344 else 1 end, {_DEFAULT}), 4) as kmh from ll""")
def s10(spark, sf):
    return map_tables(spark, sf).lanelets.select("map_id", "rel_id", F.round(speed_kmh(F.col("speed_limit"), F.col("location")), 4).alias("kmh"))


@query("s17_strided_candidates", " select map_id, way_id, k from (select map_id, way_id, row_number() over (partition by map_id order by way_id) - 1 as k, count(*) over (partition by map_id) as c from way) where k % greatest(1, c // 8) = 0 and k // greatest(1, c // 8) < 8")
def s17(spark, sf):
    """Eight candidates at an even stride from each map: a sampling operator."""
    return S.strided(map_tables(spark, sf).way.select("map_id", "way_id"), "way_id", 8)


@query("geo_p08_centre_in_outline", """, ring as (select b.map_id, b.rel_id, p.x, p.y, p.k as k from bnd b join pt p on p.map_id = b.map_id and p.way_id = b.l union all select b.map_id, b.rel_id, p.x, p.y, 1000000 - p.k from bnd b join pt p on p.map_id = b.map_id and p.way_id = b.r),
r2 as (select *, coalesce(lag(x) over w, first_value(x) over (partition by map_id, rel_id order by k desc)) as jx, coalesce(lag(y) over w, first_value(y) over (partition by map_id, rel_id order by k desc)) as jy from ring window w as (partition by map_id, rel_id order by k)),
ctr as (select map_id, rel_id, avg(x) + 0.0137 as cx, avg(y) + 0.0171 as cy from ring group by all)
select map_id, rel_id, count(*) filter ((r.y > cy) <> (jy > cy) and cx < (jx - r.x) * (cy - r.y) / (jy - r.y + 1e-12) + r.x) % 2 = 1 as inside from r2 r join ctr using (map_id, rel_id) group by all""")
def p08(spark, sf):
    s = map_tables(spark, sf).shaped.withColumn("ring", D.lanelet_ring(F.col("lp"), F.col("rp"))).where("size(ring) > 0")
    return s.select("map_id", "rel_id", P.in_ring(P.mean(F.col("ring"), "x") + 0.0137, P.mean(F.col("ring"), "y") + 0.0171, F.col("ring")).alias("inside"))


@query("k04_sorted_ids", "select map_id, connecting_road as id, row_number() over (partition by map_id order by try_cast(connecting_road as bigint) nulls last, connecting_road) as nth from (select distinct map_id, connecting_road from junction_connection where connecting_road is not null)", "")
def k04(spark, sf):
    ids = spark.read.parquet(f"{sf}/junction_connection.parquet").select("map_id", F.col("connecting_road").alias("id")).where("id is not null").distinct()
    nth = F.row_number().over(Window.partitionBy("map_id").orderBy(*W.number_then_text("id")))
    return ids.select("map_id", "id", nth.cast("bigint").alias("nth"))


@query("k05_timing_log", """select repo as set_name, path as input_file, coalesce(case when n_chars % 3 > 0 then cast(n_chars as varchar) end, 'conversion_failed') as total_time_secs from (select repo, path, max(n_chars) as n_chars from documents where repo is not null and path is not null group by all)""", "")
def k05(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").where("repo is not null and path is not null").groupBy(F.col("repo").alias("set_name"), F.col("path").alias("input_file")).agg(F.max("n_chars").alias("n"))
    times = d.where("n % 3 > 0").select("set_name", "input_file", *[F.col("n").alias(c) for c in ("conversion_time_secs", "mapping_time_secs", "downsampling_time_secs", "total_time_secs")])
    return W.timing_log(d.select("set_name", "input_file"), times).select("set_name", "input_file", "total_time_secs")


@query("k12_report_lines", """, found as (select map_id, count(*) as total, count(*) filter (ele is null) as bad from node group by map_id)
select m.map_id, '  vm-07-04  ' || case when coalesce(total, 0) = 0 then 'SKIP' when bad = 0 then 'PASS' else 'FAIL' end || ' Ellipsoidal height — nodes without ele' || case when total > 0 then ' (' || bad || '/' || total || ')' else '' end as line from maps m left join found using (map_id)""")
def k12(spark, sf):
    return W.report_lines(C.heights(map_tables(spark, sf))).select("map_id", "line")


@query("k17_output_stems", r"select doc_id, regexp_extract(path, '([^/]+?)(\.[^./]*)?$', 1) as stem from documents where path is not null", "")
def k17(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").where("path is not null").select("doc_id", W.output_stem(F.col("path")).alias("stem"))


@query("g08_adjacency")
def g08(spark, sf):
    """Lanelets that share a boundary as neighbours, after the adjacency rules; ids are text."""
    t = map_tables(spark, sf)
    text = lambda c: F.col(c).cast("string").alias(c)
    near = lambda a, b, name: t.bounds.select("map_id", F.col("rel_id").alias(name), F.col(b).alias(a)).where(f"{a} is not null").groupBy("map_id", a).agg(F.max(name).alias(name))
    s = t.shaped.where("size(lp) > 1 and size(rp) > 1").join(near("left", "right", "l"), ["map_id", "left"], "left").join(near("right", "left", "r"), ["map_id", "right"], "left")
    axis = lambda p, c: F.transform(p, lambda q: q[c])
    s = s.select(text("map_id"), text("rel_id"), "ord", F.col("l").cast("string").alias("left"), F.col("l").isNotNull().alias("left_same"), F.col("r").cast("string").alias("right"), F.col("r").isNotNull().alias("right_same"), axis("lp", "x").alias("lx"), axis("lp", "y").alias("ly"), axis("rp", "x").alias("rx"), axis("rp", "y").alias("ry"))
    return L.sanitize_adjacency(s)


@query("f18_heights", """, z as (select map_id, way_id, list(coalesce(ele, 0) order by seq) as z, bool_or(ele is not null) as high from pt group by all)
select b.map_id, b.rel_id, coalesce(round(list_sum(x.z), 4), 0) as left_sum, coalesce(round(list_sum(y.z), 4), 0) as right_sum, coalesce(len(x.z), 0) as left_points, coalesce(len(y.z), 0) as right_points
from bnd b left join z x on x.map_id = b.map_id and x.way_id = b.l left join z y on y.map_id = b.map_id and y.way_id = b.r where coalesce(x.high, false) or coalesce(y.high, false)""")
def f18(spark, sf):
    """the heights that taking lanelets into the plane sets aside, after they were put back once."""
    s = map_tables(spark, sf).shaped.select("map_id", "rel_id", "lp", "rp")
    flat, z = S.strip_z(s)
    _, z = S.strip_z(S.restore_z(flat, z))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 4)
    return z.select("map_id", "rel_id", total("lz").alias("left_sum"), total("rz").alias("right_sum"), F.size("lz").cast("bigint").alias("left_points"), F.size("rz").cast("bigint").alias("right_points"))


@query("s01_written_maps", """ select cast(map_id as varchar) as map_id, cast(way_id as varchar) as way_id, row_number() over (partition by map_id, way_id order by seq) - 1 as nth, cast(node_id as varchar) as node_id, cast(printf('%.4f', node.x) as double) as x, cast(printf('%.4f', node.y) as double) as y, way.type from wn left join node using (map_id, node_id) join way using (map_id, way_id)""")
def s01(spark, sf):
    """All maps written as documents, one each, and read back from these files. A document holds
    the readable refs only, so ``nth`` is the place among those."""
    store = Scratch(spark, "documents")
    W.write_osm(map_tables(spark, sf), store.path("maps"))
    t = osm_tables(read_osm(spark, store.path("maps"))).saved(store, "read")
    rows = t.way_node.join(t.node.select("map_id", "node_id", "x", "y"), ["map_id", "node_id"], "left").join(t.way.select("map_id", "way_id", "type"), ["map_id", "way_id"])
    number = F.regexp_extract("map_id", r"([^/]+)\.osm$", 1).alias("map_id")
    return rows.select(number, "way_id", F.col("seq").cast("bigint").alias("nth"), "node_id", "x", "y", "type")
