"""Functions, link operators, passes and fidelity measures as queries over the given tables, with SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from roadloom.functions import geo as G
from roadloom.functions import planview as V
from roadloom.functions import polyline as P
from roadloom.functions import resample as R
from roadloom.operators import fidelity as D
from roadloom.operators import links as L
from roadloom.operators import map_checks as C
from roadloom.operators import passes as X
from roadloom.operators import plan_checks as K
from roadloom.operators import summaries as S
from roadloom.operators.keys import read_id
from roadloom.storage import Scratch
from roadloom.plans.carriers import current, map_tables
from roadloom.plans.data_queries import READS_ID
from roadloom.plans.map_queries import _PAIRS, _TWIN, BASE, xy

QUERIES: dict = {}
SQL: dict[str, str] = {}
_ROADS = f"""rd as (select map_id, {READS_ID.format("road_id")} as road_id, {READS_ID.format("junction")} as junction, length, name from (select * from road qualify row_number() over (partition by map_id, road_id order by loaded_at desc) = 1) where deleted_at is null),
jn as (select map_id, {READS_ID.format("junction_id")} as junction_id from (select * from junction qualify row_number() over (partition by map_id, junction_id order by loaded_at desc) = 1) where deleted_at is null),
lk as (select link_id, map_id, {READS_ID.format("road_id")} as road_id, direction, nullif(lower(trim(element_type, ' \t\n\r')), '') as element_type, {READS_ID.format("element_id")} as element_id, contact_point from (select * from road_link qualify row_number() over (partition by link_id order by loaded_at desc) = 1)),
cn as (select connection_id as ord, map_id, {READS_ID.format("junction_id")} as junction_id, conn_id, {READS_ID.format("incoming_road")} as incoming_road, {READS_ID.format("connecting_road")} as connecting_road from (select * from junction_connection qualify row_number() over (partition by connection_id order by loaded_at desc) = 1)),
ed0 as (select map_id, incoming_road as src_road, case when ord % 3 = 0 then 1 else -1 end as src_lane, connecting_road as dst_road, case when ord % 5 = 0 then 1 else -1 end as dst_lane, ord from cn where incoming_road is not null and connecting_road is not null),
ed as (select map_id, src_road, src_lane, dst_road, dst_lane, min(ord) as ord from ed0 e where src_road <> dst_road and exists (select 1 from rd r where r.map_id = e.map_id and r.road_id = e.src_road) and exists (select 1 from rd r where r.map_id = e.map_id and r.road_id = e.dst_road) group by all),
ec0 as (select *, count(*) over (partition by map_id, src_road, src_lane) > 1 or count(*) over (partition by map_id, dst_road, dst_lane) > 1 as first_ from ed),
ec as (select *, case when src_lane < 0 then 'end' else 'start' end as side, first_ or (count(distinct case when first_ then -1 else dst_road end) over (partition by map_id, src_road, src_lane < 0)) > 1 as stub from ec0)"""


def query(name: str, sql: str | None = None, base: str = BASE):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = (f"with {base}{sql}" if base else sql)
        return f

    return add


# ---------------------------------------------------------------- carriers


def roads(spark, sf):
    r = current(spark, sf, "road", ["map_id", "road_id"]).where("deleted_at is null")
    return r.select("map_id", read_id(F.col("road_id")).alias("road_id"), read_id(F.col("junction")).alias("junction"), F.when(~F.isnan("length"), F.col("length")).alias("length"), "name")


def junctions(spark, sf):
    return current(spark, sf, "junction", ["map_id", "junction_id"]).where("deleted_at is null").select("map_id", read_id(F.col("junction_id")).alias("junction_id"))


def links(spark, sf):
    from roadloom.operators.keys import read_word

    l = current(spark, sf, "road_link", ["link_id"])  # noqa: E741
    return l.select("link_id", "map_id", read_id(F.col("road_id")).alias("road_id"), "direction", read_word(F.col("element_type")).alias("element_type"), read_id(F.col("element_id")).alias("element_id"), "contact_point")


def connections(spark, sf):
    c = current(spark, sf, "junction_connection", ["connection_id"])
    return c.select(F.col("connection_id").alias("ord"), "map_id", read_id(F.col("junction_id")).alias("junction_id"), "conn_id", read_id(F.col("incoming_road")).alias("incoming_road"), read_id(F.col("connecting_road")).alias("connecting_road"))


def edges(spark, sf):
    c = connections(spark, sf).where("incoming_road is not null and connecting_road is not null")
    sign = lambda k: F.when(F.col("ord") % k == 0, 1).otherwise(-1)
    return c.select("map_id", F.col("incoming_road").alias("src_road"), sign(3).alias("src_lane"), F.col("connecting_road").alias("dst_road"), sign(5).alias("dst_lane"), "ord")


def lanes(spark, sf):
    return roads(spark, sf).select("map_id", "road_id", F.explode(F.array(F.lit(-1), F.lit(1))).alias("lane_id"))


def classified(spark, sf):
    return L.classify_edges(L.valid_edges(edges(spark, sf), lanes(spark, sf)))


def degrees(spark, sf):
    n = current(spark, sf, "osm_node", ["map_id", "node_id"])
    return n.where("lat is not null and lon is not null").select("map_id", "node_id", "lat", "lon")


_DEG = "deg as (select map_id, node_id, lat, lon from (select * from osm_node qualify row_number() over (partition by map_id, node_id order by loaded_at desc) = 1) where lat is not null and lon is not null)"

# ---------------------------------------------------------------- functions


@query("c01_haversine", """ select map_id, node_id, round(2 * 6378000 * asin(sqrt(power(sin(radians(11.01 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(11.01)) * power(sin(radians(23.03 - lon) / 2), 2))), 4) as d from deg""", _DEG)
def c01(spark, sf):
    return degrees(spark, sf).select("map_id", "node_id", F.round(G.haversine(F.col("lat"), F.col("lon"), F.lit(11.01), F.lit(23.03)), 4).alias("d"))


@query("c02_equirectangular", " select map_id, node_id, round(radians(lon) * 6378000 * cos(radians(lat)), 4) as x, round(radians(lat) * 6378000, 4) as y from deg", _DEG)
def c02(spark, sf):
    x, y = G.equirectangular(F.col("lat"), F.col("lon"))
    return degrees(spark, sf).select("map_id", "node_id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("c04_web_mercator", " select map_id, node_id, round(6378137 * radians(lon), 3) as x, round(6378137 * ln(tan(pi() / 4 + radians(lat) / 2)), 3) as y from deg", _DEG)
def c04(spark, sf):
    x, y = G.web_mercator(F.col("lat"), F.col("lon"))
    return degrees(spark, sf).select("map_id", "node_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("c05_tmerc_there_and_back", " select map_id, node_id, round(lat, 8) as lat, round(lon, 8) as lon from deg", _DEG)
def c05(spark, sf):
    t = G.Tmerc.utm(34)
    n = degrees(spark, sf)
    x, y = t.forward(F.col("lat"), F.col("lon"))
    n = n.withColumns({"x": x, "y": y})
    lat, lon = t.inverse(F.col("x"), F.col("y"))
    return n.select("map_id", "node_id", F.round(lat, 8).alias("lat"), F.round(lon, 8).alias("lon"))


@query("c06_utm_zone", " select map_id, node_id, cast(floor((lon + 180) / 6) + 1 as int) as zone, cast((floor((lon + 180) / 6) + 1) * 6 - 183 as int) as meridian from deg", _DEG)
def c06(spark, sf):
    zone = G.utm_zone(F.col("lon"))
    return degrees(spark, sf).select("map_id", "node_id", zone.alias("zone"), G.central_meridian(zone).alias("meridian"))


@query("c14_lane_id_parts", """select link_id, case when link_id % 3 > 0 then cast(map_id as varchar) end as road, case when link_id % 3 > 0 then cast(link_id as varchar) end as section, case when link_id % 3 > 0 then '-1' end as lane from road_link qualify row_number() over (partition by link_id order by loaded_at desc) = 1""", "")
def c14(spark, sf):
    text = F.concat_ws(".", "map_id", "link_id", F.when(F.col("link_id") % 3 > 0, "-1.2"))
    p = current(spark, sf, "road_link", ["link_id"]).select("link_id", G.lane_id_parts(text).alias("p"))
    return p.select("link_id", F.col("p")[0].alias("road"), F.col("p")[1].alias("section"), F.col("p")[2].alias("lane"))


@query("c16_wrap_angle", "select event_id, round((value + pi()) - 2 * pi() * floor((value + pi()) / (2 * pi())) - pi(), 6) as a from events", "")
def c16(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.round(G.wrap_angle(F.col("value")), 6).alias("a"))


_CUBIC = "poly as (select vec_id, i, cast(embedding[i * 4 + 1] as double) as a, cast(embedding[i * 4 + 2] as double) as b, cast(embedding[i * 4 + 3] as double) as c, cast(embedding[i * 4 + 4] as double) as d from embeddings, (select unnest(range(16)) as i))"


def cubics(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("i"), "embedding")
    at = lambda k: F.get("embedding", F.col("i") * 4 + k).cast("double")
    return e.select("vec_id", F.col("i").cast("bigint").alias("i"), *[at(k).alias(c) for k, c in enumerate("abcd")])


@query("plan_p01_primitive_ends", """ select vec_id, i, round(case i % 3 when 0 then x + len * cos(h) when 1 then x + (sin(h + k * len) - sin(h)) / k else x + u * cos(h) - v * sin(h) end, 5) as x,
  round(case i % 3 when 0 then y + len * sin(h) when 1 then y + (cos(h) - cos(h + k * len)) / k else y + u * sin(h) + v * cos(h) end, 5) as y
from (select *, a + b + c + d as u, d + c + b + a as v, a as x, b as y, c as h, 5 + d as len, 0.01 + b * b as k from poly)""", _CUBIC)
def p01(spark, sf):
    g = cubics(spark, sf)
    kind = F.element_at(F.array(F.lit("line"), F.lit("arc"), F.lit("paramPoly3")), (F.col("i") % 3 + 1).cast("int"))
    g = g.select("vec_id", "i", F.lit(0.0).alias("s"), F.col("a").alias("x"), F.col("b").alias("y"), F.col("c").alias("hdg"), (5 + F.col("d")).alias("length"), kind.alias("kind"), (0.01 + F.col("b") * F.col("b")).alias("curvature"), F.lit("normalized").alias("p_range"), *[F.col(c).alias(n) for c, n in zip("abcddcba", ("au", "bu", "cu", "du", "av", "bv", "cv", "dv"))])
    return g.withColumn("e", V.end_point(spirals=False)).select("vec_id", "i", F.round("e.x", 5).alias("x"), F.round("e.y", 5).alias("y"))


@query("plan_p03_cubic_values", " select vec_id, i, round(a + b * 0.5 + c * 0.25 + d * 0.125, 6) as v, round(b + c + 0.75 * d, 6) as s from poly", _CUBIC)
def p03(spark, sf):
    p = tuple(F.col(c) for c in "abcd")
    return cubics(spark, sf).select("vec_id", "i", F.round(V.value(p, F.lit(0.5)), 6).alias("v"), F.round(V.slope(p, F.lit(0.5)), 6).alias("s"))


@query("geo_p15_lanelet_area", """, ring as (select b.map_id, b.rel_id, p.x, p.y, p.k as k from bnd b join pt p on p.map_id = b.map_id and p.way_id = b.l union all select b.map_id, b.rel_id, p.x, p.y, 1000000 - p.k from bnd b join pt p on p.map_id = b.map_id and p.way_id = b.r),
r2 as (select *, coalesce(lead(x) over w, first_value(x) over w) as nx, coalesce(lead(y) over w, first_value(y) over w) as ny, count(*) over (partition by map_id, rel_id) as n from ring window w as (partition by map_id, rel_id order by k))
select map_id, rel_id, round(case when any_value(n) >= 3 then abs(sum(x * ny - nx * y)) / 2 else 0 end + 1e-7, 4) as area from r2 group by all""")
def p15(spark, sf):
    s = map_tables(spark, sf).shaped
    return s.where("size(lp) + size(rp) > 0").select("map_id", "rel_id", F.round(P.shoelace(D.lanelet_ring(F.col("lp"), F.col("rp"))) + 1e-7, 4).alias("area"))


@query("w06_step_points", " select map_id, way_id, case when len > 0 then cast(greatest(1, round_even(len, 0)) + 1 as bigint) else cast(2 as bigint) end as points from len")
def w06(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.size(R.sample_step(xy("pts"), 1.0)).cast("bigint").alias("points"))


@query("w18_shared_samples", " select b.map_id, b.rel_id, cast(greatest(3, ceil(greatest(x.len, y.len)) + 1) as bigint) as points from bnd b join len x on x.map_id = b.map_id and x.way_id = b.l join len y on y.map_id = b.map_id and y.way_id = b.r")
def w18(spark, sf):
    s = map_tables(spark, sf).shaped.where("size(lp) > 0 and size(rp) > 0")
    a, b = R.sample_shared(xy("lp"), xy("rp"), 1.0)
    return s.select("map_id", "rel_id", F.size(a).cast("bigint").alias("points"))


#: Points about a metre apart, headings, and the greatest turn within 20 m.
_TURN = """rs as (select map_id, way_id, len, cast(greatest(1, round_even(len, 0)) as bigint) as m from len where n >= 3 and len > 0),
rp0 as (
  select r.map_id, r.way_id, i, any_value(r.m) as m, arg_min(struct_pack(x := c.x, y := c.y, nx := c.nx, ny := c.ny, l := c.l, d := d.l - c.l, t := r.len * i / r.m), c.k) as s
  from (select *, unnest(range(m + 1)) as i from rs) r join cum c on c.map_id = r.map_id and c.way_id = r.way_id join cum d on d.map_id = c.map_id and d.way_id = c.way_id and d.k = c.k + 1
  where d.l >= r.len * i / r.m or c.k = c.n - 1 group by r.map_id, r.way_id, i),
rp as (select map_id, way_id, i, s.x + least(case when s.d > 0 then (s.t - s.l) / s.d else 0 end, 1) * (s.nx - s.x) as x, s.y + least(case when s.d > 0 then (s.t - s.l) / s.d else 0 end, 1) * (s.ny - s.y) as y from rp0),
sg as (select map_id, way_id, i, lead(x) over w - x as dx, lead(y) over w - y as dy from rp window w as (partition by map_id, way_id order by i)),
hd0 as (select *, sqrt(dx * dx + dy * dy) as d, case when dx <> 0 or dy <> 0 then atan2(dy, dx) end as h from sg where dx is not null),
hd as (select *, coalesce(last_value(h ignore nulls) over (partition by map_id, way_id order by i rows between unbounded preceding and current row), 0) as hh from hd0),
tn0 as (select *, hh - lag(hh) over (partition by map_id, way_id order by i) as q from hd),
tn as (select map_id, way_id, i, sum(d) over w as r1, sum(d) over w - d as r0, sum(coalesce(abs(degrees((q + pi()) - 2 * pi() * floor((q + pi()) / (2 * pi())) - pi())), 0)) over w as t from tn0 window w as (partition by map_id, way_id order by i)),
turn as (select a.map_id, a.way_id, max(a.t - b.t) as turn from tn a join tn b on b.map_id = a.map_id and b.way_id = a.way_id and b.i <= a.i and b.i >= a.i - 80 and (b.r0 >= a.r1 - 20 - 1e-9 or b.i = a.i) group by all)"""


@query("w05_window_turn", ", " + _TURN + " select map_id, way_id, round(coalesce(turn, 0.0) + 1e-7, 4) as turn from len left join turn using (map_id, way_id)")
def w05(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.round(R.max_turn(xy("pts")) + 1e-7, 4).alias("turn"))


@query("w12_cut_fractions")
def w12(spark, sf):
    """Where each component of ways is cut."""
    return X.cut_groups(map_tables(spark, sf)).select("map_id", "way_id", F.size("fractions").alias("cuts"), F.transform("fractions", lambda f: F.round(f, 6)).alias("fractions"))


@query("w16_split_pieces")
def w16(spark, sf):
    """The map after splitting, as one row per lanelet of it."""
    t, _ = X.split_lanelets(map_tables(spark, sf).saved(Scratch(spark, "carrier"), "map"))
    return t.lanelets.join(t.bounds, ["map_id", "rel_id"]).select("map_id", "rel_id", "subtype", "left", "right")


@query("f15_downsample")
def f15(spark, sf):
    """The nodes of simplified ways, renumbered."""
    t = map_tables(spark, sf)
    t.node = t.node.join(degrees(spark, sf), ["map_id", "node_id"], "left")
    return X.downsample(t)[1]


@query("f12_border_rules", ", " + _TWIN.replace("0.5)", "0.5)") + """ select map_id, way_id, case when type in ('road_border', 'curbstone', 'guard_rail', 'wall', 'fence') then 'physical' when type is not null and type not in ('line_thin', 'line_thick') then 'typed'
  when not drivable then 'not_drivable' when uses >= 2 and all_road then 'divider' when t.way_id is not null then 'coincident' else 'border' end as rule from own join way using (map_id, way_id) left join twin t using (map_id, way_id)""")
def f12(spark, sf):
    return X.border_rule(map_tables(spark, sf)).select("map_id", "way_id", "rule")


@query("f14_decoupled", """ select map_id, count(*) as boundaries_decoupled from (select s.map_id, s.way_id from side s join ll using (map_id, rel_id) join way using (map_id, way_id) group by all having bool_or(coalesce(ll.subtype in ('walkway', 'crosswalk'), false)) and bool_or(not coalesce(ll.subtype in ('walkway', 'crosswalk'), false))) group by map_id""")
def f14(spark, sf):
    return X.decouple(map_tables(spark, sf))[1]


@query("a31_duplicate_lanelets", """, m as (select map_id, rel_id, list_sort(list(coalesce(mtype, '') || '|' || coalesce(role, '') || '|' || coalesce(cast(ref as varchar), ''))) as members, bool_or(coalesce(mtype = 'way', false)) as real_ from mem group by all),
g as (select m.map_id, members, ll.subtype, ll.location, ll.one_way, min(rel_id) as keep, count(*) as n from m join ll using (map_id, rel_id) where real_ group by all)
select map_id, cast(sum(n - 1) as bigint) as lanelets_removed, count(*) as duplicate_groups from g where n > 1 group by map_id""")
def a31(spark, sf):
    t = map_tables(spark, sf)
    tags = t.lanelets.select("map_id", "rel_id", F.create_map(F.lit("subtype"), "subtype", F.lit("location"), "location", F.lit("one_way"), "one_way").alias("tags"))
    return X.dedup_lanelets(t, tags)[1]


# ---------------------------------------------------------------- links


@query("j06_road_link_targets", """ select link_id, map_id, not exists (select 1 from (select map_id, 'road' as t, road_id as i from rd union all select map_id, 'junction', junction_id from jn) k where k.map_id = lk.map_id and k.t = lk.element_type and k.i = lk.element_id) as bad from lk""", _ROADS)
def j06(spark, sf):
    return K.road_link_faults(links(spark, sf), roads(spark, sf), junctions(spark, sf)).select("link_id", "map_id", "bad")


@query("j18_connection_faults", """ select c.ord, c.map_id, case when i.road_id is null or r.road_id is null then 'road missing' when r.junction is distinct from c.junction_id then 'wrong junction' end as fault
from cn c left join rd i on i.map_id = c.map_id and i.road_id = c.incoming_road left join rd r on r.map_id = c.map_id and r.road_id = c.connecting_road""", _ROADS)
def j18(spark, sf):
    return K.connection_roads(connections(spark, sf), roads(spark, sf)).select("ord", "map_id", "fault")


@query("j19_unreferenced_roads", """ select map_id, road_id, not exists (select 1 from cn c where c.map_id = rd.map_id and c.junction_id = rd.junction and c.connecting_road = rd.road_id) as bad from rd where junction is not null""", _ROADS)
def j19(spark, sf):
    text = lambda df, *cs: df.withColumns({c: F.col(c).cast("string") for c in cs})
    r = K.unreferenced_roads(text(roads(spark, sf), "junction", "road_id"), text(connections(spark, sf), "junction_id", "connecting_road"))
    return r.select("map_id", F.col("road_id").cast("bigint").alias("road_id"), "bad")


@query("j27_repeated_edges", "select map_id, road_id, element_id, count(*) as times from lk group by all having count(*) > 1", "")
def j27(spark, sf):
    return D.repeated_edges(links(spark, sf).select("map_id", "road_id", "element_id"))


SQL["j27_repeated_edges"] = f"with {_ROADS} {SQL['j27_repeated_edges']}"


@query("a32_repeated_road_names", " select map_id, name, count(*) as n from rd group by all having count(*) > 1", _ROADS)
def a32(spark, sf):
    return S.repeated(roads(spark, sf), "name")


_CC = """, e as (select map_id, 'w' || way_id as a, 'r' || rel_id as b from side), bi as (select map_id, a, b from e union select map_id, b, a from e),
reach as (select map_id, a as n, a as r from bi union select b.map_id, b.b, q.r from reach q join bi b on b.map_id = q.map_id and b.a = q.n),
comp as (select map_id, n, min(r) as c from reach group by all)"""


@query("g01_cuttable_ways", """, bx as (select l.map_id, l.rel_id, b.l, b.r, b.l is null or b.r is null or coalesce(subtype in ('walkway', 'crosswalk'), false) or turn_direction is not null as ex from ll l left join bnd b using (map_id, rel_id)),
use as (select map_id, rel_id, ex, unnest([l, r]) as way_id from bx), u as (select * from use join comp c on c.map_id = use.map_id and c.n = 'w' || way_id),
bl as (select map_id, c, bool_or(ex) as blocked from u group by all)
select u.map_id, way_id, not any_value(blocked) as cuttable, bool_or(not ex) as graded from u join bl on bl.map_id = u.map_id and bl.c = u.c group by u.map_id, way_id""")
def g01(spark, sf):
    return C.cuttable_ways(map_tables(spark, sf)).select("map_id", "way_id", "cuttable", "graded")


SQL["g01_cuttable_ways"] = SQL["g01_cuttable_ways"].replace("with ", "with recursive ", 1).replace(", bx as", _CC + ", bx as", 1)


@query("g03_merged_junctions", """, je as (select distinct a.map_id, a.junction_id as a, b.junction_id as b from cn a join cn b on a.map_id = b.map_id and a.connecting_road = b.connecting_road where a.junction_id is not null and b.junction_id is not null),
reach as (select map_id, a as n, a as r from je union select e.map_id, e.b, q.r from reach q join je e on e.map_id = q.map_id and e.a = q.n)
select map_id, n as junction_id, min(r) as keep from reach group by all having min(r) <> n""", "recursive " + _ROADS)
def g03(spark, sf):
    text = lambda df, *cs: df.withColumns({c: F.col(c).cast("string") for c in cs})
    c = text(connections(spark, sf).where("junction_id is not null"), "junction_id", "incoming_road", "connecting_road")
    j = c.groupBy("map_id", "junction_id").agg(F.min("ord").alias("ord"))
    r = text(roads(spark, sf), "road_id", "junction").withColumn("ord", F.col("road_id"))
    out, _ = L.merge_junctions(j, c, r, text(links(spark, sf), "road_id", "element_id"))
    was = c.select("map_id", "connecting_road", F.col("junction_id").alias("old")).distinct()
    now = out["connection"].select("map_id", "connecting_road", F.col("junction_id").alias("keep")).distinct()
    both = was.join(now, ["map_id", "connecting_road"]).where("old <> keep").select("map_id", F.col("old").cast("bigint").alias("junction_id"), F.col("keep").cast("bigint").alias("keep"))
    return both.distinct()


@query("g04_edge_classes", " select map_id, src_road, src_lane, dst_road, dst_lane, ord, side, stub from ec", _ROADS)
def g04(spark, sf):
    return classified(spark, sf)


@query("g05_plain_links", """, pl as (select *, case when dst_lane < 0 then 'start' else 'end' end as entry from ec where not stub),
slots as (select distinct map_id, src_road as road_id, side from ec),
en as (select p.map_id, p.dst_road as road_id, p.entry as side, p.src_road as element_id, p.side as contact_point, s.road_id is null and row_number() over (partition by p.map_id, p.dst_road, p.entry order by ord) = 1 as ok from pl p left join slots s on s.map_id = p.map_id and s.road_id = p.dst_road and s.side = p.entry)
select map_id, road_id, side, element_id, contact_point, case when ok then 'entry' else 'omitted' end as kind from en
union all select map_id, src_road, side, arg_max(dst_road, ord), arg_max(entry, ord), 'exit' from pl group by map_id, src_road, side""", _ROADS)
def g05(spark, sf):
    return L.plain_links(classified(spark, sf))


@query("f25_lane_links", """, pl as (select * from ec where not stub),
a as (select map_id, src_road as road_id, src_lane as lane_id, case when src_lane < 0 then 'successor' else 'predecessor' end as direction, dst_lane as target, ord * 2 as o from pl
  union all select map_id, dst_road, dst_lane, case when dst_lane < 0 then 'predecessor' else 'successor' end, src_lane, ord * 2 + 1 from pl)
select map_id, road_id, lane_id, direction, arg_max(target, o) as target from a group by all""", _ROADS)
def f25(spark, sf):
    return L.lane_links(classified(spark, sf))


@query("g11_rebuild")
def g11(spark, sf):
    """Junctions rebuilt on roads drawn as straight lines, as counts per map."""
    r = roads(spark, sf).where("length > 0")
    e = L.valid_edges(edges(spark, sf), lanes(spark, sf))
    text = lambda df, *cs: df.withColumns({c: F.col(c).cast("string") for c in cs})
    r = text(r, "map_id", "road_id")
    none = [F.lit(None).cast("double").alias(c) for c in ("curvature", "curv_start", "curv_end", "au", "bu", "cu", "du", "av", "bv", "cv", "dv")]
    g = r.select("map_id", "road_id", F.lit(0).alias("ord"), F.lit(0.0).alias("s"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("hdg"), "length", F.lit("line").alias("kind"), F.lit(None).cast("string").alias("p_range"), *none)
    w = r.select("map_id", "road_id", F.explode(F.array(F.lit(-1), F.lit(1))).alias("lane_id"), F.lit(0.0).alias("s_offset"), F.lit(3.5).alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("c"), F.lit(0.0).alias("d"))
    _, stats = L.rebuild(text(e, "map_id", "src_road", "dst_road"), r, w.select("map_id", "road_id", "lane_id"), g, w)
    return stats


@query("g10_dead_end_ahead", """, st as (select distinct map_id, src_road as src, dst_road as dst from ed), pts as (select distinct map_id, src as n from st union select map_id, dst from st),
ends as (select map_id, n from pts p where not exists (select 1 from st s where s.map_id = p.map_id and s.src = p.n)),
reach as (select map_id, n, 0 as hop from ends union select s.map_id, s.src, r.hop + 1 from reach r join st s on s.map_id = r.map_id and s.dst = r.n where hop < 39)
select map_id, n as wp_id, exists (select 1 from reach r where r.map_id = p.map_id and r.n = p.n) as dead_end from pts p""", "recursive " + _ROADS)
def g10(spark, sf):
    e = L.valid_edges(edges(spark, sf), lanes(spark, sf)).select("map_id", F.col("src_road").alias("src"), F.col("dst_road").alias("dst")).distinct()
    starts = e.select("map_id", F.col("src").alias("wp_id")).union(e.select("map_id", "dst"))
    return D.dead_end_ahead(starts, e)


@query("j22_lane_graph", """ select c.map_id, c.incoming_road as src_road, -1 as src_lane, c.connecting_road as dst_road, -1 as dst_lane, c.ord from cn c where exists (select 1 from rd r where r.map_id = c.map_id and r.road_id = c.incoming_road) and exists (select 1 from rd r where r.map_id = c.map_id and r.road_id = c.connecting_road)""", _ROADS)
def j22(spark, sf):
    r = roads(spark, sf).select("map_id", F.col("road_id").alias("cr_id"), F.col("road_id").alias("road"))
    s = connections(spark, sf).select("map_id", F.col("incoming_road").alias("cr_id"), F.col("connecting_road").alias("successor"), "ord")
    g = L.lane_graph(s, r, r.select("map_id", "cr_id", F.lit(-1).alias("lane")))
    return g.withColumns({c: F.col(c).cast("bigint") for c in ("src_road", "dst_road")})


@query("j20_id_mapping", """, st as (select map_id, road_id as road, 900000 + row_number() over (partition by map_id order by road_id) as stub_id from rd where road_id % 7 = 0)
select r.map_id, cast(r.rel_id as varchar) as lanelet2_relation_id, cast(r.rel_id as varchar) as commonroad_id, coalesce(cast(d.road_id as varchar), '') as opendrive_road_id, '' as opendrive_lane_id from (select map_id, rel_id from rel0 where deleted_at is null and rel_type = 'lanelet') r left join rd d on d.map_id = r.map_id and d.road_id = r.rel_id - 1000
union all select r.map_id, cast(r.rel_id as varchar), cast(r.rel_id as varchar), cast(s.stub_id as varchar), '-1' from (select map_id, rel_id from rel0 where deleted_at is null and rel_type = 'lanelet') r join st s on s.map_id = r.map_id and s.road = r.rel_id - 1000""", _ROADS + ", rel0 as (select * from osm_relation qualify row_number() over (partition by map_id, rel_id order by loaded_at desc) = 1)")
def j20(spark, sf):
    ids = map_tables(spark, sf).lanelets.select("map_id", F.col("rel_id").alias("osm_id"), F.col("rel_id").alias("cr_id"))
    r = roads(spark, sf)
    at = r.select("map_id", (F.col("road_id") + 1000).alias("cr_id"), F.col("road_id").alias("road"))
    stubs = r.where("road_id % 7 = 0").select("map_id", F.col("road_id").alias("road"), F.lit(0).alias("lane"), (900000 + F.row_number().over(Window.partitionBy("map_id").orderBy("road_id"))).alias("stub_id"))
    none = at.where("false").select("map_id", "cr_id", F.lit(0).alias("lane"))
    return L.id_mapping(ids, at, none, stubs)


# ---------------------------------------------------------------- fidelity and traces


@query("j25_nearest_segment", """, q as (select map_id, node_id, x, y from node where node_id % 20 = 0 and (x <> 0 or y <> 0)), s as (select map_id, x as ax, y as ay, nx as bx, ny as by_ from seg where nx is not null),
d as (select q.map_id, q.node_id, ax, ay, bx, by_, x, y, case when power(bx - ax, 2) + power(by_ - ay, 2) = 0 then 0 else greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) end as t from q join s using (map_id))
select map_id, node_id as point_id, round(min(sqrt(power(x - ax - t * (bx - ax), 2) + power(y - ay - t * (by_ - ay), 2))), 4) as dist from d group by all""")
def j25(spark, sf):
    """Nearest segments of every twentieth node id: the stated query set of this search."""
    t = map_tables(spark, sf)
    pts = t.node.where("node_id % 20 = 0 and (x <> 0 or y <> 0)").select("map_id", F.col("node_id").alias("point_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    pair = F.explode(F.arrays_zip(F.slice("pts", F.lit(1), F.size("pts") - 1).alias("a"), F.slice("pts", F.lit(2), F.size("pts") - 1).alias("b")))
    seg = t.polylines.where("size(pts) > 1").select("map_id", pair.alias("s")).select("map_id", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"))
    return D.nearest_segment(pts, seg, 10.0).select("map_id", "point_id", F.round("dist", 4).alias("dist"))


@query("j24_self_overlap")
def j24(spark, sf):
    """The best overlap of every road lanelet with the walkways of its map, by clipped areas."""
    s = map_tables(spark, sf).shaped.where("size(lp) > 1 and size(rp) > 1")
    return D.best_overlaps(s.where("subtype = 'road'"), s.where("subtype <> 'road'")).select("map_id", "rel_id", F.round("iou", 6).alias("iou"))


@query("a45_length_percentiles", " select map_id, round(quantile_cont(len, 0.1), 4) as p10, round(quantile_cont(len, 0.5), 4) as p50, round(quantile_cont(len, 0.9), 4) as p90, round(min(len), 4) as least, round(max(len), 4) as most from len group by all")
def a45(spark, sf):
    p = map_tables(spark, sf).polylines.select("map_id", P.length(F.col("pts")).alias("len"))
    return D.percentiles(p, "len").select("map_id", *[F.round(c, 4).alias(c) for c in ("p10", "p50", "p90", "least", "most")])


@query("t03_longest_ways", " select map_id, way_id, n from (select map_id, way_id, n as pts, row_number() over (partition by map_id order by n desc, way_id) as n from (select map_id, way_id, count(*) as n from wn group by all)) where n <= 10")
def t03(spark, sf):
    c = map_tables(spark, sf).way_node.groupBy("map_id", "way_id").agg(F.count("*").alias("c"))
    return D.worst_matches(c.select("map_id", F.col("way_id").alias("rel_id"), (-F.col("c")).alias("iou"))).select("map_id", F.col("rel_id").alias("way_id"), F.col("nth").cast("bigint").alias("n"))


@query("a50_trips", """with t as (select user_id as vehicle, epoch_us(ts) / 1e6 as ts, round(value * 100) as x, cast(event_id % 100 as double) as y, event_type <> 'error' as alive from events),
g as (select *, min(case when not alive then ts end) over (partition by vehicle) as gone from t),
d as (select *, sqrt(power(x - lag(x) over w, 2) + power(y - lag(y) over w, 2)) as d from g where gone is null or ts < gone window w as (partition by vehicle order by ts))
select a.vehicle, coalesce(b.samples, 0) as samples, round(coalesce(b.dist, 0), 3) as distance from (select distinct vehicle from t) a left join (select vehicle, count(*) as samples, sum(d) as dist from d group by all) b using (vehicle)""", "")
def a50(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    t = e.select(F.col("user_id").alias("vehicle"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"), F.round(F.col("value") * 100).alias("x"), (F.col("event_id") % 100).cast("double").alias("y"), (F.col("event_type") != "error").alias("alive"))
    return D.trips(t).select("vehicle", "samples", F.round("distance", 3).alias("distance"))


@query("a47_dead_end_lanes", """, w as (select map_id, way_id as road_id, case when way_id % 2 = 0 then -1 else 1 end as lane_id, seq as s, map_id || '/' || way_id || '/' || seq as wp_id from wn),
l as (select map_id, road_id, lane_id, arg_max(wp_id, case when lane_id < 0 then s else -s end) as wp_id from w group by all)
select map_id, road_id, lane_id from l where cast(string_split(wp_id, '/')[3] as bigint) % 3 <> 0""")
def a47(spark, sf):
    w = map_tables(spark, sf).way_node
    wp = w.select("map_id", F.col("way_id").alias("road_id"), F.when(F.col("way_id") % 2 == 0, -1).otherwise(1).alias("lane_id"), F.col("seq").alias("s"), F.concat_ws("/", "map_id", "way_id", "seq").alias("wp_id"))
    return D.dead_end_lanes(wp, wp.where("s % 3 = 0").select("map_id", F.col("wp_id").alias("src")))


@query("s15_node_samples", """, o as (select map_id, node_id, row_number() over (partition by map_id order by node_id) - 1 as rn, count(*) over (partition by map_id) as c, lat, lon from (select * from osm_node qualify row_number() over (partition by map_id, node_id order by loaded_at desc) = 1))
select map_id, node_id from o where rn % greatest(1, c // 2000) = 0 and lat is not null and lon is not null""", _DEG)
def s15(spark, sf):
    from roadloom.sources.osm_xml import node_samples

    n = current(spark, sf, "osm_node", ["map_id", "node_id"]).select("map_id", "node_id", F.col("node_id").alias("ord"), "lat", "lon", F.create_map(F.lit("local_x"), F.lit("0"), F.lit("local_y"), F.lit("0")).alias("tags"))
    return node_samples(n).select("map_id", "node_id")


SQL["check_vm_01_24"] = f"""with recursive {BASE}{_CC}, {_TURN},
bx as (select l.map_id, l.rel_id, b.l, b.r, b.l is null or b.r is null or coalesce(subtype in ('walkway', 'crosswalk'), false) or turn_direction is not null as ex from ll l left join bnd b using (map_id, rel_id)),
u as (select x.map_id, way_id, ex, c from (select map_id, rel_id, ex, unnest([l, r]) as way_id from bx) x join comp k on k.map_id = x.map_id and k.n = 'w' || way_id),
wy as (select u.map_id, way_id, not any_value(blocked) as cuttable, bool_or(not ex) as graded from u join (select map_id, c, bool_or(ex) as blocked from u group by all) b on b.map_id = u.map_id and b.c = u.c group by u.map_id, way_id),
found as (select map_id, count(*) as total, count(*) filter (cuttable and (len > 100 or len > 20 and coalesce(turn, 0) > 4)) as bad from wy join len using (map_id, way_id) left join turn using (map_id, way_id) where graded and len.n >= 2 group by map_id)
select m.map_id, 'vm-01-24' as req_id, case when coalesce(total, 0) = 0 then 'SKIP' when bad = 0 then 'PASS' else 'FAIL' end as status, cast(coalesce(bad, 0) as bigint) as offenders, cast(coalesce(total, 0) as bigint) as total from maps m left join found using (map_id)"""

SQL["g11_rebuild"] = f"""with recursive {_ROADS},
e1 as (select * from ed e where exists (select 1 from rd r where r.map_id = e.map_id and r.road_id = e.src_road and length > 0 and not isnan(length)) and exists (select 1 from rd r where r.map_id = e.map_id and r.road_id = e.dst_road and length > 0 and not isnan(length))),
k0 as (select *, count(*) over (partition by map_id, src_road, src_lane) > 1 or count(*) over (partition by map_id, dst_road, dst_lane) > 1 as first_ from e1),
k as (select *, case when src_lane < 0 then 'end' else 'start' end as side, case when dst_lane < 0 then 'start' else 'end' end as entry, first_ or count(distinct case when first_ then -1 else dst_road end) over (partition by map_id, src_road, src_lane < 0) > 1 as stub from k0),
slots as (select distinct map_id, src_road as road_id, side from k),
om as (select p.map_id, s.road_id is null and row_number() over (partition by p.map_id, p.dst_road, p.entry order by ord) = 1 as ok from k p left join slots s on s.map_id = p.map_id and s.road_id = p.dst_road and s.side = p.entry where not stub),
je as (select map_id, src_road || '/' || side as a, dst_road || '/' || entry as b from k where stub), bi as (select map_id, a, b from je union select map_id, b, a from je),
reach as (select map_id, a as n, a as r from bi union select b.map_id, b.b, q.r from reach q join bi b on b.map_id = q.map_id and b.a = q.n),
cl as (select map_id, count(distinct r) as junctions from (select map_id, n, min(r) as r from reach group by all) group by all)
select cast(k.map_id as varchar) as map_id, count(*) as edges, count(*) filter (not stub) as plain_links, coalesce((select count(*) from om where om.map_id = k.map_id and not ok), 0) as entry_links_omitted, count(*) filter (stub) as stubs, coalesce((select junctions from cl where cl.map_id = k.map_id), 0) as junctions
from k group by k.map_id"""
