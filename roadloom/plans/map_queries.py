"""The map checks and the relational and polyline operators behind them as queries over the given tables, with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import polyline as P
from roadloom.functions import resample as R
from roadloom.operators import map_checks as C
from roadloom.operators import maptables as T
from roadloom.plans.carriers import map_tables
from roadloom.plans.data_queries import READS_ID

NUMBER = r"'\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*'"
_DEC = "case when regexp_full_match({0}, " + NUMBER + ") then try_cast(trim({0}) as double) end"
_WORD = "nullif(lower(trim({0}, ' \t\n\r')), '')"
#: The carrier tables in SQL; every oracle below starts with them.
BASE = f"""node0 as (select * from osm_node qualify row_number() over (partition by map_id, node_id order by loaded_at desc) = 1),
node1 as (select map_id, node_id, case when local_x is not null then {_DEC.format("local_x")} else lon end as x, case when local_y is not null then {_DEC.format("local_y")} else lat end as y, {_DEC.format("ele")} as ele from node0),
node as (select map_id, node_id, case when x is null or y is null then 0.0 else x end as x, case when x is null or y is null then 0.0 else y end as y, ele from node1),
way0 as (select * from osm_way qualify row_number() over (partition by map_id, way_id order by loaded_at desc) = 1),
way as (select map_id, way_id, way_type as type, subtype, lane_change, nd from way0 where deleted_at is null),
ref0 as (select map_id, way_id, unnest(range(len(nd))) as seq, unnest(nd).ref as ref from way),
wn as (select map_id, way_id, seq, {READS_ID.format("ref")} as node_id from ref0 where {READS_ID.format("ref")} is not null),
pt as (select map_id, way_id, seq, node_id, x, y, ele, row_number() over (partition by map_id, way_id order by seq) as k, count(*) over (partition by map_id, way_id) as n from wn join node using (map_id, node_id)),
rel0 as (select * from osm_relation qualify row_number() over (partition by map_id, rel_id order by loaded_at desc) = 1),
rel as (select * from rel0 where deleted_at is null),
ll as (select * from rel where rel_type = 'lanelet'),
reg as (select * from rel where rel_type = 'regulatory_element'),
mem0 as (select * from osm_member qualify row_number() over (partition by member_id order by loaded_at desc) = 1),
mem as (select map_id, rel_id, seq, member_id, {_WORD.format("mtype")} as mtype, {READS_ID.format("ref")} as ref, {_WORD.format("role")} as role from mem0 where {READS_ID.format("ref")} is not null),
side as (select m.map_id, m.rel_id, m.role, arg_max(m.ref, seq * 1000000000 + member_id) as way_id from mem m join ll using (map_id, rel_id) where mtype = 'way' and role in ('left', 'right') group by all),
seg as (select map_id, way_id, k, n, x, y, lead(x) over w as nx, lead(y) over w as ny, lag(x) over w as px, lag(y) over w as py from pt window w as (partition by map_id, way_id order by k)),
cum as (select *, coalesce(sum(sqrt(power(x - px, 2) + power(y - py, 2))) over (partition by map_id, way_id order by k), 0) as l from seg),
len as (select map_id, way_id, max(n) as n, max(l) as len from cum group by all),
maps as (select map_id from node union select map_id from way union select map_id from rel),
own as (select map_id, way_id, count(*) as uses, bool_and(coalesce(subtype, '') = 'road') as all_road, bool_or(coalesce(subtype in ('road', 'road_shoulder'), false)) as drivable from side join ll using (map_id, rel_id) group by all),
lines as (select distinct s.map_id, s.way_id from side s join len using (map_id, way_id) where len.n >= 2 and len.len >= 1),
ends as (select map_id, way_id, count(*) as refs, arg_min(node_id, seq) as head, arg_max(node_id, seq) as tail from wn group by all),
bnd as (select map_id, rel_id, max(case when role = 'left' then way_id end) as l, max(case when role = 'right' then way_id end) as r from side group by all)"""

_PAIRS = """key as (select map_id, way_id, n, least(a, b) as k1, greatest(a, b) as k2 from (
  select map_id, way_id, any_value(n) as n, max(case when k = 1 then printf('%d|%d', cast(round_even(x, 0) as bigint), cast(round_even(y, 0) as bigint)) end) as a,
    max(case when k = n then printf('%d|%d', cast(round_even(x, 0) as bigint), cast(round_even(y, 0) as bigint)) end) as b from pt group by all)),
cand as (select a.map_id, a.way_id as a, b.way_id as b, a.n from key a join key b on a.map_id = b.map_id and a.k1 = b.k1 and a.k2 = b.k2 and a.n = b.n and a.n >= 2 and a.way_id <> b.way_id),
pair as (
  select c.map_id, c.a, c.b, max(case when q.k = p.k then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end) as fwd, max(case when q.k = p.n + 1 - p.k then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end) as rev
  from cand c join pt p on p.map_id = c.map_id and p.way_id = c.a join pt q on q.map_id = c.map_id and q.way_id = c.b and (q.k = p.k or q.k = p.n + 1 - p.k) group by all)"""
_TWIN = _PAIRS + """,
twin as (select distinct p.map_id, p.a as way_id from pair p join lines x on x.map_id = p.map_id and x.way_id = p.a join lines y on y.map_id = p.map_id and y.way_id = p.b where least(fwd, rev) < 0.5)"""
_ANGLE = """bend as (
  select map_id, way_id, min(case when s = 0 then 180.0 else degrees(acos(greatest(least(c / s, 1.0), -1.0))) end) as least_angle from (
    select map_id, way_id, (px - x) * (nx - x) + (py - y) * (ny - y) as c, sqrt(power(px - x, 2) + power(py - y, 2)) * sqrt(power(nx - x, 2) + power(ny - y, 2)) as s from seg where px is not null and nx is not null)
  group by all)"""


def _sampled(n: int) -> str:
    return f"""smp0 as (
  select c.map_id, c.way_id, i, arg_min(struct_pack(x := c.x, y := c.y, nx := coalesce(c.nx, c.x), ny := coalesce(c.ny, c.y), l := c.l, d := coalesce(d.l - c.l, 0), t := t.len * i / {n - 1}), c.k) as s
  from cum c join len t using (map_id, way_id) left join cum d on d.map_id = c.map_id and d.way_id = c.way_id and d.k = c.k + 1, (select unnest(range({n})) as i)
  where (d.l >= t.len * i / {n - 1} or c.k = greatest(c.n - 1, 1)) group by all),
smp as (select map_id, way_id, i, s.x + least(case when s.d > 0 then (s.t - s.l) / s.d else 0 end, 1) * (s.nx - s.x) as x, s.y + least(case when s.d > 0 then (s.t - s.l) / s.d else 0 end, 1) * (s.ny - s.y) as y from smp0)"""


_CENTRE = "ctr as (select s.map_id, s.rel_id, avg(x) as cx, avg(y) as cy from side s join pt using (map_id, way_id) group by all)"
_FACING = """(f.cx - p0.x) * (p0.y - p1.y) + (f.cy - p0.y) * (p1.x - p0.x)"""


def _result(req: str, body: str, status: str, bad: str, total: str, more: str = "") -> str:
    rec = "recursive " if "recursive" in more else ""
    return f"""with {rec}{BASE}{", " + more.replace("recursive ", "") if more else ""},
found as ({body}),
x as (select m.map_id, f.* exclude (map_id) from maps m left join found f using (map_id))
select map_id, '{req}' as req_id, {status} as status, cast({bad} as bigint) as offenders, cast({total} as bigint) as total from x"""


def _graded(total: str = "coalesce(total, 0)", bad: str = "coalesce(bad, 0)") -> str:
    return f"case when {total} = 0 then 'SKIP' when {bad} = 0 then 'PASS' else 'FAIL' end"


_BT = ("coalesce(bad, 0)", "coalesce(total, 0)")
_COUNTS = """cnt as (
  select map_id, sum(wi) as wi, sum(wt) as wt, sum(wb) as wb, sum(wc) as wc, sum(turning) as turning, sum(crosswalks) as crosswalks, sum(rt) as rt, sum(rc) as rc, sum(rw) as rw from (
    select map_id, cast(type = 'intersection_area' as int) as wi, cast(type = 'traffic_light' as int) as wt, cast(type = 'light_bulbs' as int) as wb, cast(type = 'crosswalk_polygon' as int) as wc, 0 as turning, 0 as crosswalks, 0 as rt, 0 as rc, 0 as rw from way
    union all select map_id, 0, 0, 0, 0, cast(turn_direction is not null and rel_type = 'lanelet' as int), cast(coalesce(subtype = 'crosswalk' and rel_type = 'lanelet', false) as int),
      cast(coalesce(subtype = 'traffic_light' and rel_type = 'regulatory_element', false) as int), cast(coalesce(subtype = 'crosswalk' and rel_type = 'regulatory_element', false) as int), cast(coalesce(subtype = 'right_of_way' and rel_type = 'regulatory_element', false) as int) from rel) group by map_id),
cn as (select map_id, coalesce(wi, 0) as wi, coalesce(wt, 0) as wt, coalesce(wb, 0) as wb, coalesce(wc, 0) as wc, turning, crosswalks, rt, rc, rw from cnt)"""
_XSEC = """xs0 as (
  select b.map_id, b.rel_id, e.head as l0, e.tail as l1, f.head as r0, f.tail as r1, sqrt(power(a.x - c.x, 2) + power(a.y - c.y, 2)) + sqrt(power(z.x - d.x, 2) + power(z.y - d.y, 2)) as plain,
    sqrt(power(a.x - d.x, 2) + power(a.y - d.y, 2)) + sqrt(power(z.x - c.x, 2) + power(z.y - c.y, 2)) as cross_
  from bnd b join ends e on e.map_id = b.map_id and e.way_id = b.l and e.refs >= 2 join ends f on f.map_id = b.map_id and f.way_id = b.r and f.refs >= 2
  join node a on a.map_id = b.map_id and a.node_id = e.head join node z on z.map_id = b.map_id and z.node_id = e.tail join node c on c.map_id = b.map_id and c.node_id = f.head join node d on d.map_id = b.map_id and d.node_id = f.tail),
xs as (
  select map_id, rel_id, 0 as ord, least(l0, case when plain <= cross_ then r0 else r1 end) as n1, greatest(l0, case when plain <= cross_ then r0 else r1 end) as n2 from xs0
  union all select map_id, rel_id, 1, least(l1, case when plain <= cross_ then r1 else r0 end), greatest(l1, case when plain <= cross_ then r1 else r0 end) from xs0)"""
_SHARED = """en as (select distinct s.map_id, s.rel_id, s.role, unnest([head, tail]) as node from side s join ends e using (map_id, way_id) where refs >= 2),
pr as (select l.map_id, l.rel_id, l.node as a, r.node as b from en l join en r using (map_id, rel_id) where l.role = 'left' and r.role = 'right' and l.node <> r.node),
sh as (select map_id, rel_id, least(count(*), 2) as shared from pr p where exists (select 1 from en u join en v on u.map_id = v.map_id and u.rel_id = v.rel_id where u.map_id = p.map_id and u.node = p.a and v.node = p.b and u.rel_id <> p.rel_id) group by all)"""
_STOPS = """stops as (
  select m.map_id, m.rel_id, m.seq, m.member_id, m.ref as way_id, min(sqrt(power(s.x - e.x, 2) + power(s.y - e.y, 2))) as gap
  from mem m join reg using (map_id, rel_id) join way w on w.map_id = m.map_id and w.way_id = m.ref and w.type = 'stop_line' join smp s on s.map_id = m.map_id and s.way_id = m.ref and s.i = 1
  join mem g on g.map_id = m.map_id and g.rel_id = m.rel_id and g.mtype = 'relation' join bnd b on b.map_id = g.map_id and b.rel_id = g.ref
  join (select l.map_id, l.way_id as l, r.way_id as r, (l.x + r.x) / 2 as x, (l.y + r.y) / 2 as y from pt l join pt r on l.map_id = r.map_id and l.n >= 2 and r.n >= 2 and ((l.k = 1 and r.k = 1) or (l.k = l.n and r.k = r.n)) where l.way_id in (select l from bnd) and r.way_id in (select r from bnd)) e on e.map_id = b.map_id and e.l = b.l and e.r = b.r
  where m.role = 'ref_line' group by all)"""
_ITEMS = """it0 as (
  select b.map_id, b.rel_id, l.one_way, b.l, b.r, x.len as ll, y.len as rl from ll l join bnd b using (map_id, rel_id) join len x on x.map_id = b.map_id and x.way_id = b.l join len y on y.map_id = b.map_id and y.way_id = b.r
  where l.subtype = 'road' and l.turn_direction is null and x.n >= 2 and y.n >= 2 and greatest(x.len, y.len) >= 1),
it1 as (
  select map_id, rel_id, avg(x) as cx, avg(y) as cy, avg(case when side = 'l' then ele end) as le, avg(case when side = 'r' then ele end) as re,
    sum(case when k = n then x else 0 end) / 2 - sum(case when k = 1 then x else 0 end) / 2 as dx, sum(case when k = n then y else 0 end) / 2 - sum(case when k = 1 then y else 0 end) / 2 as dy
  from (select i.map_id, i.rel_id, 'l' as side, p.* exclude (map_id) from it0 i join pt p on p.map_id = i.map_id and p.way_id = i.l union all select i.map_id, i.rel_id, 'r', p.* exclude (map_id) from it0 i join pt p on p.map_id = i.map_id and p.way_id = i.r) group by all),
it as (select i.*, j.cx, j.cy, coalesce((le + re) / 2, le, re) as ele, dx, dy, cast(round_even(cx / 5, 0) as bigint) as gx, cast(round_even(cy / 5, 0) as bigint) as gy from it0 i join it1 j using (map_id, rel_id)),
ov0 as (select a.map_id, a.rel_id as a, b.rel_id as b, a.l as al, a.r as ar, b.l as bl, b.r as br, a.ll as all_, a.rl as arl, b.ll as bll, b.rl as brl,
    coalesce(abs(a.ele - b.ele) > 0.5, false) or a.dx * b.dx + a.dy * b.dy < 0 or coalesce(a.one_way = 'no', false) or coalesce(b.one_way = 'no', false) as legal
  from it a join it b on a.map_id = b.map_id and a.rel_id < b.rel_id and abs(a.gx - b.gx) <= 1 and abs(a.gy - b.gy) <= 1 and sqrt(power(a.cx - b.cx, 2) + power(a.cy - b.cy, 2)) <= 5),
gap as (
  select map_id, u, v, least(max(case when q.i = p.i then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end), max(case when q.i = 11 - p.i then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end)) < 0.5 as near
  from (select map_id, al as u, bl as v from ov0 union select map_id, ar, br from ov0 union select map_id, al, br from ov0 union select map_id, ar, bl from ov0) join smp p using (map_id) join smp q using (map_id) where p.way_id = u and q.way_id = v group by all),
ov as (select o.map_id, a, b, legal from ov0 o
  left join gap g1 on g1.map_id = o.map_id and g1.u = al and g1.v = bl left join gap g2 on g2.map_id = o.map_id and g2.u = ar and g2.v = br left join gap g3 on g3.map_id = o.map_id and g3.u = al and g3.v = br left join gap g4 on g4.map_id = o.map_id and g4.u = ar and g4.v = bl
  where (g1.near and g2.near and least(all_, bll) >= 1 and least(all_, bll) >= 0.9 * greatest(all_, bll) and least(arl, brl) >= 1 and least(arl, brl) >= 0.9 * greatest(arl, brl))
    or (g3.near and g4.near and least(all_, brl) >= 1 and least(all_, brl) >= 0.9 * greatest(all_, brl) and least(arl, bll) >= 1 and least(arl, bll) >= 0.9 * greatest(arl, bll)))"""

CHECK_SQL = {
    "vm-01-01": _result("vm-01-01", """select map_id, count(*) as total, greatest(count(*) filter (location is null), count(*) filter (one_way is null), count(*) filter (speed_limit is null and s.rel_id is null)) as bad
  from ll left join (select distinct m.map_id, m.rel_id from mem m join reg g on g.map_id = m.map_id and g.rel_id = m.ref and g.subtype = 'speed_limit' where m.mtype = 'relation') s using (map_id, rel_id)
  where subtype in ('road', 'road_shoulder') group by map_id""", _graded(), *_BT),
    "vm-01-02": _result("vm-01-02", """select map_id, count(*) as ways, count(*) filter (c) as total, count(*) filter (c and not coalesce(type in ('line_thin', 'line_thick', 'road_border') and lane_change is not null, false)) as bad
  from (select o.*, w.type, w.lane_change, drivable and not (uses >= 2 and all_road) and t.way_id is null as c from own o left join twin t using (map_id, way_id) left join way w using (map_id, way_id)) group by map_id""", _graded("coalesce(ways, 0)"), *_BT, _TWIN),
    "vm-01-03": _result("vm-01-03", "select map_id, count(*) as total, count(*) filter (uses > 1) as bad from own group by map_id", "case when coalesce(total, 0) = 0 then 'SKIP' when bad > 0 then 'PASS' else 'FAIL' end", *_BT),
    "vm-01-04": _result("vm-01-04", """select map_id, sum(s) as shared, sum(d) as dupes, sum(o) as ways, sum(t) as lines from (
    select map_id, 1 as s, 0 as d, 0 as o, 0 as t from (select distinct f.map_id, f.way_id from fs f join fs g on g.map_id = f.map_id and g.way_id = f.way_id and g.role = f.role and f.rel_id < g.rel_id where f.v * g.v < 0 and abs(f.v) > 0.001 and abs(g.v) > 0.001)
    union all select map_id, 0, 1, 0, 0 from dup union all select map_id, 0, 0, 1, 0 from own union all select map_id, 0, 0, 0, 1 from typed) group by map_id""",
        "case when coalesce(dupes, 0) > 0 then 'FAIL' when coalesce(shared, 0) = 0 then 'SKIP' else 'PASS' end", "case when dupes > 0 then dupes else coalesce(shared, 0) end", "case when dupes > 0 then lines when coalesce(shared, 0) = 0 then 0 else ways end",
        f"""{_PAIRS}, {_CENTRE}, axis as (select a.map_id, a.way_id, a.n, a.x as x0, a.y as y0, b.x as x1, b.y as y1 from pt a join pt b on a.map_id = b.map_id and a.way_id = b.way_id and a.k = 1 and b.k = b.n and a.n >= 2),
fs as (select s.*, (cx - x0) * (y0 - y1) + (cy - y0) * (x1 - x0) as v, cx, cy from side s join ctr using (map_id, rel_id) join axis using (map_id, way_id)),
typed as (select map_id, way_id from way join len using (map_id, way_id) where type in ('line_thin', 'line_thick', 'road_border') and len.n >= 2 and len.len >= 1),
roles as (select map_id, way_id, list_sort(list_distinct(list(role))) as roles from side group by all),
dup as (select distinct p.map_id, p.a, p.b from pair p join typed x on x.map_id = p.map_id and x.way_id = p.a join typed y on y.map_id = p.map_id and y.way_id = p.b
  join roles ra on ra.map_id = p.map_id and ra.way_id = p.a join roles rb on rb.map_id = p.map_id and rb.way_id = p.b join axis ax on ax.map_id = p.map_id and ax.way_id = p.a
  join fs f on f.map_id = p.map_id and f.way_id = p.a join side sb on sb.map_id = p.map_id and sb.way_id = p.b join ctr cb on cb.map_id = p.map_id and cb.rel_id = sb.rel_id
  where p.a < p.b and least(fwd, rev) < 0.5 and ra.roles = rb.roles and f.v * ((cb.cx - x0) * (y0 - y1) + (cb.cy - y0) * (x1 - x0)) < 0 and abs(f.v) > 0.001 and abs((cb.cx - x0) * (y0 - y1) + (cb.cy - y0) * (x1 - x0)) > 0.001)"""),
    "vm-01-05": _result("vm-01-05", "select map_id, count(*) as total, count(*) filter (least_angle < 60) as bad from way left join bend using (map_id, way_id) where type in ('line_thin', 'line_thick', 'road_border', 'curbstone') group by map_id", _graded(), *_BT, _ANGLE),
    "vm-01-16": _result("vm-01-16", """select map_id, count(*) filter (subtype = 'road_shoulder') as total, any_value(b) as bad from ll left join (
    select p.map_id, count(distinct least(p.a, p.b) * 1000000000000 + greatest(p.a, p.b)) as b from pair p join subl x on x.map_id = p.map_id and x.way_id = p.a and x.subtype = 'road' join subl y on y.map_id = p.map_id and y.way_id = p.b and y.subtype = 'road_shoulder' where least(fwd, rev) < 0.05 group by all) using (map_id) group by map_id""",
        _graded(), "case when coalesce(total, 0) = 0 then 0 else coalesce(bad, 0) end", "coalesce(total, 0)", _PAIRS + ", subl as (select distinct s.map_id, s.way_id, l.subtype from side s join ll l using (map_id, rel_id) join lines using (map_id, way_id))"),
    "vm-01-21": _result("vm-01-21", """select map_id, count(*) as total, count(*) filter (coalesce(shared, 0) = 0) as bad from (
    select l.map_id, l.rel_id, greatest(coalesce(case when a.n >= 2 then a.len end, 0), coalesce(case when b.n >= 2 then b.len end, 0)) as size from ll l join bnd using (map_id, rel_id) left join len a on a.map_id = l.map_id and a.way_id = bnd.l left join len b on b.map_id = l.map_id and b.way_id = bnd.r where l.subtype = 'road')
  left join sh using (map_id, rel_id) where size >= 1 group by map_id""", _graded(), *_BT, _SHARED),
    "vm-03-01": _result("vm-03-01", "select * from cn", "case when coalesce(turning, 0) = 0 then 'SKIP' when wi = 0 then 'FAIL' else 'PASS' end", "case when turning > 0 and wi = 0 then turning else 0 end", "case when coalesce(turning, 0) = 0 then 0 when wi = 0 then turning else wi end", _COUNTS),
    "vm-03-02": _result("vm-03-02", "select * from cn", "case when coalesce(turning, 0) = 0 then 'SKIP' else 'PASS' end", "0", "coalesce(turning, 0)", _COUNTS),
    "vm-03-03": _result("vm-03-03", """select map_id, count(*) as total, greatest(count(*) filter (wmin > 0 and wmax > 2.5 * wmin), count(*) filter (least(coalesce(a1, 180), coalesce(a2, 180)) < 60)) as bad from (
    select l.map_id, l.rel_id, (select min(least_angle) from bend b where b.map_id = l.map_id and b.way_id = n.l) as a1, (select min(least_angle) from bend b where b.map_id = l.map_id and b.way_id = n.r) as a2, wmin, wmax
    from ll l left join bnd n using (map_id, rel_id) left join wd using (map_id, rel_id) where turn_direction is not null) group by map_id""", _graded(), *_BT, _ANGLE + ", " + _sampled(7) + """,
wd as (select b.map_id, b.rel_id, min(d) as wmin, max(d) as wmax from (
  select b.map_id, b.rel_id, sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) as d from bnd b join ll using (map_id, rel_id)
  join len ln on ln.map_id = b.map_id and ln.way_id = b.l and ln.n >= 2 join len rn on rn.map_id = b.map_id and rn.way_id = b.r and rn.n >= 2
  join pt a0 on a0.map_id = b.map_id and a0.way_id = b.l and a0.k = 1 join pt a1 on a1.map_id = b.map_id and a1.way_id = b.l and a1.k = a1.n join pt b0 on b0.map_id = b.map_id and b0.way_id = b.r and b0.k = 1 join pt b1 on b1.map_id = b.map_id and b1.way_id = b.r and b1.k = b1.n
  join smp p on p.map_id = b.map_id and p.way_id = b.l join smp q on q.map_id = b.map_id and q.way_id = b.r
   and q.i = case when sqrt(power(a0.x - b0.x, 2) + power(a0.y - b0.y, 2)) + sqrt(power(a1.x - b1.x, 2) + power(a1.y - b1.y, 2)) > sqrt(power(a0.x - b1.x, 2) + power(a0.y - b1.y, 2)) + sqrt(power(a1.x - b0.x, 2) + power(a1.y - b0.y, 2)) then 6 - p.i else p.i end
  where turn_direction is not null) b group by all)"""),
    "vm-03-07": _result("vm-03-07", """select map_id, count(*) as total, any_value(b) as bad, any_value(c) as any_ from cl left join (select map_id, count(*) as b from (
      select p.map_id, p.way_id as u, q.way_id as v, least(max(case when q.i = p.i then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end), max(case when q.i = 4 - p.i then sqrt(power(p.x - q.x, 2) + power(p.y - q.y, 2)) end)) as g
      from cl a join cl b on a.map_id = b.map_id and a.way_id < b.way_id join smp p on p.map_id = a.map_id and p.way_id = a.way_id join smp q on q.map_id = b.map_id and q.way_id = b.way_id group by all) where g < 0.1 group by all) using (map_id)
  right join (select map_id, count(*) as c from ll where turn_direction is not null group by map_id) using (map_id) group by map_id""", _graded("coalesce(any_, 0)"), "coalesce(bad, 0)", "case when any_ is null then 0 else total end",
        _sampled(5) + ", cl as (select distinct s.map_id, s.way_id from side s join ll using (map_id, rel_id) join len using (map_id, way_id) where turn_direction is not null and len.len > 1)"),
    "vm-03-08": _result("vm-03-08", "select * from cn", "case when coalesce(turning, 0) = 0 or wi = 0 then 'SKIP' else 'PASS' end", "0", "0", _COUNTS),
    "vm-03-09": _result("vm-03-09", "select map_id, count(*) as total, count(*) filter (gap > 6) as bad from stops group by map_id", _graded(), *_BT, _sampled(3) + ", " + _STOPS),
    "vm-03-10": _result("vm-03-10", "select * from cn", "case when coalesce(turning, 0) = 0 or rw = 0 then 'SKIP' else 'PASS' end", "0", "case when coalesce(turning, 0) = 0 then 0 when rw = 0 then turning else rw end", _COUNTS),
    "vm-04-01": _result("vm-04-01", "select * from cn", "case when coalesce(wt, 0) = 0 and coalesce(rt, 0) = 0 then 'SKIP' when rt > 0 and wb > 0 then 'PASS' else 'FAIL' end", "case when wt = 0 and rt = 0 then 0 else cast(rt = 0 as int) + cast(wb = 0 as int) end", "case when wt = 0 and rt = 0 then 0 else 3 end", _COUNTS),
    "vm-05-01": _result("vm-05-01", """select c.*, cast(wc = 0 as int) + cast(rc = 0 as int) + cast(coalesce(loose, 0) > 0 as int) + 1 as bad from cn c left join (
    select l.map_id, count(*) filter (not exists (select 1 from mem m join reg g using (map_id, rel_id) where m.map_id = l.map_id and m.ref = l.rel_id and m.role = 'refers' and g.subtype = 'crosswalk')) as loose from ll l where subtype = 'crosswalk' group by all) using (map_id)""",
        "case when coalesce(crosswalks, 0) = 0 then 'SKIP' else 'FAIL' end", "case when crosswalks = 0 then 0 else bad end", "coalesce(crosswalks, 0)", _COUNTS),
    "vm-07-04": _result("vm-07-04", "select map_id, count(*) as total, count(*) filter (ele is null) as bad from node group by map_id", _graded(), *_BT),
    "vm-07-06": _result("vm-07-06", """select map_id, count(*) as total, count(*) filter (coalesce(t, 0) < 2) as bad from ll left join (
    select map_id, rel_id, min(times) as t from xs join (select map_id, n1, n2, count(*) as times from xs group by all) using (map_id, n1, n2) group by all) using (map_id, rel_id) where turn_direction is not null group by map_id""", _graded(), *_BT, _XSEC),
    "vm-07-08": _result("vm-07-08", "select map_id, count(*) as total, any_value(b) as bad from it left join (select map_id, count(*) filter (not legal) as b from ov group by all) using (map_id) group by map_id",
        "case when coalesce(total, 0) < 2 then 'SKIP' when coalesce(bad, 0) = 0 then 'PASS' else 'FAIL' end", "coalesce(bad, 0)", "case when coalesce(total, 0) < 2 then 0 else total end", _sampled(12) + ", " + _ITEMS),
}


def _check(req: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: C.CHECKS[req](map_tables(spark, sf)).select("map_id", "req_id", "status", "offenders", "total")


def _name(req: str) -> str:
    return f"check_{req.replace('-', '_')}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {_name(r): _check(r) for r in C.CHECKS}
SQL: dict[str, str] = {_name(r): s for r, s in CHECK_SQL.items()}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = f"with {BASE}{sql}"
        return f

    return add


def xy(p):
    return F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))


@query("s02_node_xy", " select map_id, node_id, round(x, 6) as x, round(y, 6) as y, ele from node")
def s02(spark, sf):
    return map_tables(spark, sf).node.select("map_id", "node_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "ele")


@query("f02_lanelet_bounds", " select map_id, rel_id, l as \"left\", r as \"right\" from bnd")
def f02(spark, sf):
    return map_tables(spark, sf).bounds


@query("f03_polylines", " select map_id, way_id, n as points, (select list(node_id order by k) from pt p where p.map_id = l.map_id and p.way_id = l.way_id) as nodes from len l")
def f03(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.size("pts").cast("bigint").alias("points"), F.transform("pts", lambda p: p["node_id"]).alias("nodes"))


@query("a07_polyline_length", " select map_id, way_id, round(len, 6) as len from len")
def a07(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.round(P.length(F.col("pts")), 6).alias("len"))


@query("a03_owner_subtypes", " select map_id, way_id, list_sort(list(coalesce(subtype, ''))) as subtypes, count(*) as uses from side join ll using (map_id, rel_id) group by all")
def a03(spark, sf):
    return map_tables(spark, sf).owners.select("map_id", "way_id", "subtypes", "uses")


@query("a08_lanelet_centroid", ", " + _CENTRE + " select map_id, rel_id, round(cx + 1e-8, 5) as cx, round(cy + 1e-8, 5) as cy from ctr")
def a08(spark, sf):
    return C.centroids(map_tables(spark, sf)).where("cx is not null").select("map_id", "rel_id", F.round(F.col("cx") + 1e-8, 5).alias("cx"), F.round(F.col("cy") + 1e-8, 5).alias("cy"))


@query("a10_mean_ele", " select map_id, way_id, round(avg(ele) + 1e-8, 5) as ele from pt group by all")
def a10(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.round(P.mean(F.col("pts"), "ele") + 1e-8, 5).alias("ele"))


@query("a16_cross_sections", ", " + _XSEC + " select * from xs")
def a16(spark, sf):
    return T.cross_sections(map_tables(spark, sf))


@query("j15_shared_ends", ", " + _SHARED + " select map_id, rel_id, shared from sh")
def j15(spark, sf):
    return T.shared_ends(map_tables(spark, sf)).withColumn("shared", F.col("shared").cast("bigint"))


@query("j08_coincident_ways", ", " + _TWIN + " select map_id, way_id from twin")
def j08(spark, sf):
    return T.coincident_ways(map_tables(spark, sf))


@query("j13_overlaps", ", " + _sampled(12) + ", " + _ITEMS + " select map_id, a, b, legal from ov")
def j13(spark, sf):
    return C.overlaps(map_tables(spark, sf))


@query("j16_stop_line_gaps", ", " + _sampled(3) + ", " + _STOPS + " select map_id, rel_id, member_id, way_id, round(gap, 5) as gap from stops")
def j16(spark, sf):
    return C.stop_line_gaps(map_tables(spark, sf)).select("map_id", "rel_id", F.col("seq.member_id").alias("member_id"), "way_id", F.round("gap", 5).alias("gap"))


@query("w03_min_interior_angle", ", " + _ANGLE + " select map_id, way_id, round(coalesce(least_angle, 180.0), 4) as angle from len left join bend using (map_id, way_id)")
def w03(spark, sf):
    return map_tables(spark, sf).polylines.select("map_id", "way_id", F.round(P.min_interior_angle(F.col("pts")), 4).alias("angle"))


@query("w07_sample_12", ", " + _sampled(12) + " select map_id, way_id, i, round(x, 4) as x, round(y, 4) as y from smp")
def w07(spark, sf):
    at = map_tables(spark, sf).polylines.select("map_id", "way_id", F.posexplode(R.sample_count(xy("pts"), 12)).alias("i", "p"))
    return at.select("map_id", "way_id", F.col("i").cast("bigint").alias("i"), F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


@query("w08_midpoint", ", " + _sampled(3) + " select map_id, way_id, round(x, 4) as x, round(y, 4) as y from smp where i = 1")
def w08(spark, sf):
    mid = F.get(R.sample_count(xy("pts"), 3), F.lit(1))
    return map_tables(spark, sf).polylines.select("map_id", "way_id", mid.alias("m")).select("map_id", "way_id", F.round("m.x", 4).alias("x"), F.round("m.y", 4).alias("y"))


@query("a18_result_counts", None)
def a18(spark, sf):
    """How many maps pass, fail and skip each check, and whether any fails."""
    return C.check_map(map_tables(spark, sf)).groupBy("req_id").agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "FAIL", "SKIP")])
