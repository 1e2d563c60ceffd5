"""The twenty checks of a lane-level map. Each returns one row per map: req_id, name, status, detail, offenders, total.

A check is an aggregate per map; maps without anything to check get SKIP. ``offenders`` counts defects, except where a
check counts good cases (sharing), as noted there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import polyline as P
from roadloom.functions import resample as R
from roadloom.operators.components import components
from roadloom.operators.maptables import MAP, MapTables, coincident_ways, cross_sections, shared_ends, twins
from roadloom.storage import Scratch


def verdict(t: MapTables, found: DataFrame, req: str, status: Column, detail: Column, offenders: Column, total: Column) -> DataFrame:
    """One result row per map; ``found`` has one row per map with anything to count, and nulls elsewhere read as 0."""
    rows = t.maps.join(found, MAP, "left").fillna(0)
    return rows.select(MAP, F.lit(req).alias("req_id"), F.lit(M.CHECK_NAMES[req]).alias("name"), status.alias("status"), detail.alias("detail"), offenders.cast("bigint").alias("offenders"), total.cast("bigint").alias("total"))


def graded(total: str, bad: str) -> Column:
    return F.when(F.col(total) == 0, M.SKIP).when(F.col(bad) == 0, M.PASS).otherwise(M.FAIL)


def count_if(c: Column | str) -> Column:
    return F.count_if(F.expr(c) if isinstance(c, str) else c)


def _tell(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def n(name: str) -> Column:
    return F.col(name).cast("string")


def ruled_lanelets(t: MapTables) -> DataFrame:
    """(map_id, rel_id) of relations with a speed limit as regulatory element."""
    speed = t.regelems.where("subtype = 'speed_limit'").select(MAP, F.col("rel_id").alias("ref"))
    return t.member.where("mtype = 'relation'").join(speed, [MAP, "ref"], "left_semi").select(MAP, "rel_id").distinct()


def loose_crosswalks(t: MapTables) -> DataFrame:
    """Crosswalks that no regulatory element refers to."""
    reg = t.regelems.where("subtype = 'crosswalk'").select(MAP, "rel_id")
    told = t.member.where("role = 'refers'").join(reg, [MAP, "rel_id"], "left_semi").select(MAP, F.col("ref").alias("rel_id")).distinct()
    return t.lanelets.where("subtype = 'crosswalk'").join(told, [MAP, "rel_id"], "left_anti")


def basic_tags(t: MapTables) -> DataFrame:
    """vm-01-01: drivable lanelets carry location, one_way and a speed limit, as tag or by a regulatory element."""
    limited = ruled_lanelets(t).withColumn("ruled", F.lit(True))
    roads = t.lanelets.where(F.col("subtype").isin(M.DRIVABLE)).join(limited, [MAP, "rel_id"], "left")
    found = roads.groupBy(MAP).agg(
        F.count("*").alias("total"), count_if("location is null").alias("loc"), count_if("one_way is null").alias("ow"), count_if("speed_limit is null and ruled is null").alias("spd")
    ).withColumn("worst", F.greatest("loc", "ow", "spd"))
    return verdict(t, found, "vm-01-01", graded("total", "worst"), _tell("without location ", n("loc"), ", one_way ", n("ow"), ", speed_limit ", n("spd")), F.col("worst"), F.col("total"))


def boundary_tags(t: MapTables) -> DataFrame:
    """vm-01-02: lines of drivable lanelets carry type and lane_change, except dividers between road lanelets."""
    own = t.owners.join(coincident_ways(t).withColumn("twin", F.lit(True)), [MAP, "way_id"], "left").join(t.way.select(MAP, "way_id", "type", "lane_change"), [MAP, "way_id"], "left")
    counts = F.col("drivable") & ~((F.col("uses") >= 2) & F.col("all_road")) & F.col("twin").isNull()
    tagged = F.coalesce(F.col("type").isin(M.BOUNDARY_TYPES) & F.col("lane_change").isNotNull(), F.lit(False))
    found = own.groupBy(MAP).agg(F.count("*").alias("ways"), count_if(counts).alias("total"), count_if(counts & ~tagged).alias("bad"))
    return verdict(t, found, "vm-01-02", graded("ways", "bad"), F.lit("lines without type or lane_change"), F.col("bad"), F.col("total"))


def line_sharing(t: MapTables) -> DataFrame:
    """vm-01-03: some boundary ways serve more than one lanelet; ``offenders`` counts those ways."""
    found = t.owners.groupBy(MAP).agg(F.count("*").alias("total"), count_if("uses > 1").alias("shared"))
    status = F.when(F.col("total") == 0, M.SKIP).when(F.col("shared") > 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, found, "vm-01-03", status, F.lit("ways used by several lanelets"), F.col("shared"), F.col("total"))


def centroids(t: MapTables) -> DataFrame:
    """(map_id, rel_id, cx, cy): the mean of all points of both boundaries; null without points."""
    every = F.concat("lp", "rp")
    return t.shaped.select(MAP, "rel_id", P.mean(every, "x").alias("cx"), P.mean(every, "y").alias("cy"))


def opposing_sharing(t: MapTables) -> DataFrame:
    """vm-01-04: opposing lanelets share their centre line. FAIL for twins kept as two ways; else PASS if any way is
    shared by a straddling pair in one role (``offenders`` counts those); else SKIP."""
    own = t.sides.join(centroids(t), [MAP, "rel_id"])
    other = own.select(MAP, "way_id", "role", F.col("rel_id").alias("r2"), F.col("cx").alias("x2"), F.col("cy").alias("y2"))
    facing = own.join(other, [MAP, "way_id", "role"]).where("rel_id < r2").join(t.polylines, [MAP, "way_id"])
    shared = facing.where(P.straddle(F.col("cx"), F.col("cy"), F.col("x2"), F.col("y2"), F.col("pts"))).groupBy(MAP).agg(F.count_distinct("way_id").alias("shared"))
    typed = t.polylines.join(t.way.where(F.col("type").isin(M.BOUNDARY_TYPES)).select(MAP, "way_id"), [MAP, "way_id"], "left_semi")
    typed = typed.where((F.size("pts") >= 2) & (P.length(F.col("pts")) >= M.MIN_BOUNDARY))
    roles = own.groupBy(MAP, "way_id").agg(F.array_sort(F.collect_set("role")).alias("roles"))
    pairs = twins(typed, typed, M.COINCIDENT_TOL)
    for s in ("a", "b"):
        pairs = pairs.join(roles.select(MAP, F.col("way_id").alias(s), F.col("roles").alias(f"{s}_roles")), [MAP, s])
    pairs = pairs.where("a_roles = b_roles").join(t.polylines.withColumnRenamed("way_id", "a"), [MAP, "a"])
    who = lambda s: own.select(MAP, F.col("way_id").alias(s), F.col("cx").alias(f"{s}x"), F.col("cy").alias(f"{s}y"))
    pairs = pairs.join(who("a"), [MAP, "a"]).join(who("b"), [MAP, "b"])
    dupes = pairs.where(P.straddle(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), F.col("pts"))).select(MAP, "a", "b").distinct().groupBy(MAP).agg(F.count("*").alias("dupes"))
    found = t.owners.groupBy(MAP).agg(F.count("*").alias("ways")).join(shared, MAP, "full").join(dupes, MAP, "full").join(typed.groupBy(MAP).agg(F.count("*").alias("lines")), MAP, "full")
    fail, none = F.col("dupes") > 0, F.col("shared") == 0
    status = F.when(fail, M.FAIL).when(none, M.SKIP).otherwise(M.PASS)
    detail = F.when(fail, "opposing lines coincide but are two ways").when(none, "no opposing lanelets").otherwise("opposing lanelets share a line")
    pick = lambda a, b: F.when(fail, F.col(a)).when(none, 0).otherwise(F.col(b))
    return verdict(t, found, "vm-01-04", status, detail, pick("dupes", "shared"), pick("lines", "ways"))


def smooth_lines(t: MapTables) -> DataFrame:
    """vm-01-05: no boundary line bends sharper than 60 degrees at a point."""
    lines = t.way.where(F.col("type").isin(M.SMOOTH_TYPES)).join(t.polylines, [MAP, "way_id"], "left")
    bend = F.coalesce(P.min_interior_angle(F.col("pts")) < M.KINK_DEGREES, F.lit(False))
    found = lines.groupBy(MAP).agg(F.count("*").alias("total"), count_if(bend).alias("bad"))
    return verdict(t, found, "vm-01-05", graded("total", "bad"), F.lit("ways with a kink"), F.col("bad"), F.col("total"))


def shoulder_sharing(t: MapTables) -> DataFrame:
    """vm-01-16: a road's and its shoulder's boundary on one line are one way."""
    sub = t.sides.join(t.lanelets.select(MAP, "rel_id", "subtype"), [MAP, "rel_id"])
    of = lambda s: t.boundary_lines.join(sub.where(F.col("subtype") == s).select(MAP, "way_id"), [MAP, "way_id"], "left_semi")
    found = twins(of("road"), of("road_shoulder"), M.SAME_LINE_TOL).groupBy(MAP).agg(F.count("*").alias("bad"))
    found = t.lanelets.groupBy(MAP).agg(count_if("subtype = 'road_shoulder'").alias("total")).join(found, MAP, "left")
    return verdict(t, found, "vm-01-16", graded("total", "bad"), F.lit("road and shoulder lines alike but two ways"), F.when(F.col("total") == 0, 0).otherwise(F.col("bad")), F.col("total"))


def connectivity(t: MapTables) -> DataFrame:
    """vm-01-21: a road lanelet shares at least one end cross-section with another lanelet."""
    size = F.greatest(*[F.when(F.size(p) >= 2, P.length(F.col(p))).otherwise(0.0) for p in ("lp", "rp")])
    roads = t.shaped.where("subtype = 'road'").where(size >= M.MIN_BOUNDARY).select(MAP, "rel_id").join(shared_ends(t), [MAP, "rel_id"], "left").fillna(0)
    found = roads.groupBy(MAP).agg(F.count("*").alias("total"), count_if("shared = 0").alias("bad"), count_if("shared = 1").alias("ended"))
    return verdict(t, found, "vm-01-21", graded("total", "bad"), _tell("isolated road lanelets; one-ended ", n("ended")), F.col("bad"), F.col("total"))


def exempt(t: MapTables) -> DataFrame:
    """(map_id, rel_id, left, right, exempt): lanelets that are never cut: without a boundary, pedestrian, or in a
    junction."""
    rows = t.lanelets.join(t.bounds, [MAP, "rel_id"], "left")
    never = F.col("left").isNull() | F.col("right").isNull() | F.coalesce(F.col("subtype").isin(M.PEDESTRIAN), F.lit(False)) | F.col("turn_direction").isNotNull() | F.col("intersection_area").isNotNull()
    return rows.select(MAP, "rel_id", "left", "right", never.alias("exempt"))


def cuttable_ways(t: MapTables) -> DataFrame:
    """(map_id, way_id, cuttable, graded, component): a way can be cut if no lanelet of its component of the
    lanelet-way graph is exempt; it is graded if one of its owners is not."""
    ll = exempt(t)
    use = ll.select(MAP, "rel_id", "exempt", F.explode(F.array("left", "right")).alias("way_id")).where("way_id is not null")
    edges = use.select(MAP, F.concat(F.lit("w"), F.col("way_id").cast("string")).alias("a"), F.concat(F.lit("r"), F.col("rel_id").cast("string")).alias("b"))
    parts = components(edges, MAP, "a", "b")
    of_way = parts.select(MAP, F.col("node").alias("a"), "component")
    rows = use.withColumn("a", F.concat(F.lit("w"), F.col("way_id").cast("string"))).join(of_way, [MAP, "a"])
    blocked = rows.groupBy(MAP, "component").agg(F.bool_or("exempt").alias("blocked"))
    ways = rows.groupBy(MAP, "way_id", "component").agg(F.bool_or(~F.col("exempt")).alias("graded"))
    return ways.join(blocked, [MAP, "component"]).select(MAP, "way_id", (~F.col("blocked")).alias("cuttable"), "graded", "component")


def length_limits(t: MapTables) -> DataFrame:
    """vm-01-24: boundaries are at most 100 m, or 20 m where they curve; only what can be cut counts against it."""
    ways = cuttable_ways(t).where("graded").join(t.polylines, [MAP, "way_id"]).where(F.size("pts") >= 2).withColumn("len", P.length(F.col("pts")))
    ways = ways.select(MAP, "cuttable", "len", F.when((F.col("len") > M.MAX_CURVED) & (F.col("len") <= M.MAX_STRAIGHT), F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))).alias("pts"))
    limit = F.when(R.max_turn(F.col("pts")) > M.CURVE_TURN, M.MAX_CURVED).otherwise(M.MAX_STRAIGHT)
    ways = ways.withColumn("long", (F.col("len") > M.MAX_CURVED) & (F.col("len") > limit))
    found = ways.groupBy(MAP).agg(F.count("*").alias("total"), count_if("long and cuttable").alias("bad"), count_if("long and not cuttable").alias("fixed"))
    return verdict(t, found, "vm-01-24", graded("total", "bad"), _tell("boundaries over the limit; not to be cut ", n("fixed")), F.col("bad"), F.col("total"))


def connectors(t: MapTables) -> DataFrame:
    return t.shaped.where("turn_direction is not null")


def _counts(t: MapTables) -> DataFrame:
    """Per map how many ways, lanelets and regulatory elements there are of the kinds that presence checks ask for."""
    w = t.way.groupBy(MAP).agg(*[count_if(f"type = '{k}'").alias(f"w_{k}") for k in ("intersection_area", "traffic_light", "light_bulbs", "crosswalk_polygon", "stop_line")])
    turn, area = "turn_direction is not null", "intersection_area is not null"
    ll = t.lanelets.groupBy(MAP).agg(count_if(turn).alias("turning"), count_if(area).alias("inside"), count_if(f"{area} and not {turn}").alias("unturned"), count_if("subtype = 'crosswalk'").alias("crosswalks"))
    r = t.regelems.groupBy(MAP).agg(*[count_if(f"subtype = '{k}'").alias(f"r_{k}") for k in ("traffic_light", "crosswalk", "right_of_way")])
    return w.join(ll, MAP, "full").join(r, MAP, "full").fillna(0)


def area_presence(t: MapTables) -> DataFrame:
    """vm-03-01: a map with junction lanelets has intersection areas."""
    status = F.when(F.col("turning") == 0, M.SKIP).when(F.col("w_intersection_area") == 0, M.FAIL).otherwise(M.PASS)
    bad = F.when(status == M.FAIL, F.col("turning")).otherwise(0)
    total = F.when(status == M.SKIP, 0).when(status == M.FAIL, F.col("turning")).otherwise(F.col("w_intersection_area"))
    return verdict(t, _counts(t), "vm-03-01", status, _tell(n("w_intersection_area"), " areas"), bad, total)


def turn_tags(t: MapTables) -> DataFrame:
    """vm-03-02: lanelets that name an intersection area have a turn direction; without any, the tag itself counts."""
    status = F.when((F.col("inside") == 0) & (F.col("turning") == 0), M.SKIP).when(F.col("unturned") == 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, _counts(t), "vm-03-02", status, F.lit("junction lanelets without turn_direction"), F.col("unturned"), F.when(F.col("inside") > 0, F.col("inside")).otherwise(F.col("turning")))


def aligned(left: Column, right: Column) -> Column:
    """The right polyline, reversed if its ends then lie nearer to those of the left one."""
    a0, a1, b0, b1 = F.get(left, F.lit(0)), F.element_at(left, -1), F.get(right, F.lit(0)), F.element_at(right, -1)
    return F.when(P.dist(a0, b0) + P.dist(a1, b1) > P.dist(a0, b1) + P.dist(a1, b0), F.reverse(right)).otherwise(right)


def connector_shape(t: MapTables) -> DataFrame:
    """vm-03-03: connectors keep their width within a ratio of 2.5 and have no kink; the worse count decides."""
    c = connectors(t)
    xy = lambda p: F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    whole = (F.size("lp") >= 2) & (F.size("rp") >= 2)
    c = c.withColumn("rq", F.when(whole, xy(aligned(F.col("lp"), F.col("rp"))))).withColumn("lq", F.when(whole, xy(F.col("lp"))))
    c = c.withColumn("w", F.zip_with(R.sample_count(F.col("lq"), 7), R.sample_count(F.col("rq"), 7), P.dist))
    jump = F.coalesce((F.array_min("w") > 0) & (F.array_max("w") > M.WIDTH_RATIO * F.array_min("w")), F.lit(False))
    kink = F.least(P.min_interior_angle(F.col("lp")), P.min_interior_angle(F.col("rp"))) < M.KINK_DEGREES
    found = c.groupBy(MAP).agg(F.count("*").alias("total"), count_if(jump).alias("wide"), count_if(kink).alias("kinks")).withColumn("bad", F.greatest("wide", "kinks"))
    return verdict(t, found, "vm-03-03", graded("total", "bad"), _tell("width jumps ", n("wide"), ", kinks ", n("kinks")), F.col("bad"), F.col("total"))


def connector_sharing(t: MapTables) -> DataFrame:
    """vm-03-07: connector lines of one intersection that coincide along their whole length are one way. Connectors
    without an area are one group."""
    c = connectors(t).select(MAP, F.coalesce(F.col("intersection_area").cast("string"), F.lit("")).alias("area"), F.explode(F.array(F.struct(F.col("left").alias("w"), F.col("lp").alias("p")), F.struct(F.col("right").alias("w"), F.col("rp").alias("p")))).alias("s"))
    lines = c.select(MAP, "area", "s.w", "s.p").where("w is not null").dropDuplicates([MAP, "area", "w"]).where(P.length(F.col("p")) > M.MIN_BOUNDARY)
    lines = lines.withColumn("q", R.sample_count(F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))), 5)).drop("p")
    # lines that coincide have ends within the tolerance, so they meet in the cell of an end or one beside it
    lines = lines.withColumn("mid", F.get("q", F.lit(2))).withColumns({"gx": F.floor(F.col("mid.x")), "gy": F.floor(F.col("mid.y"))})
    near = lines.withColumn("gx", F.explode(F.sequence(F.col("gx") - 1, F.col("gx") + 1))).withColumn("gy", F.explode(F.sequence(F.col("gy") - 1, F.col("gy") + 1)))
    met = lines.join(near.select(MAP, "area", "gx", "gy", F.col("w").alias("w2"), F.col("q").alias("q2")), [MAP, "area", "gx", "gy"]).where("w < w2")
    gap = lambda q: F.array_max(F.zip_with("q", q, P.dist))
    bad = met.where(F.least(gap(F.col("q2")), gap(F.reverse("q2"))) < M.CONNECTOR_SHARE).groupBy(MAP).agg(F.count("*").alias("bad"))
    found = connectors(t).groupBy(MAP).agg(F.count("*").alias("any")).join(lines.groupBy(MAP).agg(F.count("*").alias("total")), MAP, "left").join(bad, MAP, "left")
    return verdict(t, found, "vm-03-07", graded("any", "bad"), F.lit("connector lines alike but several ways"), F.col("bad"), F.col("total"))


def area_range(t: MapTables) -> DataFrame:
    """vm-03-08: the middle of every connector lies inside the intersection area that it names."""
    areas = t.polylines.join(t.way.where("type = 'intersection_area'").select(MAP, "way_id"), [MAP, "way_id"], "left_semi")
    c = connectors(t)
    met = c.withColumn("area", F.col("intersection_area").cast("string")).join(areas.select(MAP, F.col("way_id").cast("string").alias("area"), F.col("pts").alias("ring")), [MAP, "area"])
    met = met.where((F.size("ring") >= 4) & (F.size("lp") >= 2) & (F.size("rp") >= 2))
    xy = lambda p: F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    met = met.withColumns({"lm": F.get(R.sample_count(xy("lp"), 3), F.lit(1)), "rm": F.get(R.sample_count(xy("rp"), 3), F.lit(1))})
    inside = P.in_ring((F.col("lm.x") + F.col("rm.x")) / 2, (F.col("lm.y") + F.col("rm.y")) / 2, F.col("ring"))
    bad = met.groupBy(MAP).agg(F.count("*").alias("total"), count_if(~inside).alias("bad"))
    found = _counts(t).join(bad, MAP, "left").fillna(0)
    status = F.when((F.col("turning") == 0) | (F.col("w_intersection_area") == 0), M.SKIP).when(F.col("bad") == 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, found, "vm-03-08", status, F.lit("connectors outside their area"), F.col("bad"), F.col("total"))


def stop_line_gaps(t: MapTables) -> DataFrame:
    """(map_id, rel_id, seq, way_id, gap): every stop line that a regulatory element refers to, with the distance of its
    middle from the nearest end cross-section of a lanelet that the element has as a member."""
    xy = lambda p: F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    lines = t.polylines.join(t.way.where("type = 'stop_line'").select(MAP, "way_id"), [MAP, "way_id"], "left_semi").select(MAP, F.col("way_id").alias("ref"), F.get(R.sample_count(xy("pts"), 3), F.lit(1)).alias("mid"))
    ends = t.shaped.where((F.size("lp") >= 2) & (F.size("rp") >= 2))
    mid = lambda get: F.struct(((get("lp")["x"] + get("rp")["x"]) / 2).alias("x"), ((get("lp")["y"] + get("rp")["y"]) / 2).alias("y"))
    ends = ends.select(MAP, F.col("rel_id").alias("ref"), F.explode(F.array(mid(lambda p: F.get(p, F.lit(0))), mid(lambda p: F.element_at(p, -1)))).alias("end"))
    reg = t.member.join(t.regelems.select(MAP, "rel_id"), [MAP, "rel_id"], "left_semi")
    stops = reg.where("role = 'ref_line'").join(lines, [MAP, "ref"]).select(MAP, "rel_id", "seq", F.col("ref").alias("way_id"), "mid")
    cross = reg.where("mtype = 'relation'").join(ends, [MAP, "ref"]).select(MAP, "rel_id", "end")
    return stops.join(cross, [MAP, "rel_id"]).groupBy(MAP, "rel_id", "seq", "way_id").agg(F.min(P.dist(F.col("mid"), F.col("end"))).alias("gap"))


def stop_line_range(t: MapTables) -> DataFrame:
    """vm-03-09: a governed stop line lies within 6 m of an end of a lanelet that its regulatory element governs."""
    found = stop_line_gaps(t).groupBy(MAP).agg(F.count("*").alias("total"), count_if(F.col("gap") > M.STOP_LINE_RANGE).alias("bad"))
    return verdict(t, found, "vm-03-09", graded("total", "bad"), F.lit("governed stop lines off the junction"), F.col("bad"), F.col("total"))


def right_of_way(t: MapTables) -> DataFrame:
    """vm-03-10: right-of-way elements of junctions, signed (with a refers member) or not; never fails."""
    signs = t.member.where("role = 'refers'").select(MAP, "rel_id").distinct().withColumn("sign", F.lit(True))
    row = t.regelems.where("subtype = 'right_of_way'").join(signs, [MAP, "rel_id"], "left").groupBy(MAP).agg(count_if("sign").alias("signed"))
    found = _counts(t).join(row, MAP, "left").fillna(0)
    status = F.when((F.col("turning") == 0) | (F.col("r_right_of_way") == 0), M.SKIP).otherwise(M.PASS)
    total = F.when(F.col("turning") == 0, 0).when(F.col("r_right_of_way") == 0, F.col("turning")).otherwise(F.col("r_right_of_way"))
    return verdict(t, found, "vm-03-10", status, _tell("signed ", n("signed"), ", right before left ", (F.col("r_right_of_way") - F.col("signed")).cast("string")), F.lit(0), total)


def traffic_lights(t: MapTables) -> DataFrame:
    """vm-04-01: a map with traffic lights has their elements and their bulbs."""
    absent = F.when(F.col("r_traffic_light") == 0, 1).otherwise(0) + F.when(F.col("w_light_bulbs") == 0, 1).otherwise(0)
    none = (F.col("w_traffic_light") == 0) & (F.col("r_traffic_light") == 0)
    status = F.when(none, M.SKIP).when(absent == 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, _counts(t), "vm-04-01", status, _tell(n("w_traffic_light"), " ways, ", n("r_traffic_light"), " elements, ", n("w_light_bulbs"), " bulbs"), F.when(none, 0).otherwise(absent), F.when(none, 0).otherwise(3))


def crosswalks(t: MapTables) -> DataFrame:
    """vm-05-01: crosswalks have polygons of four corners, an element that refers to every one, and let people pass."""
    walks = t.lanelets.where("subtype = 'crosswalk'")
    loose = loose_crosswalks(t).groupBy(MAP).agg(F.count("*").alias("loose"))
    closed = walks.groupBy(MAP).agg(count_if(~F.coalesce(F.lower("pedestrian").isin("yes", "true", "1"), F.lit(False))).alias("closed"))
    poly = t.way.where("type = 'crosswalk_polygon'").join(t.polylines, [MAP, "way_id"], "left")
    flat = poly.groupBy(MAP).agg(count_if(F.coalesce(P.distinct_corners(F.col("pts")) < 4, F.lit(True))).alias("flat"))
    found = _counts(t)
    for part in (loose, closed, flat):
        found = found.join(part, MAP, "left")
    found = found.fillna(0)
    bad = sum((F.when(c, 1).otherwise(0) for c in (F.col("w_crosswalk_polygon") == 0, F.col("r_crosswalk") == 0, F.col("loose") > 0, F.col("closed") > 0, F.col("flat") > 0)), F.lit(0))
    none = F.col("crosswalks") == 0
    status = F.when(none, M.SKIP).when(bad == 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, found, "vm-05-01", status, _tell(n("crosswalks"), " crosswalks; not referred to ", n("loose"), ", without pedestrians ", n("closed"), ", collapsed ", n("flat")), F.when(none, 0).otherwise(bad), F.col("crosswalks"))


def heights(t: MapTables) -> DataFrame:
    """vm-07-04: every node has a height."""
    found = t.node.groupBy(MAP).agg(F.count("*").alias("total"), count_if("ele is null").alias("bad"))
    return verdict(t, found, "vm-07-04", graded("total", "bad"), F.lit("nodes without ele"), F.col("bad"), F.col("total"))


def connector_completeness(t: MapTables) -> DataFrame:
    """vm-07-06: both end cross-sections of every connector occur at another lanelet too (occurrences are counted)."""
    cs = cross_sections(t)
    often = cs.groupBy(MAP, "n1", "n2").agg(F.count("*").alias("times"))
    good = cs.join(often, [MAP, "n1", "n2"]).groupBy(MAP, "rel_id").agg(F.min("times").alias("least"))
    c = t.lanelets.where("turn_direction is not null").join(good, [MAP, "rel_id"], "left")
    found = c.groupBy(MAP).agg(F.count("*").alias("total"), count_if(F.coalesce(F.col("least") < 2, F.lit(True))).alias("bad"))
    return verdict(t, found, "vm-07-06", graded("total", "bad"), F.lit("connectors without neighbour at an end"), F.col("bad"), F.col("total"))


def overlap_items(t: MapTables) -> DataFrame:
    """Road lanelets outside junctions with what the overlap test needs: centre, height, direction, sampled sides."""
    xy = lambda p: F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    r = t.shaped.where("subtype = 'road' and turn_direction is null and intersection_area is null").where((F.size("lp") >= 2) & (F.size("rp") >= 2))
    r = r.withColumns({"ll": P.length(F.col("lp")), "rl": P.length(F.col("rp"))}).where(F.greatest("ll", "rl") >= M.MIN_BOUNDARY)
    every, le, re_ = F.concat("lp", "rp"), P.mean(F.col("lp"), "ele"), P.mean(F.col("rp"), "ele")
    ele = F.when(le.isNotNull() & re_.isNotNull(), (le + re_) / 2).otherwise(F.coalesce(le, re_))
    r = r.select(MAP, "rel_id", "one_way", "ll", "rl", P.mean(every, "x").alias("cx"), P.mean(every, "y").alias("cy"), ele.alias("ele"), P.direction(F.col("lp"), F.col("rp")).alias("dir"), xy("lp").alias("lp"), xy("rp").alias("rp"))
    return r.select(MAP, "rel_id", "one_way", "ll", "rl", "cx", "cy", "ele", "dir", R.sample_count(F.col("lp"), 12).alias("ls"), R.sample_count(F.col("rp"), 12).alias("rs"))


def overlaps(t: MapTables) -> DataFrame:
    """(map_id, a, b, legal): pairs of road lanelets whose two boundaries both coincide, straight or crossed.

    Centres meet on a grid of 5 m with the cells around, a cell of the one against nine of the other; only pairs that are
    near then fetch their sampled sides.
    """
    i = Scratch(t.node.sparkSession, "overlaps").save(overlap_items(t), "items")
    cell = lambda c: F.bround(F.col(c) / M.OVERLAP_GRID).cast("bigint")
    at = i.select(MAP, "rel_id", "cx", "cy", cell("cx").alias("gx"), cell("cy").alias("gy"))
    other = at.select(MAP, "gx", "gy", F.col("rel_id").alias("b"), F.col("cx").alias("bx"), F.col("cy").alias("by"))
    wide = at.withColumn("gx", F.explode(F.sequence(F.col("gx") - 1, F.col("gx") + 1))).withColumn("gy", F.explode(F.sequence(F.col("gy") - 1, F.col("gy") + 1)))
    near = wide.join(other, [MAP, "gx", "gy"]).where("rel_id < b").where(F.hypot(F.col("cx") - F.col("bx"), F.col("cy") - F.col("by")) <= M.OVERLAP_GRID)
    two = i.select(MAP, F.col("rel_id").alias("b"), F.struct(*[c for c in i.columns if c != MAP]).alias("o"))
    met = near.select(MAP, "rel_id", "b").join(i, [MAP, "rel_id"]).join(two, [MAP, "b"])

    def alike(a: str, b: str, la: str, lb: str) -> Column:
        fair = (F.least(la, lb) >= M.MIN_BOUNDARY) & (F.least(la, lb) >= 0.9 * F.greatest(la, lb))
        gap = lambda q: F.array_max(F.zip_with(a, q, P.dist))
        return fair & (F.least(gap(F.col(b)), gap(F.reverse(b))) < M.OVERLAP_TOL)

    met = met.where((alike("ls", "o.ls", "ll", "o.ll") & alike("rs", "o.rs", "rl", "o.rl")) | (alike("ls", "o.rs", "ll", "o.rl") & alike("rs", "o.ls", "rl", "o.ll")))
    apart = F.abs(F.col("ele") - F.col("o.ele")) > M.OVERLAP_ELE
    facing = F.col("dir.x") * F.col("o.dir.x") + F.col("dir.y") * F.col("o.dir.y") < 0
    legal = F.coalesce(apart, F.lit(False)) | F.coalesce(facing, F.lit(False)) | F.coalesce(F.col("one_way") == "no", F.lit(False)) | F.coalesce(F.col("o.one_way") == "no", F.lit(False))
    return met.select(MAP, F.col("rel_id").alias("a"), F.col("o.rel_id").alias("b"), legal.alias("legal"))


def overlapping(t: MapTables) -> DataFrame:
    """vm-07-08: no two road lanelets lie on one strip, unless at other heights, opposed, or two-way."""
    bad = overlaps(t).groupBy(MAP).agg(F.count("*").alias("pairs"), count_if(~F.col("legal")).alias("bad"))
    found = overlap_items(t).groupBy(MAP).agg(F.count("*").alias("items")).join(bad, MAP, "left").fillna(0)
    few = F.col("items") < 2
    status = F.when(few, M.SKIP).when(F.col("bad") == 0, M.PASS).otherwise(M.FAIL)
    return verdict(t, found, "vm-07-08", status, _tell("overlaps against the rule, of ", n("pairs")), F.col("bad"), F.when(few, 0).otherwise(F.col("items")))


CHECKS: dict[str, Callable[[MapTables], DataFrame]] = {
    "vm-01-01": basic_tags, "vm-01-02": boundary_tags, "vm-01-03": line_sharing, "vm-01-04": opposing_sharing, "vm-01-05": smooth_lines,
    "vm-01-16": shoulder_sharing, "vm-01-21": connectivity, "vm-01-24": length_limits, "vm-03-01": area_presence, "vm-03-02": turn_tags,
    "vm-03-03": connector_shape, "vm-03-07": connector_sharing, "vm-03-08": area_range, "vm-03-09": stop_line_range, "vm-03-10": right_of_way,
    "vm-04-01": traffic_lights, "vm-05-01": crosswalks, "vm-07-04": heights, "vm-07-06": connector_completeness, "vm-07-08": overlapping,
}


#: What several checks need: written once before all of them run.
SHARED = ("maps", "polylines", "ends", "sides", "bounds", "owners", "shaped", "boundary_lines")


def check_map(t: MapTables) -> DataFrame:
    """All checks of all maps as one table. The derived tables that several checks read are written once."""
    store = Scratch(t.node.sparkSession, "checks")
    for name in SHARED:
        setattr(t, name, store.save(getattr(t, name), name))
    every = [check(t) for check in CHECKS.values()]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out
