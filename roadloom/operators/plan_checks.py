"""The eleven structural checks of a plan-view map, one row per map each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions.geo import crs_is_valid
from roadloom.functions.planview import end_point
from roadloom.sources.xodr_xml import PlanTables

MAP = "map_id"
ROAD = [MAP, "road_id", "road_ord"]


def _row(t: PlanTables, found: DataFrame, req: str, status: Column, detail: Column | str, bad: Column, total: Column) -> DataFrame:
    rows = t.file.select(MAP, "root").join(found, MAP, "left").fillna(0)
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return rows.select(MAP, F.lit(req).alias("req_id"), F.lit(M.CHECK_NAMES[req]).alias("name"), status.alias("status"), F.coalesce(detail, F.lit("")).alias("detail"), bad.cast("bigint").alias("offenders"), total.cast("bigint").alias("total"))


def _verdict(bad: Column | None = None) -> Column:
    return F.when((F.col("bad") if bad is None else bad) == 0, M.PASS).otherwise(M.FAIL)


def preview(bad: Column, what: Column, ord_: str = "ord") -> Column:
    """The first five offenders in document order, as text."""
    hits = F.array_sort(F.collect_list(F.when(bad, F.struct(F.col(ord_).cast("bigint").alias("o"), what.alias("w")))))
    return F.concat_ws(", ", F.transform(F.slice(hits, 1, 5), lambda h: h["w"]))


def check_header(t: PlanTables) -> DataFrame:
    first = t.header.groupBy(MAP).agg(F.min_by(F.struct("revMajor", "revMinor"), "ord").alias("h"))
    status = F.when((F.coalesce("root", F.lit("")) == "OpenDRIVE") & F.coalesce(F.col("h.revMajor") == "1", F.lit(False)) & F.col("h.revMinor").isNotNull(), M.PASS).otherwise(M.FAIL)
    return _row(t, first, "xodr-01", status, F.concat(F.lit("revision "), F.coalesce("h.revMajor", F.lit("-")), F.lit("."), F.coalesce("h.revMinor", F.lit("-"))), F.lit(0), F.lit(0))


def check_georeference(t: PlanTables) -> DataFrame:
    first = t.georef.groupBy(MAP).agg(F.min_by("text", "ord").alias("text"))
    none = F.coalesce("text", F.lit("")) == ""
    status = F.when(none, M.SKIP).when(F.col("text").contains("CDATA") | ~crs_is_valid(F.col("text")), M.FAIL).otherwise(M.PASS)
    return _row(t, first, "xodr-02", status, F.substring("text", 1, 70), F.lit(0), F.lit(0))


def check_road_ids(t: PlanTables) -> DataFrame:
    per = t.road.groupBy(MAP, "road_id").agg(F.count("*").alias("n"), F.min("ord").alias("ord"))
    found = per.groupBy(MAP).agg(F.count_if(F.col("n") > 1).alias("bad"), F.sum("n").alias("total"), preview(F.col("n") > 1, F.col("road_id")).alias("first"))
    return _row(t, found, "xodr-03", _verdict(), F.col("first"), F.col("bad"), F.col("total"))


def road_geometry_faults(t: PlanTables) -> DataFrame:
    """(map_id, road_id, ord, bad): whether a road's plan view breaks any rule: present, positive lengths, ascending s,
    lengths that add up, and complete poses."""
    order = Window.partitionBy(*ROAD).orderBy("ord")
    g = t.geometry.withColumns({"back": F.col("s") < F.lag("s").over(order), "last": F.row_number().over(order.orderBy(F.desc("ord"))) == 1})
    gap = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    g = g.groupBy(*ROAD).agg(
        gap(F.col("s").isNull() | F.col("length").isNull() | (F.col("length") <= 0)).alias("broken"), gap(F.col("back")).alias("back"), F.sum("length").alias("sum"),
        F.max(F.when(F.col("last"), F.col("s") + F.col("length"))).alias("end"), gap(F.col("x").isNull() | F.col("y").isNull() | F.col("hdg").isNull()).alias("loose"),
    )
    r = t.road.withColumn("road_ord", F.col("ord").cast("string")).join(g, ROAD, "left")
    off = lambda c: F.abs(F.col(c) - F.col("r_len")) > M.LENGTH_SUM_TOL
    r = r.withColumnRenamed("length", "r_len")
    bad = F.col("broken").isNull() | F.col("r_len").isNull() | (F.col("r_len") <= 0) | F.col("broken") | F.col("back") | off("sum") | off("end") | F.col("loose")
    return r.select(MAP, "road_id", "ord", F.coalesce(bad, F.lit(True)).alias("bad"))


def _per_road(t: PlanTables, faults: DataFrame, req: str) -> DataFrame:
    found = faults.groupBy(MAP).agg(F.count("*").alias("total"), F.count_if("bad").alias("bad"), preview(F.col("bad"), F.col("road_id")).alias("first"))
    return _row(t, found, req, _verdict(), F.col("first"), F.col("bad"), F.col("total"))


def check_planview(t: PlanTables) -> DataFrame:
    return _per_road(t, road_geometry_faults(t), "xodr-04")


def geometry_gaps(t: PlanTables) -> DataFrame:
    """(map_id, road_id, ord, known, gap): between each primitive's end and the next one's start in document order."""
    order = Window.partitionBy(*ROAD).orderBy("ord")
    g = t.geometry.withColumn("end", end_point()).withColumns({"nx": F.lead("x").over(order), "ny": F.lead("y").over(order), "more": F.lead("ord").over(order)})
    return g.where("more is not null").select(MAP, "road_id", "ord", F.col("end").isNotNull().alias("known"), F.hypot(F.col("end.x") - F.col("nx"), F.col("end.y") - F.col("ny")).alias("gap"))


def check_continuity(t: PlanTables) -> DataFrame:
    bad = F.coalesce(F.col("gap") > M.CONTINUITY_TOL, F.lit(False))
    found = geometry_gaps(t).groupBy(MAP).agg(F.count("*").alias("total"), F.count_if(bad).alias("bad"), F.count_if(~F.col("known")).alias("unknown"), F.max("gap").alias("worst"))
    status = F.when((F.col("unknown") > 0) & (F.col("bad") == 0), M.SKIP).otherwise(_verdict())
    total = F.when(status == M.SKIP, 0).otherwise(F.col("total"))
    return _row(t, found, "xodr-05", status, F.concat(F.lit("worst gap "), F.round("worst", 4).cast("string")), F.col("bad"), total)


def lane_faults(t: PlanTables) -> DataFrame:
    """(map_id, road_id, ord, faults): per road the broken lane rules: one for a bad centre lane or bad lane ids, which
    end the road's test, or one per section with a lane of bad widths."""
    lane = t.lane.withColumn("n", F.col("lane_id").try_cast("int"))
    ids = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, F.abs("n") if side == "right" else F.col("n"))))
    wrong = F.bool_or(((F.col("side") == "right") & (F.col("n") >= 0)) | (F.col("side").isin("left", "right") & F.col("n").isNull()))
    s = lane.groupBy(*ROAD, "section").agg(ids("left").alias("left"), ids("right").alias("right"), F.count_if(F.col("side") == "center").alias("centres"), F.max(F.when(F.col("side") == "center", F.col("lane_id"))).alias("centre"), F.coalesce(wrong, F.lit(False)).alias("wrong"))
    run = lambda c: F.when(F.size(c) > 0, F.col(c) == F.sequence(F.lit(1), F.size(c))).otherwise(F.lit(True))
    s = t.section.select(*ROAD, F.col("ord").cast("string").alias("section")).join(s, [*ROAD, "section"], "left")
    fault = F.when((F.coalesce("centres", F.lit(0)) != 1) | (F.coalesce("centre", F.lit("")) != "0"), "centre lane").when(F.col("wrong") | ~run("left") | ~run("right"), "lane ids").when((F.size("left") == 0) & (F.size("right") == 0), "no lanes")
    s = s.withColumn("fault", fault)
    order = Window.partitionBy(*ROAD, "lane_ord").orderBy("ord")
    w = t.width.where(F.col("side").isin("left", "right")).withColumns({"before": F.lag("s_offset").over(order), "nth": F.row_number().over(order)})
    w = w.join(t.road.select(MAP, "road_id", F.col("ord").cast("string").alias("road_ord"), F.col("length").alias("road_len")), ROAD)
    low = F.col("a").isNull() | (F.col("a") < 0)
    off = ((F.col("nth") == 1) & (F.coalesce("s_offset", F.lit(-1.0)) != 0)) | F.coalesce(F.col("s_offset") <= F.col("before"), F.lit(False))
    last = F.max_by("s_offset", "ord") >= F.max("road_len") + 1e-6
    w = w.groupBy(*ROAD, "section", "lane_ord").agg((F.bool_or(low | off) | F.coalesce(last, F.lit(False))).alias("bad"))
    lanes = lane.where(F.col("side").isin("left", "right")).select(*ROAD, "section", F.col("ord").cast("string").alias("lane_ord")).join(w, [*ROAD, "section", "lane_ord"], "left")
    wide = lanes.groupBy(*ROAD, "section").agg(F.bool_or(F.coalesce("bad", F.lit(True))).alias("narrow"))
    s = s.join(wide, [*ROAD, "section"], "left")
    # a structural fault ends the road's test: sections after it are not looked at
    ended = F.min(F.when(F.col("fault").isNotNull(), F.col("section").cast("bigint"))).over(Window.partitionBy(*ROAD))
    s = s.withColumn("ended", ended).where("ended is null or cast(section as bigint) <= ended")
    per = s.groupBy(*ROAD).agg(F.count_if(F.col("fault").isNotNull() | F.coalesce("narrow", F.lit(False))).alias("faults"))
    r = t.road.select(MAP, "road_id", "ord", F.col("ord").cast("string").alias("road_ord")).join(per, ROAD, "left")
    return r.select(MAP, "road_id", "ord", F.coalesce("faults", F.lit(1)).alias("faults"))


def check_lanes(t: PlanTables) -> DataFrame:
    found = lane_faults(t).groupBy(MAP).agg(F.count("*").alias("total"), F.sum("faults").alias("bad"), preview(F.col("faults") > 0, F.col("road_id")).alias("first"))
    return _row(t, found, "xodr-06", _verdict(), F.col("first"), F.col("bad"), F.col("total"))


def road_link_faults(links: DataFrame, roads: DataFrame, junctions: DataFrame) -> DataFrame:
    """Road links with ``bad``: the target, a road or junction by the link's type, does not exist."""
    known = roads.select(MAP, F.lit("road").alias("element_type"), F.col("road_id").alias("element_id")).union(junctions.select(MAP, F.lit("junction").alias("element_type"), F.col("junction_id").alias("element_id")))
    known = known.distinct().withColumn("there", F.lit(True))
    return links.join(known, [MAP, "element_type", "element_id"], "left").withColumn("bad", F.col("there").isNull()).drop("there")


def check_road_links(t: PlanTables) -> DataFrame:
    found = road_link_faults(t.road_link, t.road, t.junction).groupBy(MAP).agg(F.count("*").alias("total"), F.count_if("bad").alias("bad"), preview(F.col("bad"), F.col("road_id")).alias("first"))
    return _row(t, found, "xodr-07", _verdict(), F.col("first"), F.col("bad"), F.col("total"))


def lane_link_faults(t: PlanTables) -> DataFrame:
    """Lane links with ``bad``: the road is linked in that direction to an existing road, which has no such lane. Links of
    lanes that a later lane of the same id replaces are left out."""
    kept = t.lanes_of_road.select(MAP, "road_id", "lane_id", F.col("ord").cast("string").alias("lane_ord"))
    links = t.lane_link.join(kept, [MAP, "road_id", "lane_id", "lane_ord"], "left_semi")
    to = t.road_link.where("element_type = 'road'").groupBy(MAP, "road_id", "direction").agg(F.max_by("element_id", "ord").alias("to_road"))
    there = t.road.select(MAP, F.col("road_id").alias("to_road")).distinct().withColumn("road_there", F.lit(True))
    lanes = t.lanes_of_road.select(MAP, F.col("road_id").alias("to_road"), F.col("lane_id").alias("target")).withColumn("lane_there", F.lit(True))
    links = links.join(to, [MAP, "road_id", "direction"], "left").join(there, [MAP, "to_road"], "left").join(lanes, [MAP, "to_road", "target"], "left")
    return links.withColumn("bad", F.col("road_there").isNotNull() & F.col("lane_there").isNull())


def check_lane_links(t: PlanTables) -> DataFrame:
    found = lane_link_faults(t).groupBy(MAP).agg(F.count("*").alias("total"), F.count_if("bad").alias("bad"), preview(F.col("bad"), F.col("road_id")).alias("first"))
    return _row(t, found, "xodr-08", _verdict(), F.col("first"), F.col("bad"), F.col("total"))


def connection_roads(connection: DataFrame, road: DataFrame) -> DataFrame:
    """Connections with ``fault``: a road is missing, or the connecting road belongs to another junction. ``road`` has one
    row per id."""
    c = connection.join(road.select(MAP, F.col("road_id").alias("incoming_road"), F.lit(True).alias("in_there")), [MAP, "incoming_road"], "left")
    c = c.join(road.select(MAP, F.col("road_id").alias("connecting_road"), F.lit(True).alias("con_there"), F.col("junction").alias("con_junction")), [MAP, "connecting_road"], "left")
    fault = F.when(F.col("in_there").isNull() | F.col("con_there").isNull(), "road missing").when(~F.col("con_junction").eqNullSafe(F.col("junction_id")), "wrong junction")
    return c.withColumn("fault", fault).drop("in_there", "con_there", "con_junction")


def connection_faults(t: PlanTables) -> DataFrame:
    """Connections with ``fault``: those of ``connection_roads``, or a lane link names a lane that is not there; the first
    that holds."""
    c = connection_roads(t.connection, t.road.groupBy(MAP, "road_id").agg(F.max_by("junction", "ord").alias("junction")))
    lanes = t.lanes_of_road.select(MAP, "road_id", "lane_id").withColumn("ok", F.lit(True))
    ll = t.junction_lane_link.join(t.connection.select(MAP, F.col("ord").cast("string").alias("connection_ord"), "incoming_road", "connecting_road"), [MAP, "connection_ord"])
    ll = ll.join(lanes.toDF(MAP, "incoming_road", "from_lane", "f_ok"), [MAP, "incoming_road", "from_lane"], "left").join(lanes.toDF(MAP, "connecting_road", "to_lane", "t_ok"), [MAP, "connecting_road", "to_lane"], "left")
    loose = ll.groupBy(MAP, "connection_ord").agg(F.bool_or(F.col("f_ok").isNull() | F.col("t_ok").isNull()).alias("loose"))
    c = c.withColumn("connection_ord", F.col("ord").cast("string")).join(loose, [MAP, "connection_ord"], "left")
    return c.withColumn("fault", F.coalesce("fault", F.when(F.col("loose"), "lane link")))


def check_junctions(t: PlanTables) -> DataFrame:
    c = connection_faults(t).groupBy(MAP).agg(F.count("*").alias("total"), F.count_if(F.col("fault").isNotNull()).alias("bad"))
    empty = t.junction.join(t.connection.select(MAP, F.col("junction_ord").cast("bigint").alias("ord")).distinct(), [MAP, "ord"], "left_anti").groupBy(MAP).agg(F.count("*").alias("empty"))
    found = t.junction.groupBy(MAP).agg(F.count("*").alias("any")).join(c, MAP, "left").join(empty, MAP, "left").fillna(0).withColumn("bad", F.col("bad") + F.col("empty"))
    status = F.when(F.col("any") == 0, M.SKIP).otherwise(_verdict())
    return _row(t, found, "xodr-09", status, F.concat(F.lit("junctions without connection "), F.col("empty").cast("string")), F.col("bad"), F.col("total"))


def unreferenced_roads(roads: DataFrame, connections: DataFrame) -> DataFrame:
    """Roads of a junction with ``bad``: no connection of that junction has them as connecting road."""
    told = connections.select(MAP, F.col("junction_id").alias("junction"), F.col("connecting_road").alias("road_id")).distinct().withColumn("told", F.lit(True))
    return roads.where("junction is not null and junction <> '-1'").join(told, [MAP, "junction", "road_id"], "left").withColumn("bad", F.col("told").isNull()).drop("told")


def check_referenced(t: PlanTables) -> DataFrame:
    found = unreferenced_roads(t.road, t.connection).groupBy(MAP).agg(F.count("*").alias("total"), F.count_if("bad").alias("bad"), preview(F.col("bad"), F.col("road_id")).alias("first"))
    return _row(t, found, "xodr-10", F.when(F.col("total") == 0, M.SKIP).otherwise(_verdict()), F.col("first"), F.col("bad"), F.col("total"))


def check_numbers(t: PlanTables) -> DataFrame:
    found = t.file.select(MAP, F.col("numbers").alias("total"), F.col("unfinite").alias("bad"))
    return _row(t, found, "xodr-11", _verdict(), "", F.col("bad"), F.col("total"))


CHECKS: dict[str, Callable[[PlanTables], DataFrame]] = {
    "xodr-01": check_header, "xodr-02": check_georeference, "xodr-03": check_road_ids, "xodr-04": check_planview, "xodr-05": check_continuity, "xodr-06": check_lanes,
    "xodr-07": check_road_links, "xodr-08": check_lane_links, "xodr-09": check_junctions, "xodr-10": check_referenced, "xodr-11": check_numbers,
}


def check_plan(t: PlanTables) -> DataFrame:
    """All structural checks of all maps as one table."""
    every = [check(t) for check in CHECKS.values()]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out
