"""Passes that clean a lane-level map: each takes map tables and returns new ones with a table of statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom import model as M
from roadloom.functions import geo as G
from roadloom.functions import polyline as P
from roadloom.functions import resample as R
from roadloom.operators.components import components
from roadloom.operators.map_checks import exempt
from roadloom.operators.maptables import MAP, MapTables, coincident_ways
from roadloom.operators.skew import numbered
from roadloom.storage import Scratch

_SHORT = T.ArrayType(T.IntegerType())


def kept_points(x: np.ndarray, y: np.ndarray, lat: np.ndarray, lon: np.ndarray, angle: float, least: float) -> list[int]:
    """The points that simplification keeps: the ends, and each that bends (below the angle, between its original
    neighbours) and is at least ``least`` metres from the last kept one."""
    n = len(x)
    if n <= 2:
        return list(range(n))
    ux, uy = x[:-2] - x[1:-1], y[:-2] - y[1:-1]
    vx, vy = x[2:] - x[1:-1], y[2:] - y[1:-1]
    norm = np.hypot(ux, uy) * np.hypot(vx, vy)
    cosine = np.divide(ux * vx + uy * vy, norm, out=np.full(n - 2, -1.0), where=norm > 0)
    bends = np.degrees(np.arccos(np.clip(cosine, -1, 1))) < angle
    la, lo = np.radians(lat), np.radians(lon)
    kept = [0]
    for i in (np.flatnonzero(bends) + 1).tolist():
        k = kept[-1]
        h = np.sin((la[i] - la[k]) / 2) ** 2 + np.cos(la[k]) * np.cos(la[i]) * np.sin((lo[i] - lo[k]) / 2) ** 2
        if 2 * M.EARTH_RADIUS * np.arcsin(np.sqrt(h)) >= least:
            kept.append(i)
    return [*kept, n - 1]


def simplified(pts: Column, angle: float = M.DOWNSAMPLE_ANGLE, least: float = M.DOWNSAMPLE_DISTANCE) -> Column:
    """0-based places of the kept points of ``pts`` (x, y, lat, lon); one pass along each polyline."""

    @F.arrow_udf(_SHORT)
    def run(p: pa.Array) -> pa.Array:
        flat = p.flatten()
        cols = [np.asarray(flat.field(c).to_numpy(zero_copy_only=False), float) for c in ("x", "y", "lat", "lon")]
        b = np.r_[0, np.cumsum(np.array(pa.compute.fill_null(pa.compute.list_value_length(p), 0)))]
        return pa.array([kept_points(*(c[s:e] for c in cols), angle, least) for s, e in zip(b[:-1], b[1:])], pa.list_(pa.int32()))

    return run(pts)


def downsample(t: MapTables, angle: float = M.DOWNSAMPLE_ANGLE, least: float = M.DOWNSAMPLE_DISTANCE, share: bool = True, plane: bool = True) -> tuple[MapTables, DataFrame]:
    """Simplifies ways and renumbers their nodes from 1,000,000 in order of first use.

    Nodes keep one new id over all ways (``share``), or get one per way and point. Coordinates become Web Mercator
    metres; without ``plane`` nodes keep lat and lon instead, and the metres only decide. Feature ways keep all points. Ways with fewer than two resolvable refs stay as they are, so their refs no
    longer lead anywhere; the statistics count them. ``t.node`` needs lat and lon.
    """
    x, y = G.web_mercator(F.col("lat"), F.col("lon"))
    nodes = t.node.where("lat is not null and lon is not null").withColumns({"x": x, "y": y, "ele": F.coalesce("ele", F.lit(0.0))})
    pts = F.array_sort(F.collect_list(F.struct("seq", "x", "y", "lat", "lon", "node_id")))
    lines = t.way_node.join(nodes, [MAP, "node_id"]).groupBy(MAP, "way_id").agg(pts.alias("pts")).where(F.size("pts") >= 2).join(t.way.select(MAP, "way_id", "ord", "type"), [MAP, "way_id"])
    whole = F.coalesce(F.col("type").isin(M.FEATURE_WAYS), F.lit(False))
    keep = F.when(whole, F.sequence(F.lit(0), F.size("pts") - 1)).otherwise(simplified(F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["lat"].alias("lat"), p["lon"].alias("lon"))), angle, least))
    kept = lines.select(MAP, "way_id", "ord", F.size("pts").alias("before"), F.posexplode(F.transform(keep, lambda i: F.get("pts", i)["node_id"])).alias("seq", "old"))
    first = [MAP, "old"] if share else [MAP, "way_id", "seq", "old"]
    used = kept.groupBy(*first).agg(F.min(F.struct("ord", "seq")).alias("use"))
    new = numbered(used, MAP, ["use"], "nth").withColumn("node_id", (F.col("nth") + 999_999).cast("string")).drop("use", "nth")
    refs = kept.join(new, first)
    touched = lines.select(MAP, "way_id")
    dead = t.way_node.join(touched, [MAP, "way_id"], "left_anti").select(MAP, "way_id", "seq", F.col("node_id").cast("string").alias("node_id"))
    place = [F.round(c, 4).alias(c) for c in ("x", "y")] if plane else [F.col("lat"), F.col("lon")]
    node = new.join(nodes.withColumnRenamed("node_id", "old"), [MAP, "old"]).select(MAP, "node_id", *place, F.round("ele", 4).alias("ele"))
    way_node = refs.select(MAP, "way_id", "seq", "node_id").unionByName(dead)
    after = new.groupBy(MAP).agg(F.count("*").alias("nodes_after"))
    stats = t.node.groupBy(MAP).agg(F.count("*").alias("nodes_before")).join(after, MAP, "left").join(dead.groupBy(MAP).agg(F.count_distinct("way_id").alias("ways_left_dangling")), MAP, "left").fillna(0)
    return replace(t, node=node, way_node=way_node), stats


def owner_sets(t: MapTables) -> DataFrame:
    """(map_id, way_id, repairable): whether only walkways and road shoulders use a way."""
    sub = t.sides.join(t.lanelets.select(MAP, "rel_id", "subtype"), [MAP, "rel_id"])
    ok = F.coalesce(F.col("subtype").isin(M.REPAIRABLE_OWNERS), F.lit(False))
    return sub.groupBy(MAP, "way_id").agg(F.bool_and(ok).alias("repairable"))


def repair_ends(t: MapTables, limit: float = M.TELEPORT) -> tuple[MapTables, DataFrame]:
    """Drops the first or last point of a pedestrian boundary that lies more than ``limit`` metres from its neighbour.

    Only ways of at least three refs, all resolved, that only walkways and road shoulders use; never below two points.
    """
    at = t.way_node.join(t.node.select(MAP, "node_id", "lat", "lon"), [MAP, "node_id"], "left")
    pts = F.array_sort(F.collect_list(F.struct("seq", "lat", "lon"))).alias("pts")
    ways = at.groupBy(MAP, "way_id").agg(pts).join(owner_sets(t).where("repairable"), [MAP, "way_id"], "left_semi")
    ways = ways.where((F.size("pts") >= 3) & F.forall("pts", lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()))
    end = lambda i: F.try_element_at("pts", F.lit(i))  # noqa: E731  (the test of the size may come after)
    far = lambda a, b: G.haversine(end(a)["lat"], end(a)["lon"], end(b)["lat"], end(b)["lon"], M.EARTH_RADIUS_REPAIR) > limit
    ways = ways.select(MAP, "way_id", F.when(far(1, 2), end(1)["seq"]).alias("head"), F.when(far(-1, -2), end(-1)["seq"]).alias("tail"), F.size("pts").alias("n"))
    ways = ways.withColumn("drop", F.array_compact(F.array("head", "tail"))).where((F.size("drop") > 0) & (F.col("n") - F.size("drop") >= 2))
    gone = ways.select(MAP, "way_id", F.explode("drop").alias("seq"))
    stats = ways.groupBy(MAP).agg(F.count("*").alias("ways_trimmed"), F.sum(F.size("drop")).alias("endpoints_dropped"))
    return replace(t, way_node=t.way_node.join(gone, [MAP, "way_id", "seq"], "left_anti")), stats


def dedup_lanelets(t: MapTables, tags: DataFrame) -> tuple[MapTables, DataFrame]:
    """Keeps the first of lanelets with equal members (a multiset, order ignored) and equal tags, and points every
    member that is a relation to the kept one. ``tags`` has (map_id, rel_id, tags): a map of all tags. Lanelets without
    a way member are left alone."""
    part = F.struct(F.coalesce("mtype", F.lit("")).alias("t"), F.coalesce("role", F.lit("")).alias("r"), F.coalesce(F.col("ref").cast("string"), F.lit("")).alias("f"))
    mem = t.member.groupBy(MAP, "rel_id").agg(F.array_sort(F.collect_list(part)).alias("members"), F.bool_or(F.col("mtype") == "way").alias("real"))
    items = tags.select(MAP, "rel_id", F.array_sort(F.map_entries("tags")).alias("items"))
    ll = t.lanelets.select(MAP, "rel_id", "ord").join(mem.where("real"), [MAP, "rel_id"]).join(items, [MAP, "rel_id"])
    # groups are named by a digest, so the shuffle does not carry the lists; equal digests are equal lanelets
    key = F.sha2(F.to_json(F.struct("members", "items")), 256)
    groups = ll.select(MAP, "rel_id", "ord", key.alias("key"))
    first = groups.groupBy(MAP, "key").agg(F.min_by("rel_id", "ord").alias("keep"), F.count("*").alias("n")).where("n > 1")
    gone = groups.join(first, [MAP, "key"]).where("rel_id <> keep").select(MAP, "rel_id", "keep")
    refs = t.member.join(gone.select(MAP, F.col("rel_id").alias("ref"), "keep", F.lit("relation").alias("mtype")), [MAP, "ref", "mtype"], "left").withColumn("ref", F.coalesce("keep", "ref")).drop("keep")
    stats = first.groupBy(MAP).agg(F.sum(F.col("n") - 1).alias("lanelets_removed"), F.count("*").alias("duplicate_groups"))
    relation = t.relation.join(gone.select(MAP, "rel_id"), [MAP, "rel_id"], "left_anti")
    return replace(t, relation=relation, member=refs.join(gone.select(MAP, "rel_id"), [MAP, "rel_id"], "left_anti").select(*t.member.columns)), stats


def border_rule(t: MapTables) -> DataFrame:
    """(map_id, way_id, rule) of every boundary way with a row: the first rule that leaves it as it is, in this order:
    physical, typed, not_drivable, divider, coincident; or ``border``."""
    twins = coincident_ways(t, strict=False).withColumn("twin", F.lit(True))
    own = t.owners.join(t.way.select(MAP, "way_id", "type"), [MAP, "way_id"]).join(twins, [MAP, "way_id"], "left")
    rule = (
        F.when(F.col("type").isin(M.PHYSICAL_BORDERS), "physical").when(F.col("type").isNotNull() & ~F.col("type").isin(M.PAINTED), "typed").when(~F.col("drivable"), "not_drivable")
        .when((F.col("uses") >= 2) & F.col("all_road"), "divider").when(F.col("twin"), "coincident").otherwise("border")
    )
    return own.select(MAP, "way_id", "type", rule.alias("rule"))


def road_borders(t: MapTables) -> tuple[MapTables, DataFrame]:
    """Makes the edges of the carriageway road borders: type set, lane_change no, subtype dropped.

    ``coincident_skipped`` is the number of ways with a twin, not of those the last rule passed over.
    """
    rules = border_rule(t)
    hit = rules.where("rule = 'border'").select(MAP, "way_id", F.lit(True).alias("hit"))
    way = t.way.join(hit, [MAP, "way_id"], "left")
    on = lambda c, v: F.when(F.col("hit"), v).otherwise(F.col(c))
    way = way.withColumns({"type": on("type", F.lit("road_border")), "lane_change": on("lane_change", F.lit("no")), "subtype": on("subtype", F.lit(None))}).drop("hit")
    stats = rules.groupBy(MAP).agg(F.count_if(F.col("rule") == "border").alias("borders_tagged"), F.count_if((F.col("rule") == "border") & F.col("type").isNull()).alias("borders_added"), F.count_if((F.col("rule") == "border") & F.col("type").isNotNull()).alias("borders_reclassified"))
    twins = coincident_ways(t, strict=False).groupBy(MAP).agg(F.count("*").alias("coincident_skipped"))
    return replace(t, way=way), stats.join(twins, MAP, "left").fillna(0)


def cut_line(node: np.ndarray, x: np.ndarray, y: np.ndarray, fractions: np.ndarray, snap: float = M.SNAP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """A way cut at fractions of its length, as arrays with an item per point of a piece: the piece, the number in it, the
    place in the way of the point or of the one before it, that of the one after it (-1 for a point of the way), and how far
    between them a new one stands. A cut within ``snap`` of a point takes that point. None if that leaves fewer pieces than
    wanted. ``node`` has equal numbers for equal refs.

    All cuts are placed by one sorted search in the lengths along the way; a piece is then its two ends with the points
    between them.
    """
    along = np.r_[0.0, np.cumsum(np.hypot(np.diff(x), np.diff(y)))]
    last = len(along) - 1
    if last < 1 or not along[-1] > 0:
        return None
    at = along[-1] * fractions
    seg = np.minimum(np.searchsorted(along[1:] + 1e-9, at), last - 1)
    before, after = at - along[seg], along[seg + 1] - at
    share = before / np.where(before + after > 0, before + after, 1.0)
    share = np.select([np.abs(before) <= snap, (np.abs(after) <= snap) | (before + after <= 0)], [0.0, 1.0], share)
    # every cut as the points it stands at or between, and the first and last whole point on its two sides
    new = (share > 0) & (share < 1)
    ends = np.r_[0, seg + (share >= 1), last], np.r_[-1, np.where(new, seg + 1, -1), -1], np.r_[-1.0, np.where(new, share, -1.0), -1.0]
    up = np.r_[1, np.where(share < 1, seg + 1, seg + 2)]
    down = np.r_[np.where(share > 0, seg, seg - 1), last - 1]
    size = np.maximum(down - up + 1, 0) + 2
    piece = np.repeat(np.arange(len(size)), size)
    seq = np.arange(len(piece)) - (np.cumsum(size) - size)[piece]
    tail = seq == size[piece] - 1
    whole = ~tail & (seq > 0)
    a, b, t = (np.where(whole, own, e[piece + tail]) for own, e in zip((up[piece] + seq - 1, -1, -1.0), ends))
    na, nb = node[a], np.where(b < 0, -1, node[b])
    keep = np.r_[True, (seq[1:] == 0) | (na[1:] != na[:-1]) | (nb[1:] != nb[:-1]) | (t[1:] != t[:-1])]
    piece, a, b, t = piece[keep], a[keep], b[keep], t[keep]
    size = np.bincount(piece, minlength=len(size))
    return (piece, np.arange(len(piece)) - (np.cumsum(size) - size)[piece], a, b, t) if (size > 1).all() else None


_CUT = "way_id string, ord bigint, component string, ok boolean, piece int, seq int, a string, b string, t double"
#: Rows of pieces that are given on at once: a way with a stray end is cut into thousands.
_CUT_ROWS = 1 << 16
_WHOLE = tuple(np.array([v]) for v in (-1, -1, -1, -1, -1.0))


def _cut_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for df in batches:
        flat = {c: df.column(c).flatten() for c in ("refs", "xs", "ys", "fractions")}
        start, cuts = (np.r_[0, np.cumsum(np.array(pa.compute.list_value_length(df.column(c)), int))] for c in ("refs", "fractions"))
        node = np.array(pa.compute.dictionary_encode(flat["refs"]).indices)
        x, y, fr = (np.asarray(flat[c].to_numpy(zero_copy_only=False), float) for c in ("xs", "ys", "fractions"))
        held: list[tuple[int, tuple[np.ndarray, ...]]] = []
        rows = 0
        for w in range(len(start) - 1):
            own = slice(start[w], start[w + 1])
            held.append((w, cut_line(node[own], x[own], y[own], fr[cuts[w] : cuts[w + 1]]) or _WHOLE))
            rows += len(held[-1][1][0])
            if rows >= _CUT_ROWS or w == len(start) - 2:
                of = np.repeat([k for k, _ in held], [len(p[0]) for _, p in held])
                piece, seq, a, b, t = (np.concatenate(c) for c in zip(*(p for _, p in held)))
                fixed = [df.column(c).take(pa.array(of)) for c in ("map_id", "way_id", "ord", "component")]
                number = [pa.array(v, pa.int32(), mask=piece < 0) for v in (piece, seq)]
                name = [flat["refs"].take(pa.array(start[of] + i, mask=i < 0)) for i in (a, b)]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(piece >= 0), *number, *name, pa.array(t, mask=b < 0)], names=["map_id", *(c.split()[0] for c in _CUT.split(", "))])
                held, rows = [], 0


def decouple(t: MapTables) -> tuple[MapTables, DataFrame]:
    """Gives the carriageway its own copy of every boundary that it shares with a walkway or crosswalk, so that it can be
    cut while theirs stays whole. New ids follow the greatest number among all ids plus one, in document order."""
    sub = t.sides.join(t.lanelets.select(MAP, "rel_id", "subtype"), [MAP, "rel_id"])
    foot = F.coalesce(F.col("subtype").isin(M.PEDESTRIAN), F.lit(False))
    mixed = sub.groupBy(MAP, "way_id").agg(F.bool_or(foot).alias("ped"), F.bool_or(~foot).alias("car")).where("ped and car").select(MAP, "way_id")
    new = mixed.join(t.way.select(MAP, "way_id", "ord"), [MAP, "way_id"]).join(greatest_id(t), MAP)
    new = numbered(new, MAP, ["ord"], "nth").select(MAP, "way_id", (F.col("top") + 1 + F.col("nth")).cast("string").alias("copy"))
    ways = t.way.join(new, [MAP, "way_id"]).withColumn("way_id", F.col("copy")).withColumn("ord", F.lit(1 << 40) + F.col("copy").cast("bigint")).select(*t.way.columns)
    refs = t.way_node.join(new, [MAP, "way_id"]).withColumn("way_id", F.col("copy")).select(*t.way_node.columns)
    cars = sub.where(~foot).select(MAP, "rel_id", "role", F.col("way_id").alias("ref")).join(new.withColumnRenamed("way_id", "ref"), [MAP, "ref"])
    cars = cars.select(MAP, "rel_id", "role", "ref", "copy", F.lit("way").alias("mtype"))
    member = t.member.join(cars, [MAP, "rel_id", "role", "ref", "mtype"], "left").withColumn("ref", F.coalesce("copy", "ref")).select(*t.member.columns)
    return replace(t, way=t.way.unionByName(ways), way_node=t.way_node.unionByName(refs), member=member), new.groupBy(MAP).agg(F.count("*").alias("boundaries_decoupled"))


def greatest_id(t: MapTables) -> DataFrame:
    """(map_id, top): the greatest whole number among all ids of a map, at least 0."""
    every = t.node.select(MAP, F.col("node_id").alias("id")).union(t.way.select(MAP, F.col("way_id").alias("id"))).union(t.relation.select(MAP, F.col("rel_id").alias("id")))
    return every.groupBy(MAP).agg(F.coalesce(F.max(F.col("id").try_cast("bigint")), F.lit(0)).alias("top"))


def cut_groups(t: MapTables) -> DataFrame:
    """(map_id, way_id, component, fractions): the ways to cut. The ways of a component, joined by the lanelets between
    them, are cut at one set of fractions of their own lengths, by the greatest demand of any of them at each of 400
    samples. Components with an exempt lanelet are not cut."""
    ll = exempt(t)
    pairs = ll.where("left is not null and right is not null")
    name = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    groups = components(pairs.select(MAP, name("left").alias("a"), name("right").alias("b")), MAP, "a", "b")
    use = ll.select(MAP, "exempt", F.explode(F.array("left", "right")).alias("way_id")).where("way_id is not null").withColumn("node", name("way_id")).join(groups, [MAP, "node"], "left")
    blocked = use.withColumn("component", F.coalesce("component", "node")).groupBy(MAP, "component").agg(F.bool_or("exempt").alias("blocked"))
    ways = use.where("component is not null").select(MAP, "way_id", "component").distinct().join(blocked.where("not blocked"), [MAP, "component"], "left_semi")
    xy = F.transform("pts", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    lines = ways.join(t.polylines, [MAP, "way_id"]).select(MAP, "component", R.demand(xy).alias("d"))
    # runs of samples, not samples: a component has no more of them than pairs of samples
    worst = lines.select(MAP, "component", F.explode("d").alias("r")).groupBy(MAP, "component", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi")).agg(F.max("r.v").alias("v"))
    worst = worst.groupBy(MAP, "component").agg(F.collect_list(F.struct("lo", "hi", "v")).alias("d"))
    return ways.join(worst.select(MAP, "component", R.fractions(F.col("d")).alias("fractions")).where(F.size("fractions") > 0), [MAP, "component"])


def split_lanelets(t: MapTables) -> tuple[MapTables, DataFrame]:
    """Cuts over-long lanelets into pieces within their limits, keeping shared boundaries and end nodes shared.

    Boundaries shared with pedestrians are decoupled first. A component of which any way cannot be cut as wanted stays
    whole, so no relation is left with a removed way. Pieces follow the right boundary's direction; a speed limit goes
    to every piece, other regulatory elements to the last; right-of-way members then point to the last piece.
    """
    store = Scratch(t.node.sparkSession, "split")
    t, decoupled = decouple(t)
    t, decoupled = t.saved(store, "decoupled"), store.save(decoupled, "decoupled")
    way = t.way.withColumn("way_id", F.col("way_id").cast("string"))
    groups = cut_groups(t)
    lines = groups.join(t.polylines, [MAP, "way_id"]).join(t.way.select(MAP, "way_id", "ord"), [MAP, "way_id"])
    args = lines.select(MAP, F.col("way_id").cast("string").alias("way_id"), "ord", "component", F.transform("pts", lambda p: p["node_id"].cast("string")).alias("refs"), F.transform("pts", lambda p: p["x"]).alias("xs"), F.transform("pts", lambda p: p["y"]).alias("ys"), "fractions")
    cut = store.save(args.mapInArrow(_cut_ways, f"map_id {args.schema[MAP].dataType.simpleString()}, {_CUT}"), "cut")
    failed = cut.where("not ok").select(MAP, "component").distinct()
    cut = cut.where("ok").join(failed, [MAP, "component"], "left_anti")
    top = greatest_id(t)
    fresh = cut.where("b is not null").select(MAP, "a", "b", "t", "ord", "piece", "seq").groupBy(MAP, "a", "b", "t").agg(F.min(F.struct("ord", "piece", "seq")).alias("use")).join(top, MAP)
    fresh = numbered(fresh, MAP, ["use"], "nth").withColumn("node_id", (F.col("top") + 1 + F.col("nth")).cast("string"))
    fresh = store.save(fresh.drop("use", "nth"), "fresh")
    ends = t.node.select(MAP, F.col("node_id").cast("string").alias("k"), "x", "y", "ele")
    made = fresh.join(ends.toDF(MAP, "a", "ax", "ay", "ae"), [MAP, "a"]).join(ends.toDF(MAP, "b", "bx", "by", "be"), [MAP, "b"])
    lerp = lambda p, q: F.round(F.col(p) + F.col("t") * (F.col(q) - F.col(p)), 7)
    made = made.select(MAP, "node_id", lerp("ax", "bx").alias("x"), lerp("ay", "by").alias("y"), lerp("ae", "be").alias("ele"))
    count = fresh.groupBy(MAP).agg(F.count("*").alias("made"))
    parts = cut.select(MAP, "way_id", "ord", "piece", "component").distinct().join(top, MAP).join(count, MAP, "left").fillna(0, ["made"])
    parts = numbered(parts, MAP, ["ord", "piece"], "nth")
    parts = store.save(parts.withColumn("new_way", (F.col("top") + 1 + F.col("made") + F.col("nth")).cast("string")).drop("nth"), "parts")
    refs = cut.join(parts.select(MAP, "way_id", "piece", "new_way"), [MAP, "way_id", "piece"]).join(fresh.select(MAP, "a", "b", "t", "node_id"), [MAP, "a", "b", "t"], "left")
    refs = refs.select(MAP, F.col("new_way").alias("way_id"), "seq", F.coalesce("node_id", "a").alias("node_id"))
    seqs = parts.groupBy(MAP, "way_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("piece", "new_way"))), lambda s: s["new_way"]).alias("pieces"))
    old = t.polylines.withColumn("way_id", F.col("way_id").cast("string")).join(seqs, [MAP, "way_id"])
    end = lambda p, i: F.struct(F.element_at(p, i)["x"].alias("x"), F.element_at(p, i)["y"].alias("y"))
    old = old.select(MAP, "way_id", "pieces", end("pts", 1).alias("p0"), end("pts", -1).alias("p1"))
    ll = t.bounds.select(MAP, "rel_id", F.col("left").cast("string").alias("left"), F.col("right").cast("string").alias("right"))
    ll = ll.join(old.toDF(MAP, "left", "lp", "l0", "l1"), [MAP, "left"]).join(old.toDF(MAP, "right", "rp", "r0", "r1"), [MAP, "right"]).where(F.size("lp") == F.size("rp"))
    ll = ll.withColumn("lp", F.when(P.dist(F.col("l0"), F.col("r0")) <= P.dist(F.col("l1"), F.col("r0")), F.col("lp")).otherwise(F.reverse("lp")))
    ll = ll.select(MAP, "rel_id", F.size("rp").alias("k"), F.posexplode(F.arrays_zip("lp", "rp")).alias("piece", "w")).join(t.lanelets.select(MAP, "rel_id", "ord"), [MAP, "rel_id"])
    ways_made = parts.groupBy(MAP).agg(F.count("*").alias("ways_made"))
    ll = ll.join(top, MAP).join(count, MAP, "left").join(ways_made, MAP, "left").fillna(0, ["made", "ways_made"])
    ll = numbered(ll, MAP, ["ord", "piece"], "nth").withColumn("new_rel", (F.col("top") + 1 + F.col("made") + F.col("ways_made") + F.col("nth")).cast("string"))
    pieces = store.save(ll.select(MAP, "rel_id", "piece", "k", "new_rel", "w"), "pieces")
    split = pieces.select(MAP, "rel_id").distinct()
    both = pieces.select(MAP, F.col("new_rel").alias("rel_id"), F.explode(F.array(F.struct(F.lit(0).alias("seq"), F.lit("right").alias("role"), F.col("w.rp").alias("ref")), F.struct(F.lit(1).alias("seq"), F.lit("left").alias("role"), F.col("w.lp").alias("ref")))).alias("m"))
    both = both.select(MAP, "rel_id", "m.seq", F.lit("way").alias("mtype"), "m.ref", "m.role")
    regs = t.member.where("role = 'regulatory_element'").select(MAP, "rel_id", F.col("ref").cast("string").alias("ref"), "mtype", "role").join(pieces, [MAP, "rel_id"]).join(t.regelems.select(MAP, F.col("rel_id").cast("string").alias("ref"), F.col("subtype").alias("kind")), [MAP, "ref"], "left")
    regs = regs.where("kind = 'speed_limit' or piece = k - 1").select(MAP, F.col("new_rel").alias("rel_id"), F.lit(2).alias("seq"), "mtype", "ref", "role")
    last = pieces.where("piece = k - 1").select(MAP, F.col("rel_id").cast("string").alias("ref"), F.col("new_rel").alias("to"))
    rows = t.regelems.where("subtype = 'right_of_way'").select(MAP, "rel_id", F.lit(True).alias("row"))
    kept = t.member.join(split, [MAP, "rel_id"], "left_anti").join(rows, [MAP, "rel_id"], "left").withColumn("ref", F.col("ref").cast("string")).join(last, [MAP, "ref"], "left")
    swap = F.col("row") & F.col("role").isin("yield", "right_of_way") & F.col("to").isNotNull()
    as_text = lambda df, *cs: df.withColumns({c: F.col(c).cast("string") for c in cs})
    kept = kept.withColumn("ref", F.when(swap, F.col("to")).otherwise(F.col("ref"))).select(MAP, F.col("rel_id").cast("string").alias("rel_id"), F.row_number().over(Window.partitionBy(MAP, "rel_id").orderBy("seq")).alias("seq"), "mtype", "ref", "role")
    member = kept.unionByName(both).unionByName(regs)
    relation = as_text(t.relation.join(split, [MAP, "rel_id"], "left_anti"), "rel_id").unionByName(t.relation.join(pieces.select(MAP, "rel_id", "new_rel"), [MAP, "rel_id"]).withColumn("rel_id", F.col("new_rel")).select(*t.relation.columns))
    gone = seqs.select(MAP, "way_id")
    new_ways = way.join(parts.select(MAP, "way_id", "new_way"), [MAP, "way_id"]).withColumn("way_id", F.col("new_way")).select(*way.columns)
    way_node = as_text(t.way_node, "way_id", "node_id").join(gone, [MAP, "way_id"], "left_anti").select(MAP, "way_id", "seq", "node_id").unionByName(refs)
    node = as_text(t.node.select(MAP, "node_id", "x", "y", "ele"), "node_id").unionByName(made)
    stats = split.groupBy(MAP).agg(F.count("*").alias("lanelets_split")).join(pieces.groupBy(MAP).agg(F.count("*").alias("pieces_created")), MAP, "full").join(gone.groupBy(MAP).agg(F.count("*").alias("ways_cut")), MAP, "full").join(decoupled, MAP, "full").fillna(0)
    return MapTables(node, way.join(gone, [MAP, "way_id"], "left_anti").unionByName(new_ways), way_node, relation, member), stats
