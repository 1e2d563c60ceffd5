"""Lane-level maps as tables, and what is derived from them: polylines, lanelet boundaries, owners, end nodes.

Tables and their columns (ids of any one type; extra columns are kept or ignored):

    node      map_id, node_id, x, y, ele
    way       map_id, way_id, ord, type, subtype, lane_change
    way_node  map_id, way_id, seq, node_id
    relation  map_id, rel_id, ord, type, subtype, location, one_way, speed_limit, turn_direction, intersection_area,
              pedestrian
    member    map_id, rel_id, seq, mtype, ref, role
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import polyline as P
from roadloom.storage import Scratch

MAP = "map_id"


def last_wins(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One value per key: the last by order."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def pivot_tags(tags: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Rows of k and v into one column per wanted name; a repeated key takes its last value."""
    picks = [F.max_by(F.when(F.col("k") == n, F.col("v")), F.when(F.col("k") == n, F.col("ord"))).alias(n) for n in names]
    return tags.groupBy(*keys).agg(*picks)


def node_xy(local_x: Column, local_y: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Coordinates of a node: each local tag where present, else the degree; both 0 if either is unreadable."""
    from roadloom.operators.keys import read_decimal

    x = F.when(local_x.isNotNull(), read_decimal(local_x)).otherwise(lon)
    y = F.when(local_y.isNotNull(), read_decimal(local_y)).otherwise(lat)
    ok = x.isNotNull() & y.isNotNull()
    return F.when(ok, x).otherwise(F.lit(0.0)), F.when(ok, y).otherwise(F.lit(0.0))


def node_xy_strict(local_x: Column, local_y: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Both local tags, or else both degrees, or an error."""
    from roadloom.operators.keys import read_decimal

    local = local_x.isNotNull() & local_y.isNotNull()
    bad = F.raise_error(F.lit("a node has neither local nor geographic coordinates")).cast("double")
    pick = lambda a, b: F.coalesce(F.when(local, read_decimal(a)).otherwise(b), bad)
    return pick(local_x, lon), pick(local_y, lat)


def node_xy_optional(local_x: Column, local_y: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Both local tags, or else both degrees, or null: such nodes are to be left out."""
    from roadloom.operators.keys import read_decimal

    local = local_x.isNotNull() & local_y.isNotNull()
    x, y = F.when(local, read_decimal(local_x)).otherwise(lon), F.when(local, read_decimal(local_y)).otherwise(lat)
    ok = x.isNotNull() & y.isNotNull()
    return F.when(ok, x), F.when(ok, y)


@dataclass
class MapTables:
    node: DataFrame
    way: DataFrame
    way_node: DataFrame
    relation: DataFrame
    member: DataFrame

    def saved(self, store: Scratch, name: str) -> MapTables:
        """The same tables written to the shared folder, so that what follows starts from files.

        Never a broadcast: Spark estimates them by their files, which encoding makes ten times smaller than the rows."""
        return MapTables(*[store.save(getattr(self, f.name), f"{name}-{f.name}").hint("merge") for f in fields(self)])

    @cached_property
    def maps(self) -> DataFrame:
        return self.node.select(MAP).union(self.way.select(MAP)).union(self.relation.select(MAP)).distinct()

    @cached_property
    def polylines(self) -> DataFrame:
        """(map_id, way_id, pts): refs in order with their nodes' places; refs without node are dropped.

        Never a broadcast: Spark estimates the refs by the ways' file, before each way becomes a row per ref."""
        at = self.way_node.hint("merge").join(self.node.select(MAP, "node_id", "x", "y", "ele"), [MAP, "node_id"])
        pts = F.array_sort(F.collect_list(F.struct("seq", "x", "y", "ele", "node_id"))).alias("pts")
        return at.groupBy(MAP, "way_id").agg(pts)

    @cached_property
    def ends(self) -> DataFrame:
        """(map_id, way_id, refs, head, tail): the number of refs and the first and last one, resolved or not."""
        return self.way_node.groupBy(MAP, "way_id").agg(F.count("*").alias("refs"), F.min_by("node_id", "seq").alias("head"), F.max_by("node_id", "seq").alias("tail"))

    @cached_property
    def lanelets(self) -> DataFrame:
        return self.relation.where(F.col("type") == "lanelet")

    @cached_property
    def regelems(self) -> DataFrame:
        return self.relation.where(F.col("type") == "regulatory_element")

    @cached_property
    def sides(self) -> DataFrame:
        """(map_id, rel_id, role, way_id): the boundary ways of lanelets, one per side; the last of a side counts."""
        rows = self.member.where((F.col("mtype") == "way") & F.col("role").isin("left", "right")).join(self.lanelets.select(MAP, "rel_id"), [MAP, "rel_id"])
        return last_wins(rows, [MAP, "rel_id", "role"], "ref", "seq").withColumnRenamed("ref", "way_id")

    @cached_property
    def bounds(self) -> DataFrame:
        """(map_id, rel_id, left, right)."""
        pick = lambda s: F.max(F.when(F.col("role") == s, F.col("way_id"))).alias(s)
        return self.sides.groupBy(MAP, "rel_id").agg(pick("left"), pick("right"))

    @cached_property
    def owners(self) -> DataFrame:
        """(map_id, way_id, subtypes, uses, all_road, drivable): who refers to a boundary way. A null subtype counts."""
        sub = self.sides.join(self.lanelets.select(MAP, "rel_id", "subtype"), [MAP, "rel_id"])
        name = F.coalesce("subtype", F.lit(""))
        return sub.groupBy(MAP, "way_id").agg(
            F.sort_array(F.collect_list(name)).alias("subtypes"), F.count("*").alias("uses"), F.bool_and(name == "road").alias("all_road"), F.bool_or(name.isin(M.DRIVABLE)).alias("drivable")
        )

    @cached_property
    def shaped(self) -> DataFrame:
        """Lanelets with ``left``, ``right`` (way ids) and ``lp``, ``rp`` (polylines, empty where unresolved)."""
        poly = lambda s, p: self.polylines.select(MAP, F.col("way_id").alias(s), F.col("pts").alias(p))
        both = self.lanelets.join(self.bounds, [MAP, "rel_id"], "left").join(poly("left", "lp"), [MAP, "left"], "left").join(poly("right", "rp"), [MAP, "right"], "left")
        none = F.slice(F.coalesce("lp", "rp"), F.lit(1), F.lit(0))
        return both.withColumns({"lp": F.coalesce("lp", none), "rp": F.coalesce("rp", none)})

    @cached_property
    def boundary_lines(self) -> DataFrame:
        """(map_id, way_id, pts, len): boundary ways of at least two points and one metre."""
        used = self.sides.select(MAP, "way_id").distinct()
        line = self.polylines.join(used, [MAP, "way_id"], "left_semi").withColumn("len", P.length(F.col("pts")))
        return line.where((F.size("pts") >= 2) & (F.col("len") >= M.MIN_BOUNDARY))


def twins(a: DataFrame, b: DataFrame, tol: float, strict: bool = True) -> DataFrame:
    """Pairs (map_id, a, b), a < b, of ways of two sets that trace the same line.

    Blocked by the unordered pair of rounded end points, so only ways with the same block are compared; a pair astride
    a rounding edge is not found, which is part of the rule. Both inputs have (map_id, way_id, pts).
    """
    key = P.end_key(F.col("pts")).alias("_key")
    one = a.select(MAP, F.col("way_id").alias("a"), F.col("pts").alias("pa"), key)
    two = b.select(MAP, F.col("way_id").alias("b"), F.col("pts").alias("pb"), key)
    met = one.join(two, [MAP, "_key"]).where(F.col("a") != F.col("b"))
    met = met.where(P.equal(F.col("pa"), F.col("pb"), tol, strict))
    return met.select(MAP, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def coincident_ways(t: MapTables, tol: float = M.COINCIDENT_TOL, strict: bool = True) -> DataFrame:
    """(map_id, way_id) of boundary ways that have a twin."""
    pairs = twins(t.boundary_lines, t.boundary_lines, tol, strict)
    return pairs.select(MAP, F.explode(F.array("a", "b")).alias("way_id")).distinct()


def cross_sections(t: MapTables) -> DataFrame:
    """(map_id, rel_id, ord, n1, n2): the two end cross-sections of a lanelet as unordered node pairs; the ends are
    paired so that the two distances are least together. None for a lanelet with fewer than two refs on a side or with
    an unresolved end."""
    e = t.ends.where("refs >= 2")
    at = t.node.select(MAP, "node_id", F.struct("x", "y").alias("p"))
    end = lambda s: e.select(MAP, F.col("way_id").alias(s), F.col("head").alias(f"{s[0]}0"), F.col("tail").alias(f"{s[0]}1"))
    rows = t.bounds.join(end("left"), [MAP, "left"]).join(end("right"), [MAP, "right"])
    for c in ("l0", "l1", "r0", "r1"):
        rows = rows.join(at.select(MAP, F.col("node_id").alias(c), F.col("p").alias(f"p{c}")), [MAP, c])
    d = lambda a, b: P.dist(F.col(f"p{a}"), F.col(f"p{b}"))
    plain = d("l0", "r0") + d("l1", "r1") <= d("l0", "r1") + d("l1", "r0")
    pair = lambda k, a, b: F.struct(F.lit(k).alias("ord"), F.least(a, b).alias("n1"), F.greatest(a, b).alias("n2"))
    both = F.when(plain, F.array(pair(0, "l0", "r0"), pair(1, "l1", "r1"))).otherwise(F.array(pair(0, "l0", "r1"), pair(1, "l1", "r0")))
    return rows.select(MAP, "rel_id", F.explode(both).alias("s")).select(MAP, "rel_id", "s.*")


def shared_ends(t: MapTables) -> DataFrame:
    """(map_id, rel_id, shared): for each lanelet with any, the left-right end node pairs that some other lanelet also
    has among its end nodes, at most two."""
    e = t.ends.where("refs >= 2")
    node = F.explode(F.array_distinct(F.array("head", "tail"))).alias("node")
    own = t.sides.join(e, [MAP, "way_id"]).select(MAP, "rel_id", "role", node).distinct()
    lefts = own.where("role = 'left'").select(MAP, "rel_id", F.col("node").alias("a"))
    rights = own.where("role = 'right'").select(MAP, "rel_id", F.col("node").alias("b"))
    pairs = lefts.join(rights, [MAP, "rel_id"]).where("a <> b")
    any_end = own.select(MAP, F.col("rel_id").alias("other"), "node").distinct()
    met = pairs.join(any_end.withColumnRenamed("node", "a"), [MAP, "a"]).where("other <> rel_id")
    met = met.join(any_end.withColumnRenamed("node", "b"), [MAP, "b", "other"], "left_semi")
    hits = met.select(MAP, "rel_id", "a", "b").distinct().groupBy(MAP, "rel_id").agg(F.count("*").alias("n"))
    return hits.select(MAP, "rel_id", F.least("n", F.lit(2)).alias("shared"))
