"""Small measures and selections on map tables that reports and checks share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.operators.maptables import MAP, MapTables
from roadloom.operators.skew import numbered


def map_centres(places: DataFrame) -> DataFrame:
    """(map_id, lat, lon): the middle of each map's bounds, to six decimals, halves to even."""
    mid = lambda c: F.bround((F.min(c) + F.max(c)) / 2, 6).alias(c)
    return places.groupBy(MAP).agg(mid("lat"), mid("lon"))


def extent(places: DataFrame, counted: Sequence[str], missing: str) -> DataFrame:
    """Per map: the distinct values of each ``counted`` column (named by its plural), the bounds of x and y, and how many
    rows are without ``missing``."""
    kinds = [F.count_distinct(c).alias(f"{c.removesuffix('_id')}s") for c in counted]
    return places.groupBy(MAP).agg(*kinds, F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count_if(F.col(missing).isNull()).alias(f"without_{missing}"))


def busiest(rows: DataFrame, key: str) -> DataFrame:
    """(map_id, key, n): the key with the most rows in each map, of equals the least. Null keys do not count."""
    n = rows.where(F.col(key).isNotNull()).groupBy(MAP, key).agg(F.count("*").alias("n"))
    return n.groupBy(MAP).agg(F.min(F.struct((-F.col("n")).alias("less"), F.col(key).alias("k"), F.col("n").alias("n"))).alias("b")).select(MAP, F.col("b.k").alias(key), "b.n")


def strided(rows: DataFrame, order: str, most: int) -> DataFrame:
    """At most ``most`` rows of each map at an even stride by ``order``, with their place ``k`` from 0: a sampling
    operator."""
    step = rows.groupBy(MAP).agg(F.greatest(F.lit(1), F.floor(F.count("*") / most)).alias("_step"))
    at = numbered(rows, MAP, [order], "k").withColumn("k", F.col("k") - 1).join(step, MAP)
    return at.where(f"k % _step = 0 and k div _step < {int(most)}").drop("_step")


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """(map_id, keys, n): values that a map has more than once."""
    return rows.groupBy(MAP, *keys).agg(F.count("*").alias("n")).where("n > 1")


def fixed(value: Column, decimals: int = 4) -> Column:
    """A number as writers round it: to so many decimals, halves up."""
    return F.floor(value * 10**decimals + 0.5) / 10**decimals


def road_lanelets(t: MapTables) -> DataFrame:
    """Lanelets that vehicles drive on, with whether they are connectors, inside a junction."""
    rows = t.lanelets.where(F.col("subtype").isin(M.DRIVABLE))
    return rows.withColumn("connector", F.col("turn_direction").isNotNull() | F.col("intersection_area").isNotNull())


def regulatory_kinds(t: MapTables) -> DataFrame:
    """(map_id, subtype, n) of regulatory elements."""
    return t.regelems.groupBy(MAP, "subtype").agg(F.count("*").alias("n"))


def subtype_boundaries(t: MapTables, *subtypes: str) -> DataFrame:
    """(map_id, rel_id, subtype, way_id, pts, len): the boundaries of at least two points and a metre of lanelets of these
    subtypes, or all; a way counts once for each lanelet side that uses it."""
    own = t.lanelets.select(MAP, "rel_id", "subtype")
    own = own.where(F.col("subtype").isin(*subtypes)) if subtypes else own
    return t.sides.join(own, [MAP, "rel_id"]).join(t.boundary_lines, [MAP, "way_id"])


def strip_z(lanelets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lanelets (map_id, rel_id, lp, rp with ele) in the plane, and the heights taken off: (map_id, rel_id, lz, rz) of those
    lanelets that have any; a boundary point without height counts 0 there."""
    flat = lambda p: F.transform(p, lambda q: q.dropFields("ele"))
    high = lambda p: F.exists(p, lambda q: q["ele"].isNotNull())
    z = lambda p: F.transform(p, lambda q: F.coalesce(q["ele"], F.lit(0.0)))
    heights = lanelets.where(F.coalesce(high(F.col("lp")), F.lit(False)) | F.coalesce(high(F.col("rp")), F.lit(False)))
    return lanelets.withColumns({"lp": flat(F.col("lp")), "rp": flat(F.col("rp"))}), heights.select(MAP, "rel_id", z(F.col("lp")).alias("lz"), z(F.col("rp")).alias("rz"))


def restore_z(lanelets: DataFrame, heights: DataFrame) -> DataFrame:
    """The lanelets with the heights of ``strip_z`` put back by place; null where there were none."""
    back = lambda p, z: F.transform(F.col(p), lambda q, i: q.withField("ele", F.get(F.col(z), i)))
    return lanelets.join(heights, [MAP, "rel_id"], "left").withColumns({"lp": back("lp", "lz"), "rp": back("rp", "rz")}).drop("lz", "rz")
