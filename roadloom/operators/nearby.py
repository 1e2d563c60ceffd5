"""Points near other points, and points inside regions, by ranges of space-filling-curve cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions import polyline as P
from roadloom.operators.keys import current_rows, read_decimal

#: Cells per side of the block of cells that is the equi-join key, as a power of two.
BLOCK_BITS = 2
_HALF = 1 << 60
_LOW = (1 << 31) - 1


def cell_of(value: Column, side: float | Column) -> Column:
    """The non-negative cell number of a coordinate.

    Beyond 2**60 cells neighbouring doubles are hundreds of cells apart, so only equal ones can be near each other: there
    the number is a hash of the coordinate, which keeps different places apart.

    Never null, as callers keep null coordinates out: a nullable key would make the optimiser push a test of the whole
    code expression, written out, down to the scan.
    """
    at = value / (F.lit(side) if isinstance(side, float) else side)
    far = F.lit(2 * _HALF) + F.pmod(F.xxhash64(value), F.lit(_HALF))
    return F.coalesce(F.when(F.abs(at) < float(_HALF), F.floor(at).cast("bigint") + F.lit(_HALF)).otherwise(far), F.lit(0))


def with_morton(df: DataFrame, **codes: tuple[str, str]) -> DataFrame:
    """Adds Z-order codes of pairs of columns of cell numbers: the bits of both numbers interleaved.

    The bits are spread in five halving steps, each a projection of its own, since a step uses its input twice and one
    expression of all five would hold it 32 times.
    """
    sides = sorted({c for pair in codes.values() for c in pair})
    df = df.withColumns({f"_m{c}": F.col(c) for c in sides})
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        df = df.withColumns({f"_m{c}": F.col(f"_m{c}").bitwiseOR(F.shiftleft(f"_m{c}", shift)).bitwiseAND(F.lit(mask)) for c in sides})
    df = df.withColumns({name: F.col(f"_m{x}").bitwiseOR(F.shiftleft(f"_m{y}", 1)) for name, (x, y) in codes.items()})
    return df.drop(*[f"_m{c}" for c in sides])


def _covers(df: DataFrame, x_lo: Column, x_hi: Column, y_lo: Column, y_hi: Column, side: float | Column, *more: Column) -> DataFrame:
    """One row per block of cells that a box touches, with the range of codes that the box can have in that block.

    In a block the code grows with both cell numbers, so the codes of the box's corners bound it. Codes hold the lower 31
    bits of the cell numbers; ``_block`` is a hash of the block's whole place (and of ``more``), and a place that meets
    another by chance is told apart by the exact test that follows.
    """
    last = (1 << BLOCK_BITS) - 1
    df = df.withColumns({"_x0": cell_of(x_lo, side), "_x1": cell_of(x_hi, side), "_y0": cell_of(y_lo, side), "_y1": cell_of(y_hi, side)})
    df = df.withColumn("_bx", F.explode(F.sequence(F.shiftright("_x0", BLOCK_BITS), F.shiftright("_x1", BLOCK_BITS))))
    df = df.withColumn("_by", F.explode(F.sequence(F.shiftright("_y0", BLOCK_BITS), F.shiftright("_y1", BLOCK_BITS))))
    x0, y0, low = F.shiftleft("_bx", BLOCK_BITS), F.shiftleft("_by", BLOCK_BITS), F.lit(_LOW)
    df = df.withColumns({"_x0": F.greatest("_x0", x0).bitwiseAND(low), "_y0": F.greatest("_y0", y0).bitwiseAND(low), "_x1": F.least("_x1", x0 + F.lit(last)).bitwiseAND(low), "_y1": F.least("_y1", y0 + F.lit(last)).bitwiseAND(low), "_block": F.xxhash64("_bx", "_by", *more)})
    return with_morton(df.drop("_bx", "_by"), _lo=("_x0", "_y0"), _hi=("_x1", "_y1")).drop("_x0", "_x1", "_y0", "_y1")


def _coded(df: DataFrame, x: str, y: str, side: float | Column, *more: Column) -> DataFrame:
    df = df.withColumns({"_cx": cell_of(F.col(x), side), "_cy": cell_of(F.col(y), side)})
    df = df.withColumns({"_block": F.xxhash64(F.shiftright("_cx", BLOCK_BITS), F.shiftright("_cy", BLOCK_BITS), *more), "_cx": F.col("_cx").bitwiseAND(F.lit(_LOW)), "_cy": F.col("_cy").bitwiseAND(F.lit(_LOW))})
    return with_morton(df, _code=("_cx", "_cy")).drop("_cx", "_cy")


def points_within(points: DataFrame, radius: float, scope: str, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """All pairs of different points of one scope at a plane distance of at most ``radius``.

    Each point has a Z-order cell code; the disc round it is covered by one code range in each block of cells that it
    touches (mostly one or two). Discs and points meet by a sort-merge join on scope and block, within the code range,
    and the exact distance decides. A block is four cells of the radius wide, so the work is in proportion to the
    points near each other; the join streams one side and spills the other, and a block that holds a large part of all
    points is split at run time by the adaptive skew join.

    Input: ``scope`` and ``key`` identify a point (one row each), ``x`` and ``y`` are doubles; other columns are
    ignored. Rows with a null in any of the four, or with a coordinate that is no finite number, are in no pair.
    Coinciding points are pairs at distance 0. Returns (scope, a, b, distance), a < b, each pair once.
    """
    if not radius > 0:
        raise ValueError("radius must be positive")
    side = radius * (1 + 1e-9)
    pts = points.select(F.col(scope).alias("scope"), F.col(key).alias("a"), F.col(x).cast("double").alias("ax"), F.col(y).cast("double").alias("ay"))
    finite = F.lit(float("inf"))
    pts = pts.where(F.col("scope").isNotNull() & F.col("a").isNotNull() & (F.abs("ax") < finite) & (F.abs("ay") < finite))
    r = F.lit(side)
    discs = _covers(pts, F.col("ax") - r, F.col("ax") + r, F.col("ay") - r, F.col("ay") + r, side)
    base = _coded(pts.toDF("scope", "b", "bx", "by"), "bx", "by", side)
    near = discs.hint("merge").join(base, ["scope", "_block"]).where(F.col("_code").between(F.col("_lo"), F.col("_hi")) & (F.col("a") < F.col("b")))
    d2 = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    return near.where(d2 <= F.lit(radius * radius)).select("scope", "a", "b", F.sqrt(d2).alias("distance"))


def points_in_boxes(points: DataFrame, boxes: DataFrame, side: float, scope: str, x: str = "x", y: str = "y") -> DataFrame:
    """Each point with the axis-parallel regions of its scope that contain it, borders included.

    ``boxes`` has the scope, ``x_lo x_hi y_lo y_hi`` and its own columns, which are all kept; ``side`` is the side of the
    smallest cells and should be about a quarter of a small region's width. A region larger than four cells takes cells
    of 2, 4, 8 ... times that side, so that it covers at most nine blocks whatever its size; points are coded at every
    level that some region has, which is at most as many as powers of two between the least and greatest width. Rows with
    null or non-finite coordinates, and regions whose bounds are reversed, match nothing.
    """
    inf = F.lit(float("inf"))
    ok = (F.abs("x_lo") < inf) & (F.abs("x_hi") < inf) & (F.abs("y_lo") < inf) & (F.abs("y_hi") < inf)
    ok = ok & (F.col("x_lo") <= F.col("x_hi")) & (F.col("y_lo") <= F.col("y_hi"))
    clash = [c for c in points.columns if c in boxes.columns and c != scope]
    if clash:
        raise ValueError(f"rename the columns that both sides have: {clash}")
    width = F.greatest(F.col("x_hi") / 4 - F.col("x_lo") / 4, F.col("y_hi") / 4 - F.col("y_lo") / 4)
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(width / F.lit(side), F.lit(1.0)))).cast("int"))
    boxes = boxes.where(ok).withColumn("_level", level)
    levels = sorted(r[0] for r in boxes.select("_level").distinct().collect())
    at = F.lit(side) * F.pow(F.lit(2.0), F.col("_level"))
    ranges = _covers(boxes, F.col("x_lo"), F.col("x_hi"), F.col("y_lo"), F.col("y_hi"), at, F.col("_level")).drop("_level")
    each = F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>"))
    base = _coded(points.where((F.abs(x) < inf) & (F.abs(y) < inf)).withColumn("_level", each), x, y, at, F.col("_level")).drop("_level")
    hit = base.join(ranges, [scope, "_block"]).where(F.col("_code").between(F.col("_lo"), F.col("_hi")))
    inside = F.col(x).between(F.col("x_lo"), F.col("x_hi")) & F.col(y).between(F.col("y_lo"), F.col("y_hi"))
    return hit.where(inside).drop("_code", "_block", "_lo", "_hi")


def points_in_rings(points: DataFrame, rings: DataFrame, side: float, scope: str, key: str, x: str = "x", y: str = "y") -> DataFrame:
    """Each point with the outlines of its scope that contain it, by the even-odd rule.

    ``rings`` has the scope, a ``key`` that is unique in it and ``ring``, an array of (x, y) that closes itself. The boxes of the outlines find
    the candidates, without carrying the outlines; those then join the hits by key and decide. Null and empty outlines
    contain nothing. Returns the points' columns and the key.
    """
    least = lambda f, c: f(F.transform("ring", lambda p: p[c]))
    shaped = rings.select(scope, key, "ring").where(F.size("ring") > 0)
    boxes = shaped.select(scope, key, least(F.array_min, "x").alias("x_lo"), least(F.array_max, "x").alias("x_hi"), least(F.array_min, "y").alias("y_lo"), least(F.array_max, "y").alias("y_hi"))
    met = points_in_boxes(points, boxes, side, scope, x, y).drop("x_lo", "x_hi", "y_lo", "y_hi")
    return met.join(shaped, [scope, key]).where(P.in_ring(F.col(x), F.col(y), F.col("ring"))).drop("ring")


def placed_nodes(osm_node: DataFrame) -> DataFrame:
    """(map_id, node_id, x, y) of the current rows of nodes whose local_x and local_y are both finite decimals."""
    slim = osm_node.select("map_id", "node_id", "loaded_at", read_decimal(F.col("local_x")).alias("x"), read_decimal(F.col("local_y")).alias("y"))
    slim = slim.withColumns({"x": F.when(F.col("y").isNotNull(), F.col("x")), "y": F.when(F.col("x").isNotNull(), F.col("y"))})
    return current_rows(slim, ["map_id", "node_id"]).where(F.col("x").isNotNull() & F.col("y").isNotNull()).drop("loaded_at")


def close_nodes(osm_node: DataFrame, radius: float = 0.5) -> DataFrame:
    """(map_id, node_id_a, node_id_b): pairs of placed nodes of one map within ``radius`` metres."""
    pairs = points_within(placed_nodes(osm_node), radius, "map_id", "node_id")
    return pairs.select(F.col("scope").alias("map_id"), F.col("a").alias("node_id_a"), F.col("b").alias("node_id_b"))
