"""Expressions over packed polylines: ``pts`` is an array of structs with x and y (and more), in order.

All are built from higher-order functions, so they run inside the JVM without a shuffle; what needs a resampling by arc
length is in ``resample``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dist(p: Column, q: Column) -> Column:
    return F.hypot(p["x"] - q["x"], p["y"] - q["y"])


def segments(pts: Column) -> Column:
    """The lengths of the segments; empty below two points."""
    n = F.greatest(F.size(pts) - 1, F.lit(0))
    return F.zip_with(F.slice(pts, F.lit(1), n), F.slice(pts, F.lit(2), n), dist)


def length(pts: Column) -> Column:
    """The sum of the distances from point to point; 0 below two points or for null."""
    return F.when(F.size(pts) > 1, F.aggregate(segments(pts), F.lit(0.0), lambda a, d: a + d)).otherwise(F.lit(0.0))


def angle_at(a: Column, b: Column, c: Column) -> Column:
    """The interior angle at b in degrees; 180 where b coincides with a neighbour."""
    ux, uy, vx, vy = a["x"] - b["x"], a["y"] - b["y"], c["x"] - b["x"], c["y"] - b["y"]
    scale = F.hypot(ux, uy) * F.hypot(vx, vy)
    cosine = F.greatest(F.least(F.try_divide(ux * vx + uy * vy, scale), F.lit(1.0)), F.lit(-1.0))
    return F.when(scale == 0, F.lit(180.0)).otherwise(F.degrees(F.acos(cosine)))


def min_interior_angle(pts: Column) -> Column:
    """The sharpest interior angle in degrees; 180 below three points."""
    inner = F.sequence(F.lit(1), F.size(pts) - 2)
    angles = F.transform(inner, lambda i: angle_at(F.get(pts, i - 1), F.get(pts, i), F.get(pts, i + 1)))
    return F.when(F.size(pts) < 3, F.lit(180.0)).otherwise(F.array_min(angles))


def equal(a: Column, b: Column, tol: float, strict: bool = True) -> Column:
    """Same number of points, at least two, and all pairs within the tolerance, in the same or in reversed order."""

    def close(p: Column, q: Column) -> Column:
        return dist(p, q) < tol if strict else dist(p, q) <= tol

    def along(q: Column) -> Column:
        return F.forall(F.zip_with(a, q, close), lambda ok: ok)

    return (F.size(a) == F.size(b)) & (F.size(a) >= 2) & (along(b) | along(F.reverse(b)))


def end_key(pts: Column, digits: int = 0) -> Column:
    """The unordered pair of the end points, rounded half to even: equal for a polyline and its reversal."""
    ends = F.array(*[F.struct(F.bround(p["x"], digits).alias("x"), F.bround(p["y"], digits).alias("y")) for p in (F.get(pts, F.lit(0)), F.element_at(pts, -1))])
    return F.array_sort(ends)


def mean(pts: Column, field: str) -> Column:
    """The mean of a field over all points that have it; null if none has."""
    known = F.filter(F.transform(pts, lambda p: p[field]), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda s, v: s + v), F.size(known))


def straddle(ax: Column, ay: Column, bx: Column, by: Column, ref: Column) -> Column:
    """Whether two places lie on opposite sides of the line through a polyline's ends, each more than a trace off."""
    p, q = F.get(ref, F.lit(0)), F.element_at(ref, -1)
    nx, ny = p["y"] - q["y"], q["x"] - p["x"]
    sa, sb = (ax - p["x"]) * nx + (ay - p["y"]) * ny, (bx - p["x"]) * nx + (by - p["y"]) * ny
    return F.coalesce((F.size(ref) >= 2) & (sa * sb < 0) & (F.abs(sa) > 1e-3) & (F.abs(sb) > 1e-3), F.lit(False))


def direction(left: Column, right: Column) -> Column:
    """The unit vector from the middle of the first cross-section to that of the last; null without extent."""

    def mid(at: int, field: str) -> Column:
        get = (lambda p: F.get(p, F.lit(0))) if at == 0 else (lambda p: F.element_at(p, -1))
        return (get(left)[field] + get(right)[field]) / 2

    dx, dy = mid(-1, "x") - mid(0, "x"), mid(-1, "y") - mid(0, "y")
    d = F.hypot(dx, dy)
    return F.when(d > 0, F.struct((dx / d).alias("x"), (dy / d).alias("y")))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test of a place against a ring that closes itself."""
    last = F.size(ring) - 1

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.when(i == 0, last).otherwise(i - 1))
        at = (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"] + 1e-12) + a["x"]
        return ((a["y"] > y) != (b["y"] > y)) & F.coalesce(x < at, F.lit(False))

    hits = F.filter(F.sequence(F.lit(0), last), crosses)
    return F.when(F.size(ring) > 0, F.size(hits) % 2 == 1).otherwise(F.lit(False))


def distinct_corners(pts: Column, tol: float = 1e-3) -> Column:
    """Points left after dropping a closing repetition of the first and every point within tol of one kept before."""
    closed = (F.size(pts) > 1) & (dist(F.get(pts, F.lit(0)), F.element_at(pts, -1)) == 0)
    open_ = F.when(closed, F.slice(pts, F.lit(1), F.greatest(F.size(pts) - 1, F.lit(0)))).otherwise(pts)
    bare = F.transform(open_, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    start = F.slice(bare, F.lit(1), F.lit(0))
    kept = F.aggregate(bare, start, lambda acc, p: F.when(F.exists(acc, lambda q: dist(p, q) < tol), acc).otherwise(F.concat(acc, F.array(p))))
    return F.size(kept)


def shoelace(ring: Column) -> Column:
    """The unsigned area of a ring that closes itself."""
    last = F.size(ring) - 1

    def cross(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.when(i == last, F.lit(0)).otherwise(i + 1))
        return a["x"] * b["y"] - b["x"] * a["y"]

    twice = F.aggregate(F.transform(F.sequence(F.lit(0), last), cross), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(ring) >= 3, F.abs(twice) / 2).otherwise(F.lit(0.0))
