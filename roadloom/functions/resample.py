"""Arc-length resampling, turning and length limits of polylines: numpy over Arrow batches of many polylines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom import model as M

_DOUBLE = T.DoubleType()
POINTS = T.ArrayType(T.StructType([T.StructField("x", _DOUBLE), T.StructField("y", _DOUBLE)]))
#: Points that are made at once.
PORTION = 1 << 18
RUNS = T.ArrayType(T.StructType([T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType()), T.StructField("v", _DOUBLE)]))
PAIR = T.StructType([T.StructField("a", POINTS), T.StructField("b", POINTS)])


def _flat(pts: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y and bounds of all polylines of a batch; a null polyline has no points."""
    counts = np.array(pa.compute.fill_null(pa.compute.list_value_length(pts), 0))
    flat = pts.flatten()
    get = lambda k: np.asarray(flat.field(k).to_numpy(zero_copy_only=False), float)
    return get("x"), get("y"), np.r_[0, np.cumsum(counts)]


def _packed(x: np.ndarray, y: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))


def lengths(x: np.ndarray, y: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running length over all points of all polylines, and each polyline's own length."""
    step = np.r_[0.0, np.hypot(np.diff(x), np.diff(y))] if len(x) else np.zeros(0)
    heads = bounds[:-1][np.diff(bounds) > 0]
    step[heads] = 0
    run = np.cumsum(step)
    total = np.zeros(len(bounds) - 1)
    has = np.diff(bounds) > 0
    total[has] = run[bounds[1:][has] - 1] - run[bounds[:-1][has]]
    return run, total


def resample(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every polyline at parts+1 places of equal distance along it; one without length repeats its first point."""
    run, total = lengths(x, y, bounds)
    count = np.where(np.diff(bounds) > 0, parts + 1, 0)
    out = np.r_[0, np.cumsum(count)]
    of = np.repeat(np.arange(len(count)), count)
    if not len(of):
        return np.zeros(0), np.zeros(0), out
    k = np.arange(len(of)) - out[of]
    head, tail = bounds[of], bounds[of + 1] - 1
    at = run[head] + total[of] * k / np.maximum(parts[of], 1)
    j = np.clip(np.searchsorted(run, at, side="left") - 1, head, np.maximum(tail - 1, head))
    nxt = np.minimum(j + 1, tail)
    seg = run[nxt] - run[j]
    t = np.clip(np.divide(at - run[j], seg, out=np.zeros_like(at), where=seg > 0), 0, 1)
    return x[j] + t * (x[nxt] - x[j]), y[j] + t * (y[nxt] - y[j]), out


def portions(counts: np.ndarray, most: int = PORTION) -> list[tuple[int, int]]:
    """Bounds of runs of polylines of together at most ``most`` points, or of a single one: polylines differ in length by
    many times, so a number of them says nothing about the memory that their points take."""
    ends = np.cumsum(counts)
    out, start = [], 0
    while start < len(counts):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        out.append((start, end))
        start = end
    return out


def cut(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The polylines from start to end of a batch."""
    own = slice(bounds[start], bounds[end])
    return x[own], y[own], bounds[start : end + 1] - bounds[start]


def sample_count(pts: Column, n: int) -> Column:
    """n points evenly spaced by arc length, the ends kept."""

    @F.arrow_udf(POINTS)
    def run(p: pa.Array) -> pa.Array:
        x, y, b = _flat(p)
        return _packed(*resample(x, y, b, np.full(len(b) - 1, n - 1)))

    return run(pts)


def step_batches(batches: Iterator[pa.Array], step: float) -> Iterator[pa.Array]:
    for p in batches:
        x, y, b = _flat(p)
        parts = np.maximum(1, np.rint(lengths(x, y, b)[1] / step)).astype(int)
        for s, e in portions(parts):
            yield _packed(*resample(*cut(x, y, b, s, e), parts[s:e]))


def sample_step(pts: Column, step: float) -> Column:
    """Points about ``step`` apart: the length over the step, rounded half to even, parts of equal length, at least one."""

    @F.arrow_udf(POINTS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return step_batches(batches, step)

    return run(pts)


def shared_batches(batches: Iterator[tuple[pa.Array, pa.Array]], step: float, least: int) -> Iterator[pa.Array]:
    for p, q in batches:
        one, two = _flat(p), _flat(q)
        parts = np.maximum(least, np.ceil(np.maximum(lengths(*one)[1], lengths(*two)[1]) / step).astype(int) + 1) - 1
        for s, e in portions(2 * parts):
            yield pa.StructArray.from_arrays([_packed(*resample(*cut(*line, s, e), parts[s:e])) for line in (one, two)], ["a", "b"])


def sample_shared(a: Column, b: Column, step: float, least: int = 3) -> tuple[Column, Column]:
    """Both boundaries at one shared number of points: enough for ``step`` on the longer one, at least ``least``."""

    @F.arrow_udf(PAIR)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return shared_batches(batches, step, least)

    both = run(a, b)
    return both["a"], both["b"]


def _turning(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running length at the points, and the running turn in degrees at the segments, of one polyline."""
    dx, dy = np.diff(x), np.diff(y)
    seg = np.hypot(dx, dy)
    heading = np.arctan2(dy, dx)
    moved = seg > 0
    if not moved.all():  # a segment without length goes on as the one before
        last = np.maximum.accumulate(np.where(moved, np.arange(len(seg)), -1))
        heading = np.where(last >= 0, heading[last], 0.0)
    turn = np.abs(np.degrees((np.diff(heading) + math.pi) % (2 * math.pi) - math.pi))
    return np.r_[0.0, np.cumsum(seg)], np.r_[0.0, np.cumsum(turn)]


def _stepped(x: np.ndarray, y: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    b = np.array([0, len(x)])
    total = lengths(x, y, b)[1]
    if not len(x) or total[0] <= 0:
        return x, y
    rx, ry, _ = resample(x, y, b, np.maximum(1, np.rint(total / step)).astype(int))
    return rx, ry


def window_turn(x: np.ndarray, y: np.ndarray, window: float = M.CURVE_WINDOW) -> float:
    """The greatest turn in degrees within any stretch of at most ``window`` metres, on a resampled polyline."""
    if len(x) < 3:
        return 0.0
    x, y = _stepped(x, y, M.RESAMPLE_STEP)
    if len(x) < 3:
        return 0.0
    run, turn = _turning(x, y)
    hi = np.arange(len(turn))
    lo = np.minimum(np.searchsorted(run, run[1:] - window - 1e-9, side="left"), hi)
    return float((turn[hi] - turn[lo]).max())


def curved_segments(run: np.ndarray, turn: np.ndarray, window: float, degrees: float) -> np.ndarray:
    """Segments that lie in a stretch of at most ``window`` which turns by more than ``degrees``: for each first
    segment the shortest such stretch is marked."""
    n = len(turn)
    first = np.arange(n)
    last = np.searchsorted(turn, turn + degrees, side="right")
    ok = last < n
    ok[ok] = run[last[ok] + 1] - run[first[ok]] <= window + 1e-9
    mark = np.zeros(n + 1, int)
    np.add.at(mark, first[ok], 1)
    np.add.at(mark, last[ok] + 1, -1)
    return np.cumsum(mark[:-1]) > 0


def widened(mask: np.ndarray, run: np.ndarray, radius: float) -> np.ndarray:
    """Segments whose middle is within ``radius`` along the line of the middle of a marked one."""
    if not mask.any():
        return mask
    mid = (run[:-1] + run[1:]) / 2
    known = mid[mask]
    k = np.searchsorted(known, mid)
    before = np.abs(mid - known[np.maximum(k - 1, 0)])
    after = np.abs(known[np.minimum(k, len(known) - 1)] - mid)
    return np.minimum(before, after) <= radius


def _stepped_at_bends(x: np.ndarray, y: np.ndarray, step: float, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The resampled polyline without the points that lie further than ``reach`` along the line from all given ones: they
    stand on straights, which become one long segment."""
    run, total = lengths(x, y, np.array([0, len(x)]))
    parts = int(max(1, np.rint(total[0] / step))) if len(x) else 1
    near = math.ceil(reach / step) + 2
    if parts <= 4 * near * len(x):
        return _stepped(x, y, step)
    k = np.unique(np.clip(np.floor(run * parts / total[0]).astype(int)[:, None] + np.arange(-near, near + 2), 0, parts))
    at = total[0] * k / parts
    j = np.clip(np.searchsorted(run, at, side="left") - 1, 0, len(x) - 2)
    seg = run[j + 1] - run[j]
    t = np.clip(np.divide(at - run[j], seg, out=np.zeros_like(at), where=seg > 0), 0, 1)
    return x[j] + t * (x[j + 1] - x[j]), y[j] + t * (y[j + 1] - y[j])


def local_limits(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment lengths on the resampled polyline and the piece length allowed at each. A segment is curved by what turns
    within two windows of it, so the inside of a longer straight is one segment."""
    x, y = _stepped_at_bends(x, y, M.RESAMPLE_STEP, 2 * M.CURVE_WINDOW + 4 * M.RESAMPLE_STEP)
    if len(x) < 2:
        return np.zeros(0), np.zeros(0)
    run, turn = _turning(x, y)
    curved = widened(curved_segments(run, turn, M.CURVE_WINDOW, M.CURVE_TURN), run, M.CURVE_WINDOW)
    return np.diff(run), np.where(curved, M.MAX_CURVED, M.MAX_STRAIGHT) * M.SPLIT_RATIO


def cut_demand(x: np.ndarray, y: np.ndarray, samples: int = M.CUT_SAMPLES) -> np.ndarray | None:
    """Pieces per unit of the way's own length that it needs at each of the samples; null without length."""
    seg, limit = local_limits(x, y)
    total = seg.sum()
    if not len(seg) or total <= 0:
        return None
    ends = np.cumsum(seg)
    j = np.minimum(np.searchsorted(ends, (np.arange(samples) + 0.5) / samples * total, side="right"), len(seg) - 1)
    return total / limit[j]


def cut_fractions(demand: np.ndarray) -> np.ndarray:
    """Where to cut a group of ways: at equal shares of the total demand, linear within a sample; none up to one piece."""
    mass = demand / len(demand)
    total = mass.sum()
    if total <= 1 + 1e-9:
        return np.zeros(0)
    pieces = math.ceil(total - 1e-9)
    ends = np.cumsum(mass)
    want = total * np.arange(1, pieces) / pieces
    i = np.minimum(np.searchsorted(ends, want - 1e-12, side="left"), len(mass) - 1)
    at = (i + np.clip((want - (ends[i] - mass[i])) / mass[i], 0, 1)) / len(demand)
    return at[(at > 1e-6) & (at < 1 - 1e-6)]


@F.arrow_udf(_DOUBLE)
def _window_turn(p: pa.Array) -> pa.Array:
    x, y, b = _flat(p)
    return pa.array([window_turn(x[s:e], y[s:e]) for s, e in zip(b[:-1], b[1:])], pa.float64())


def max_turn(pts: Column) -> Column:
    return _window_turn(pts)


def runs(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sample, sample after the last, and value of every run of equal demand: straights and curves take turns, so
    there are few."""
    cut = np.flatnonzero(np.diff(demand)) + 1
    first = np.r_[0, cut]
    return first, np.r_[cut, len(demand)], demand[first]


def greatest(lo: np.ndarray, hi: np.ndarray, v: np.ndarray, samples: int = M.CUT_SAMPLES) -> np.ndarray:
    """The greatest value over each sample of runs that overlap."""
    out = np.zeros(samples)
    for k in np.argsort(v, kind="stable").tolist():
        out[lo[k] : hi[k]] = v[k]
    return out


def _lists(parts: list[np.ndarray], values: pa.Array, none: list[bool]) -> pa.ListArray:
    bounds = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), values, mask=pa.array(none))


def demand_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    none = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    for p in batches:
        x, y, b = _flat(p)
        for s, e in portions(np.full(len(b) - 1, M.CUT_SAMPLES)):
            found = [cut_demand(x[b[i] : b[i + 1]], y[b[i] : b[i + 1]]) for i in range(s, e)]
            lo, hi, v = zip(*(none if d is None else runs(d) for d in found))
            flat = [pa.array(np.concatenate(lo), pa.int32()), pa.array(np.concatenate(hi), pa.int32()), pa.array(np.concatenate(v))]
            yield _lists(lo, pa.StructArray.from_arrays(flat, ["lo", "hi", "v"]), [d is None for d in found])


def demand(pts: Column) -> Column:
    """Runs (lo, hi, v) of ``cut_demand``. Called nondeterministic, or Spark puts a filter on it below joins and computes it
    for all ways, and again for those that the join leaves."""

    @F.arrow_udf(RUNS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return demand_batches(batches)

    return run.asNondeterministic()(pts)


def fraction_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for p in batches:
        bounds = np.r_[0, np.cumsum(np.array(pa.compute.fill_null(pa.compute.list_value_length(p), 0)))]
        flat = p.flatten()
        lo, hi, v = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "v"))
        held: list[np.ndarray] = []
        made = 0
        for s, e in zip(bounds[:-1], bounds[1:]):
            held.append(cut_fractions(greatest(lo[s:e], hi[s:e], v[s:e])))
            made += len(held[-1])
            if made >= PORTION or e == bounds[-1]:
                yield _lists(held, pa.array(np.concatenate(held)), [False] * len(held))
                held, made = [], 0


def fractions(demands: Column) -> Column:
    """``cut_fractions`` of the greatest demand over runs."""

    @F.arrow_udf(T.ArrayType(_DOUBLE))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return fraction_batches(batches)

    return run.asNondeterministic()(demands)
