"""Cutting oversized polylines into overlapping pieces at shared points, all cuts at once by pointer doubling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows, read_id
from roadloom.operators.nearby import placed_nodes
from roadloom.operators.skew import relay_join

PIECES = "map_id bigint, way_id bigint, piece int, first_pos int, last_pos int"


def greedy_ends(item: np.ndarray, at: np.ndarray, good: np.ndarray, limit: float) -> np.ndarray:
    """For each point e, the end of the piece that starts one point before e and follows a piece ending at e.

    ``item`` numbers the items in order, ``at`` is each point's length along its item, ``good`` marks natural
    boundaries. All successors of all items come from sorted searches: the farthest point within the limit, and the
    last natural boundary up to there. Where no point after e is within the limit (one step alone exceeds it) the
    piece takes that one step. The last point of an item is its own successor.
    """
    n = len(item)
    index = np.arange(n)
    first = np.r_[True, item[1:] != item[:-1]]
    head = np.maximum.accumulate(np.where(first, index, 0))
    tail = np.r_[index[first][1:] - 1, n - 1][np.cumsum(first) - 1]
    start = np.maximum(index - 1, head)
    # lengths are shifted so that they ascend over all items; the shift keeps an item's span apart from the next's
    far = _last_within(at, start, head, tail, limit)
    mark = np.maximum.accumulate(np.where(good, index, -1))[far]
    end = np.where(far >= tail, tail, np.where(mark > index, mark, far))
    return np.where(index == tail, tail, np.maximum(end, np.minimum(index + 1, tail)))


def _last_within(at: np.ndarray, start: np.ndarray, head: np.ndarray, tail: np.ndarray, limit: float) -> np.ndarray:
    """The last point of the same item whose length is at most limit beyond that at ``start``: a binary search by
    halving steps, for all points at once."""
    lo, hi, top = start.copy(), tail, at[start] + limit
    while True:
        mid = (lo + hi + 1) >> 1
        go = lo < hi
        if not go.any():
            return lo
        fits = at[mid] <= top
        lo, hi = np.where(go & fits, mid, lo), np.where(go & ~fits, mid - 1, hi)


def doubled_cuts(next_end: np.ndarray, first_end: np.ndarray) -> np.ndarray:
    """Marks all ends that are reached from the first ends, by squaring the successor table: after k squarings the
    ends up to 2**k pieces on are marked, so the rounds are the logarithm of the longest chain."""
    reached = np.zeros(len(next_end), bool)
    reached[first_end] = True
    jump = next_end
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        squared = jump[jump]
        if np.array_equal(more, reached) and np.array_equal(squared, jump):
            return reached
        if np.array_equal(squared, jump):
            return more
        reached, jump = more, squared


def cut_points(item: np.ndarray, x: np.ndarray, y: np.ndarray, good: np.ndarray, limit: float) -> tuple[np.ndarray, ...]:
    """(first point, last point, piece number) of every piece of the items longer than the limit; points by index."""
    n = len(item)
    first = np.r_[True, item[1:] != item[:-1]]
    step = np.r_[0.0, np.hypot(np.diff(x), np.diff(y))]
    step[first] = 0
    at = np.cumsum(step)
    index = np.arange(n)
    head = index[first]
    tail = np.r_[head[1:] - 1, n - 1]
    # each item's lengths start anew, so long batches lose no digits
    at = at - np.repeat(at[head], tail - head + 1)
    long_ = at[tail] > limit
    next_end = greedy_ends(item, at, good, limit)
    begin = head[long_]
    # piece 0 starts at the first point and has no end before it: the same rule, with the first point as that end
    ends = next_end[begin]
    reached = doubled_cuts(next_end, ends) if len(ends) else np.zeros(n, bool)
    last = index[reached]
    of = np.cumsum(first)[last]
    new = np.r_[True, of[1:] != of[:-1]] if len(last) else np.zeros(0, bool)
    start = np.where(new, head[of - 1], np.r_[0, last[:-1]] - 1) if len(last) else last
    order = np.arange(len(last))
    piece = order - np.maximum.accumulate(np.where(new, order, 0)) if len(last) else last
    return start, last, piece


def _cut(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [np.int64, np.int64, np.int32, np.float64, np.float64, bool]
        held = [np.zeros(0, k) for k in kinds]
        for batch in batches:
            cols = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            n = len(cols[0])
            if not n:
                continue
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]))
            whole = change[-1] + 1 if len(change) else 0  # the last way may go on in the next batch
            held = [c[whole:] for c in cols]
            if whole:
                yield _pieces([c[:whole] for c in cols], limit)
        if len(held[0]):
            yield _pieces(held, limit)

    return run


def _pieces(cols: list[np.ndarray], limit: float) -> pa.RecordBatch:
    scope, way, pos, x, y, good = cols
    item = np.cumsum(np.r_[True, (scope[1:] != scope[:-1]) | (way[1:] != way[:-1])])
    start, last, piece = cut_points(item, x, y, good, limit)
    return pa.RecordBatch.from_arrays([pa.array(scope[last]), pa.array(way[last]), pa.array(piece.astype(np.int32)), pa.array(pos[start]), pa.array(pos[last])], ["map_id", "way_id", "piece", "first_pos", "last_pos"])


def way_pieces(osm_way: DataFrame, osm_node: DataFrame, limit: float = 100.0) -> DataFrame:
    """(map_id, way_id, piece, first_pos, last_pos): the pieces of every way longer than ``limit`` metres.

    A way's points are its nd entries that read as ids of placed nodes of the map. Entries meet the nodes by a join on
    map and node, in which each node row also carries whether more than one way refers to it (an aggregate with the
    least and greatest way, so a node in very many ways gathers nothing); the join is salted, since one node may be
    referred to by a large part of all entries. The points then go to their ways, sorted, in Arrow batches of many
    ways. A way is one row of the input, so its points are bounded by what one row holds. In a batch the successor of
    every point is found at once and the successor table is squared until all cuts are marked.

    Null or empty nd, unreadable refs and refs without a placed node give no point; a way of fewer than two points has
    no length. A repeated ref is a point each time, but one way never makes its own point shared. Nulls in map_id or
    way_id give no piece. Where one step alone is longer than the limit, that step is a piece of its own length.
    """
    ways = current_rows(osm_way.select("map_id", "way_id", "loaded_at", "nd"), ["map_id", "way_id"])
    refs = ways.select("map_id", "way_id", F.posexplode("nd").alias("pos", "_nd")).select("map_id", "way_id", "pos", read_id(F.col("_nd.ref")).alias("node_id")).dropna()
    owners = refs.groupBy("map_id", "node_id").agg((F.min("way_id") < F.max("way_id")).alias("shared"))
    nodes = placed_nodes(osm_node).join(owners, ["map_id", "node_id"])
    points = relay_join(refs, nodes, ["map_id", "node_id"], F.col("way_id"), fan=16).where(F.col("x").isNotNull())
    points = points.select("map_id", "way_id", "pos", "x", "y", "shared")
    return points.repartition("map_id", "way_id").sortWithinPartitions("map_id", "way_id", "pos").mapInArrow(_cut(limit), PIECES)
