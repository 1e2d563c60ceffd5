"""How well one version of a map covers another: areas, overlaps and boundary deviations; and vehicle traces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom import model as M
from roadloom.functions import polyline as P
from roadloom.functions.resample import _flat
from roadloom.operators.skew import numbered
from roadloom.storage import Scratch

MAP = "map_id"


def lanelet_ring(left: Column, right: Column) -> Column:
    """A lanelet's outline: the left boundary and the reversed right one."""
    return F.concat(left, F.reverse(right))


def _cross(o: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p[..., 0] - o[..., 0]) * (q[..., 1] - o[..., 1]) - (p[..., 1] - o[..., 1]) * (q[..., 0] - o[..., 0])


def area(ring: np.ndarray) -> float:
    return abs(float(ring[:, 0] @ np.roll(ring[:, 1], -1) - ring[:, 1] @ np.roll(ring[:, 0], -1))) / 2 if len(ring) > 2 else 0.0


def _below(p: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sides from p to q round something counter-clockwise as edges: what is below one that leads back (to lesser x) counts
    c times, below the others -c times."""
    back = q[:, 0] < p[:, 0]
    edges = np.c_[np.where(back[:, None], q, p), np.where(back[:, None], p, q), np.where(back, c, -c)]
    return edges[(c != 0) & (p[:, 0] != q[:, 0])]


def strip(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, float]:
    """A strip between two boundaries: its edges (n, 5) and its area.

    Both sides are sampled at the same shares of their lengths; each step is a quadrangle, cut along a diagonal. What is
    below an edge (x0, y0, x1, y1, c), x0 < x1, counts c times: in sum, a place counts as often as triangles hold it. An
    edge between triangles of one turn adds nothing, and steps along one side are one edge.
    """

    def shares(p: np.ndarray) -> np.ndarray:
        run = np.r_[0.0, np.cumsum(np.hypot(*np.diff(p, axis=0).T))]
        return run / run[-1] if run[-1] > 0 else np.linspace(0, 1, len(p))

    f, g = shares(left), shares(right)
    at = np.unique(np.round(np.r_[0.0, f, g, 1.0], 12))
    a, b = (np.c_[np.interp(at, h, p[:, 0]), np.interp(at, h, p[:, 1])] for h, p in ((f, left), (g, right)))
    turns = np.stack([_cross(a[:-1], b[:-1], b[1:]), _cross(a[:-1], b[1:], a[1:])])
    one, two = np.sign(turns)
    rung = np.r_[one, 0.0] - np.r_[0.0, two]
    parts = [(a, b, rung), (a[:-1], b[1:], two - one)]
    middle = (at[:-1] + at[1:]) / 2
    for p, h, c in ((b, g, one), (a, f, -two)):
        piece = np.searchsorted(h, middle)
        first = np.flatnonzero(np.r_[True, (np.diff(piece) != 0) | (np.diff(c) != 0)])
        parts.append((p[first], p[np.r_[first[1:], len(c)]], c[first]))
    p, q = (np.concatenate([part[k] for part in parts]) for k in (0, 1))
    c = np.concatenate([part[2] for part in parts])
    return _below(p, q, c), float(np.abs(turns).sum() / 2)


def common_areas(one: np.ndarray, two: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The area that the strip with the edges ``one`` has in common with each of the strips whose edges begin at ``starts``
    in ``two``: for a place that is n times in the one and m times in the other, n x m times.

    This is the sum over pairs of edges of the area below both. As the edges over a place sum to nothing, only how far the
    one dips below the other matters, which two distances and a crossing give.
    """
    total = np.zeros(len(two))
    ax, ay, bx, by, c = one.T[:, :, None]
    slope = (by - ay) / (bx - ax)
    width = max(1, (1 << 17) // max(len(one), 1))
    for k in range(0, len(two), width):
        px, py, qx, qy, d = two[k : k + width].T
        lo, hi = np.maximum(ax, px), np.minimum(bx, qx)
        other = (qy - py) / (qx - px)
        u = ay + slope * (lo - ax) - py - other * (lo - px)
        v = ay + slope * (hi - ax) - py - other * (hi - px)
        low, high = np.minimum(u, v), np.maximum(u, v)
        np.minimum(low, 0, out=low)
        dip = low + np.minimum(high, 0)
        across = (low < 0) & (high > 0)
        dip[across] = low[across] ** 2 / (low[across] - high[across])
        dip *= np.maximum(hi - lo, 0)
        total[k : k + width] = (c[:, 0] @ dip) * d / 2
    return np.maximum(np.add.reduceat(total, starts), 0.0) if len(total) else np.zeros(len(starts))


def triangle_overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The common areas of pairs of counter-clockwise triangles, (n, 3, 2) each."""
    sides = lambda t: _below(t, np.roll(t, -1, 0), np.ones(3))
    return np.array([common_areas(sides(t), sides(u), np.array([0]))[0] for t, u in zip(a, b)])


def strip_iou(left_a, right_a, left_b, right_b) -> float:
    (one, size), (two, other) = strip(left_a, right_a), strip(left_b, right_b)
    both = float(common_areas(one, two, np.array([0]))[0]) if len(one) and len(two) else 0.0
    return both / (size + other - both) if size + other > both else 0.0


#: Lanelets of one block of the two versions that are compared at once; from which extent on a lanelet counts as wide.
_BLOCKS, _WIDE = (128, 512), 500.0
_BOX = ("x0", "x1", "y0", "y1")


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges, area and box of the strip of each lanelet; none for one without area or with places that are not finite."""
    for batch in batches:
        lines = [_flat(batch.column(c)) for c in ("lp", "rp")]
        made = []
        for i in range(batch.num_rows):
            left, right = (np.c_[x[b[i] : b[i + 1]], y[b[i] : b[i + 1]]] for x, y, b in lines)
            if np.isfinite(left).all() and np.isfinite(right).all():
                edges, size = strip(left, right)
                every = np.concatenate([left, right])
                if len(edges):
                    made.append((i, edges.ravel(), size, *every.min(0), *every.max(0)))
        of, edges, size, x0, y0, x1, y1 = zip(*made) if made else ((),) * 7
        of = pa.array(of, pa.int64())
        packed = pa.array([e.tobytes() for e in edges], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(MAP).take(of), batch.column("rel_id").take(of), packed, *[pa.array(v, pa.float64()) for v in (size, x0, x1, y0, y1)]], [MAP, "rel_id", "edges", "size", *_BOX])


def _best_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The greatest intersection over union of each lanelet of a block with those of another block whose boxes meet it."""

    def opened(v: pa.StructArray) -> tuple:
        rows = v.values if isinstance(v, pa.ListScalar) else v
        edges = [np.frombuffer(e.as_buffer()).reshape(-1, 5) for e in rows.field("edges")]
        return rows, edges, np.asarray(rows.field("size")), np.stack([np.asarray(rows.field(c)) for c in _BOX])

    for batch in batches:
        for i in range(batch.num_rows):
            (rows, one, size, box), (_, two, other, far) = (opened(batch.column(c)[i]) for c in ("one", "two"))
            best = np.zeros(len(one))
            for k, edges in enumerate(one):
                x0, x1, y0, y1 = box[:, k]
                met = np.flatnonzero((x0 <= far[1]) & (far[0] <= x1) & (y0 <= far[3]) & (far[2] <= y1))
                if len(met):
                    # from the lanelet's own place, so that far coordinates cost no digits
                    move = np.array([x0, y0, x0, y0, 0.0])
                    starts = np.cumsum([0, *[len(two[j]) for j in met[:-1]]])
                    both = common_areas(edges - move, np.concatenate([two[j] for j in met]) - move, starts)
                    either = size[k] + other[met] - both
                    best[k] = np.where(either > 0, both / np.where(either > 0, either, 1.0), 0.0).max()
            some = pa.array(np.flatnonzero(best > 0))
            key = pa.array([batch.column(MAP)[i].as_py()], batch.schema.field(MAP).type).take(pa.array(np.zeros(len(some), int)))
            yield pa.RecordBatch.from_arrays([key, rows.field("rel_id").take(some), pa.array(best).take(some)], [MAP, "rel_id", "iou"])


def best_overlaps(original: DataFrame, other: DataFrame) -> DataFrame:
    """(map_id, rel_id, iou): for each lanelet (rel_id, lp, rp) the greatest intersection over union with any lanelet of
    the other version; 0 where none meets it. A strip that covers itself counts there as often as it does.

    The lanelets of a map are put in blocks of bounded size, wide ones apart, the others by place. Pairs of blocks whose
    boxes meet are compared, each in one go: a lanelet with all those whose boxes meet its own. No row stands in cells, so
    a lanelet kilometres wide costs no more than another.
    """
    store = Scratch(original.sparkSession, "overlap")
    xy = lambda p: F.transform(p, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))

    def blocks(df: DataFrame, name: str, size: int, extra: str) -> DataFrame:
        lines = df.select(MAP, "rel_id", xy("lp").alias("lp"), xy("rp").alias("rp")).where((F.size("lp") > 1) & (F.size("rp") > 1))
        keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.select(MAP, "rel_id").schema)
        made = store.save(lines.mapInArrow(_edge_rows, f"{keys}, edges binary, size double, {', '.join(f'{c} double' for c in _BOX)}"), name)
        wide = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) > _WIDE
        nth = numbered(made.select(MAP, "rel_id", wide.alias("wide"), F.floor(F.col("x0") / _WIDE).alias("at"), "y0"), MAP, ["wide", "at", "y0", "rel_id"], "nth")
        made = made.join(nth.select(MAP, "rel_id", F.floor((F.col("nth") - 1) / size).alias(f"{extra}block")), [MAP, "rel_id"])
        ends = [(F.min if c.endswith("0") else F.max)(c).alias(f"{extra}{c}") for c in _BOX]
        return store.save(made.groupBy(MAP, f"{extra}block").agg(F.collect_list(F.struct("rel_id", "edges", "size", *_BOX)).alias("two" if extra else "one"), *ends), f"{name}-blocks")

    a, b = blocks(original, "original", _BLOCKS[0], ""), blocks(other, "other", _BLOCKS[1], "o")
    met = a.drop("one").join(b.drop("two"), MAP).where("x0 <= ox1 and ox0 <= x1 and y0 <= oy1 and oy0 <= y1").select(MAP, "block", "oblock")
    # dealt out by pair, not by map or by block: a large map is as many tasks as its pairs fill
    met = met.join(a.select(MAP, "block", "one"), [MAP, "block"]).join(b.select(MAP, "oblock", "two"), [MAP, "oblock"]).repartition(F.xxhash64(MAP, "block", "oblock"))
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in original.select(MAP, "rel_id").schema)
    best = met.select(MAP, "one", "two").mapInArrow(_best_of_blocks, f"{keys}, iou double").groupBy(MAP, "rel_id").agg(F.max("iou").alias("iou"))
    return original.select(MAP, "rel_id").join(best, [MAP, "rel_id"], "left").select(MAP, "rel_id", F.coalesce("iou", F.lit(0.0)).alias("iou"))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy))), F.lit(0.0))
    return F.hypot(px - ax - t * dx, py - ay - t * dy)


#: Rows of (point, level, cell) that may be broadcast: some 20 MB in memory.
_FEW_PROBES = 100_000


def nearest_segment(points: DataFrame, segments: DataFrame, cell: float) -> DataFrame:
    """(map_id, point_id, dist): the distance of each point from the nearest segment of its map; infinite without any.

    Rings of 1, 4, 16 ... cells round the points that are still open: a distance counts once it is within the ring, and
    rings go on until none is open. A segment stands in cells of at least a quarter of its own width, and in a ring of at
    least the ring's, so that it covers few cells however long it is and a point probes few however wide the ring; nothing
    is ever compared with a whole map. Points without finite coordinates are infinitely far.

    Probes and what they find are broadcast only if they are counted to be few: Spark estimates them by the points' file,
    before every point becomes some dozens of rows, and would send hundreds of MB through the driver.
    """
    store = Scratch(points.sparkSession, "nearest")
    finite = F.lit(float("inf"))
    wide = F.greatest(F.abs(F.col("ax") - F.col("bx")), F.abs(F.col("ay") - F.col("by")))
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(wide / F.lit(4 * cell), F.lit(1.0)))).cast("int"))
    seg = store.save(segments.select(MAP, "ax", "ay", "bx", "by", level.alias("level")).where(wide < finite), "segments")
    levels = [r[0] for r in seg.select("level").distinct().collect()]
    some = points.select(MAP, "point_id", "px", "py").where((F.abs("px") < finite) & (F.abs("py") < finite))
    left = store.save(some.join(seg.select(MAP).distinct(), MAP, "left_semi"), "open-0")
    still = left.count()
    d = segment_distance(*(F.col(c) for c in ("px", "py", "ax", "ay", "bx", "by")))
    ring, done = 0, None
    while True:
        radius = cell * 2.0**ring
        side = F.lit(cell) * F.pow(F.lit(2.0), F.col("lv"))
        span = lambda lo, hi: F.explode(F.sequence(F.floor(lo / side), F.floor(hi / side)))  # noqa: E731, B023
        placed = seg.withColumn("lv", F.greatest(F.col("level"), F.lit(ring))).drop("level")
        placed = placed.withColumn("gx", span(F.least("ax", "bx"), F.greatest("ax", "bx"))).withColumn("gy", span(F.least("ay", "by"), F.greatest("ay", "by")))
        probed = sorted({max(v, ring) for v in levels})
        probe = left.withColumn("lv", F.explode(F.array(*[F.lit(v) for v in probed]).cast("array<int>")))
        probe = probe.withColumn("gx", span(F.col("px") - radius, F.col("px") + radius)).withColumn("gy", span(F.col("py") - radius, F.col("py") + radius))
        how = "broadcast" if still * len(probed) * 9 <= _FEW_PROBES else "merge"
        near = probe.hint(how).join(placed, [MAP, "lv", "gx", "gy"]).groupBy(MAP, "point_id").agg(F.min(d).alias("dist")).where(F.col("dist") <= radius)
        near = store.save(near, f"near-{ring}")
        done = near if done is None else done.unionByName(near)
        left = store.save(left.join(near.hint(how), [MAP, "point_id"], "left_anti"), f"open-{ring + 2}")
        ring += 2
        still = left.count()
        if not still:
            break
    return points.select(MAP, "point_id").join(done.hint("merge"), [MAP, "point_id"], "left").select(MAP, "point_id", F.coalesce("dist", finite).alias("dist"))


def percentiles(df: DataFrame, col: str, by: str = MAP) -> DataFrame:
    """Exact percentiles, linear between ranks: the 10th, 50th and 90th, and the ends."""
    p = F.percentile(col, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return df.groupBy(by).agg(p[0].alias("p10"), p[1].alias("p50"), p[2].alias("p90"), F.min(col).alias("least"), F.max(col).alias("most"))


def worst_matches(ious: DataFrame, k: int = 10) -> DataFrame:
    """The k lanelets of each map with the least overlap, ties by id."""
    nth = F.row_number().over(Window.partitionBy(MAP).orderBy("iou", "rel_id"))
    return ious.withColumn("nth", nth).where(F.col("nth") <= k)


def roundtrip(original: DataFrame, other: DataFrame, samples: DataFrame, segments: DataFrame) -> DataFrame:
    """One row of fidelity metrics per map. ``match_iou_p90`` is the overlap that 90 % of the lanelets reach, so the 10th
    percentile. Areas are sums over lanelets; an overlap between lanelets of one version counts twice there."""
    size = lambda df, name: df.groupBy(MAP).agg(F.count("*").alias(f"lanelets_{name}"), F.sum(P.shoelace(lanelet_ring(F.col("lp"), F.col("rp")))).alias(f"area_{name}"))
    iou = percentiles(best_overlaps(original, other), "iou").select(MAP, F.col("p50").alias("match_iou_p50"), F.col("p10").alias("match_iou_p90"), F.col("least").alias("match_iou_min"))
    dev = percentiles(nearest_segment(samples, segments, 5.0), "dist").select(MAP, F.col("p50").alias("boundary_dev_p50"), F.col("p90").alias("boundary_dev_p90"), F.col("most").alias("boundary_dev_max"))
    return size(original, "original").join(size(other, "roundtrip"), MAP, "left").join(iou, MAP, "left").join(dev, MAP, "left")


# ---------------------------------------------------------------- lanes and vehicles


def dead_end_lanes(waypoints: DataFrame, links: DataFrame) -> DataFrame:
    """(map_id, road_id, lane_id): lanes whose last waypoint in driving direction has no successor."""
    s = F.when(F.col("lane_id") < 0, F.col("s")).otherwise(-F.col("s"))
    last = waypoints.groupBy(MAP, "road_id", "lane_id").agg(F.max_by("wp_id", s).alias("wp_id"))
    return last.join(links.select(MAP, F.col("src").alias("wp_id")), [MAP, "wp_id"], "left_anti").select(MAP, "road_id", "lane_id")


def dead_end_ahead(starts: DataFrame, links: DataFrame, hops: int = 40) -> DataFrame:
    """(map_id, wp_id, dead_end): whether any path of at most ``hops`` links from a waypoint ends. Walked backwards from
    the ends, level by level: every waypoint is met once, however many paths lead from it, and the walk is over when a
    level brings no new ones."""
    store = Scratch(starts.sparkSession, "reach")
    start = store.save(starts.select(MAP, "wp_id").distinct(), "start")
    step = store.save(links.select(MAP, F.col("src").alias("at"), F.col("dst").alias("to")).distinct(), "step")
    every = start.select(MAP, F.col("wp_id").alias("at")).union(step.select(MAP, "to")).distinct()
    found = front = store.save(every.join(step, [MAP, "at"], "left_anti"), "level-0")
    for hop in range(1, hops):
        before = step.join(front.select(MAP, F.col("at").alias("to")), [MAP, "to"], "left_semi").select(MAP, "at").distinct()
        front = store.save(before.join(found, [MAP, "at"], "left_anti"), f"level-{hop}")
        if not front.limit(1).count():
            break
        found = found.union(front)
    ends = found.select(MAP, F.col("at").alias("wp_id"), F.lit(True).alias("dead_end"))
    return start.join(ends, [MAP, "wp_id"], "left").fillna(False, ["dead_end"])


def repeated_edges(topology: DataFrame) -> DataFrame:
    """Topology edges that occur more than once, with their number."""
    return topology.groupBy(*topology.columns).agg(F.count("*").alias("times")).where("times > 1")


def trips(trace: DataFrame) -> DataFrame:
    """(vehicle, samples, distance, max_speed, removed_at): per vehicle, from samples (vehicle, ts, x, y, alive): what it
    drove, its top speed between samples and when it was first seen removed, after which nothing counts."""
    order = Window.partitionBy("vehicle").orderBy("ts")
    t = trace.withColumn("gone", F.min(F.when(~F.col("alive"), F.col("ts"))).over(Window.partitionBy("vehicle")))
    t = t.where("gone is null or ts < gone").withColumns({"d": F.hypot(F.col("x") - F.lag("x").over(order), F.col("y") - F.lag("y").over(order)), "dt": F.col("ts") - F.lag("ts").over(order)})
    per = t.groupBy("vehicle").agg(F.count("*").alias("samples"), F.coalesce(F.sum("d"), F.lit(0.0)).alias("distance"), F.max(F.try_divide(F.col("d"), F.col("dt"))).alias("max_speed"))
    gone = trace.where("not alive").groupBy("vehicle").agg(F.min("ts").alias("removed_at"))
    return per.join(gone, "vehicle", "full").fillna(0, ["samples", "distance"])


def drive_verdict(trip: DataFrame, dead_ends: DataFrame) -> DataFrame:
    """One row: vehicles, those that moved over 5 m, removals at and away from a dead end (vehicle, dead_end), and the
    status: FAIL if none moved, WARN for removals elsewhere, else PASS."""
    t = trip.join(dead_ends, "vehicle", "left").withColumn("at_end", F.coalesce("dead_end", F.lit(False)))
    gone = F.col("removed_at").isNotNull()
    row = t.agg(F.count("*").alias("vehicles"), F.count_if(F.col("distance") > 5).alias("moved"), F.count_if(gone & F.col("at_end")).alias("removed_at_dead_end"), F.count_if(gone & ~F.col("at_end")).alias("removed_elsewhere"))
    return row.withColumn("status", F.when(F.col("moved") == 0, M.FAIL).when(F.col("removed_elsewhere") > 0, M.WARN).otherwise(M.PASS))
