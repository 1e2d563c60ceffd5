"""Consolidating pairwise links into groups on a two-dimensional grid of edge blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.operators.keys import current_rows, is_blank, read_id
from roadloom.operators.skew import relay_join
from roadloom.storage import Scratch

#: Edges that a cell of the grid holds on average; a cell is worked on in the memory of one task.
CELL_EDGES = 50_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps silently."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rank(scope: np.ndarray, vertex: np.ndarray, turn: int) -> np.ndarray:
    """A random-like order of vertices, the same everywhere in a turn: roots are spread evenly, whatever the ids."""
    return _mix(vertex.astype(np.uint64) ^ _mix(scope.astype(np.uint64) + _ODD * np.uint64(turn + 1)))


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Union-find of one cell: the least vertex number of each vertex's component, over edges u-v of numbers below n.

    Hooks roots to smaller roots for all edges at once and halves the paths, until no edge joins two roots.
    """
    parent = np.arange(n)
    while len(u):
        a, b = parent[u], parent[v]
        open_ = a != b
        if not open_.any():
            break
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _columns(batches: Iterator[pa.RecordBatch], n: int) -> list[np.ndarray]:
    held = [b for b in batches if b.num_rows]
    return [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) if held else np.zeros(0, np.int64) for i in range(n)]


def _number(scope: np.ndarray, vertex: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (scope, vertex), numbered in rank order, and each row's number."""
    order = np.lexsort((vertex, scope, _rank(scope, vertex, turn)))
    s, v = scope[order], vertex[order]
    first = np.ones(len(order), bool)
    first[1:] = (s[1:] != s[:-1]) | (v[1:] != v[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(first) - 1
    return s[first], v[first], number


def _solve_cells(turn: int):
    """Edges of some cells -> for each of their vertices its root there: (scope, vertex, cell component, root rank, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            scope, a, b = _columns(batches, 3)
            if not len(scope):
                return
            s, v, number = _number(np.concatenate([scope, scope]), np.concatenate([a, b]), turn)
            root = local_roots(number[: len(a)], number[len(a) :], len(s))
            # ranks as signed numbers in the same order, so that Spark's minimum agrees with the local one
            rank = (_rank(s, v, turn) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s, v, v[root], rank[root])], ["scope", "vertex", "root", "rank"])

    return run


def _cells(links: DataFrame, blocks: int, turn: int) -> DataFrame:
    """Edges with the cell of the two blocks that their ends hash to, the smaller block first."""
    x, y = (F.pmod(F.xxhash64(F.lit(turn), "scope", c), F.lit(blocks)) for c in ("a", "b"))
    return links.withColumn("cell", F.least(x, y) * blocks + F.greatest(x, y))


def connected_groups(edges: DataFrame, scope: str, a: str, b: str, cell_edges: int = CELL_EDGES) -> DataFrame:
    """(scope, vertex, group): for every vertex of ``edges`` the least vertex of its scope tied to it, directly or not.

    Turn by turn:

    1. vertices are hashed into blocks, so every edge lies in the cell of a block pair; each task runs union-find over
       its cells and leaves one row per vertex and cell, with the vertex's root there;
    2. each vertex takes the least root among the cells of its row and column as its parent. However many edges a
       vertex has, it has one row per such cell, so these groups are bounded;
    3. the parents found within one component of a cell, bounded by the cell, become a star of edges of the next turn.

    Roots are least by a hash that changes every turn, so about half of the vertices vanish per turn for any numbering
    (long chains included) and the number of turns is logarithmic. The grid is as fine as the edges are many, so cells
    stay of one size; a vertex with a large part of all edges has them spread over a whole row of the grid. When no
    edge is left, the parents are followed back by joins that are salted, because one group may hold a large part of
    all vertices; groups are named after their least vertex by an aggregate. Every turn's tables are written to the
    shared folder, so lineage is short; only counts reach the driver.

    Rows with a null in any of the three columns tie nothing and are left out; a vertex tied to itself only is its own
    group; repeated and reversed rows change nothing; other columns are ignored; no rows give no rows. Vertices and
    scopes are bigint.
    """
    spark = edges.sparkSession
    store = Scratch(spark, "groups")
    links = edges.select(F.col(scope).cast("bigint").alias("scope"), F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).dropna()
    links = store.save(links.distinct(), "links-0")
    met: list[DataFrame] = []
    while left := links.count():
        turn = len(met) + 1
        blocks = max(1, math.ceil(math.sqrt(2 * left / cell_edges)))
        cells = _cells(links, blocks, turn).repartition(blocks * (blocks + 1) // 2, "cell").select("scope", "a", "b")
        solved = cells.mapInArrow(_solve_cells(turn), "scope bigint, vertex bigint, root bigint, rank bigint").withColumn("part", F.spark_partition_id())
        line = Window.partitionBy("scope", "vertex")
        parent = F.min(F.struct("rank", "root")).over(line)["root"]
        solved = solved.select("scope", "vertex", "root", "part", parent.alias("parent"), F.row_number().over(line.orderBy("rank", "root", "part")).alias("nth"))
        met.append(store.save(solved, f"met-{turn}"))
        hub = F.min("parent").over(Window.partitionBy("scope", "root", "part"))
        star = met[-1].select("scope", F.col("parent").alias("a"), hub.alias("b")).where("a <> b").distinct()
        links = store.save(star, f"links-{turn}")
        store.drop(f"links-{turn - 1}")
    known = None
    for turn in range(len(met), 0, -1):
        step = met[turn - 1].where("nth = 1").select("scope", "vertex", "parent")
        if known is not None:
            up = known.select("scope", F.col("vertex").alias("parent"), "top")
            step = relay_join(step, up, ["scope", "parent"], F.col("vertex"))
            step = step.withColumn("parent", F.coalesce("top", "parent"))
        known = store.save(step.select("scope", "vertex", F.col("parent").alias("top")), f"top-{turn}")
        store.drop(f"met-{turn}")
    if known is None:
        return links.select("scope", F.col("a").alias("vertex"), F.col("b").alias("group"))
    names = known.groupBy("scope", "top").agg(F.min("vertex").alias("group"))
    return relay_join(known, names, ["scope", "top"], F.col("vertex")).select("scope", "vertex", "group")


def road_pairs(junction_connection: DataFrame) -> DataFrame:
    """(map_id, a, b): the usable pairs of the current connections: the incoming road with the connecting road or,
    where that is blank, the linked road, both reading as ids."""
    rows = current_rows(junction_connection.select("connection_id", "loaded_at", "map_id", "incoming_road", "connecting_road", "linked_road"), ["connection_id"])
    other = F.when(is_blank(F.col("connecting_road")), F.col("linked_road")).otherwise(F.col("connecting_road"))
    return rows.select("map_id", read_id(F.col("incoming_road")).alias("a"), read_id(other).alias("b")).dropna()


def road_groups(junction_connection: DataFrame) -> DataFrame:
    """(map_id, road_id, group_id) of every road in a usable pair."""
    return connected_groups(road_pairs(junction_connection), "map_id", "a", "b").toDF("map_id", "road_id", "group_id")
