import datetime as d
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadloom.llm.splits import cut_points, way_pieces
from tests.conftest import rows

T = d.datetime(2024, 1, 1)


def brute(x, y, good, limit):
    """The rule told one piece after the other."""
    n = len(x)
    at = [0.0]
    for i in range(1, n):
        at.append(at[-1] + math.hypot(x[i] - x[i - 1], y[i] - y[i - 1]))
    if n < 2 or at[-1] <= limit:
        return []
    out, start, before = [], 0, 0
    while True:
        far = max(i for i in range(start, n) if at[i] - at[start] <= limit)
        if far == n - 1:
            end = far
        else:
            later = [i for i in range(before + 1, far + 1)]
            shared = [i for i in later if good[i]]
            end = shared[-1] if shared else later[-1] if later else before + 1
        out.append((start, end, len(out)))
        if end == n - 1:
            return out
        start, before = end - 1, end


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.booleans()), min_size=1, max_size=40), min_size=1, max_size=6), st.sampled_from([10.5, 100.5]))
def test_against_one_by_one(ways, limit):
    item = np.repeat(np.arange(len(ways)), [len(w) for w in ways])
    x = np.concatenate([np.cumsum([s for s, _ in w]) for w in ways]).astype(float)
    good = np.concatenate([[g for _, g in w] for w in ways]).astype(bool)
    start, last, piece = cut_points(item, x, np.zeros(len(x)), good, limit)
    want, base = [], 0
    for w in ways:
        n = len(w)
        want += [(s + base, e + base, p) for s, e, p in brute(x[base : base + n], [0.0] * n, good[base : base + n], limit)]
        base += n
    assert list(zip(start.tolist(), last.tolist(), piece.tolist())) == want


def table(spark, ways, nodes):
    way = spark.createDataFrame([(m, w, T, None if nd is None else [{"ref": r} for r in nd], None, "x") for m, w, nd in ways], "map_id long, way_id long, loaded_at timestamp_ntz, nd array<struct<ref:string>>, deleted_at timestamp_ntz, x string")
    node = spark.createDataFrame([(m, n, T, x, y) for m, n, x, y in nodes], "map_id long, node_id long, loaded_at timestamp_ntz, local_x string, local_y string")
    return way, node


def test_ways(spark):
    nodes = [(1, i, str(i * 30), "0") for i in range(12)] + [(1, 50, "n/a", "0"), (2, 1, "0", "0")]
    ways = [(1, 1, [" 0", "1", None, "2", "x", "3", "50", "4", "5", "6", "7"]), (1, 2, ["2", "99"]), (1, 3, []), (1, 4, None), (1, 5, ["0", "3", "3"]), (2, 1, ["1"])]
    got = rows(way_pieces(*table(spark, ways, nodes)))
    # points of way 1 at 0, 1, 3, 5, 7.. ; nodes 0, 2 and 3 are shared with ways 2 and 5
    assert got == [(1, 1, 0, 0, 5), (1, 1, 1, 3, 8), (1, 1, 2, 7, 10)]
    assert way_pieces(*[t.limit(0) for t in table(spark, ways, nodes)]).count() == 0


@pytest.mark.parametrize("batch", [7, 10000])
def test_batches_that_cut_ways(spark, batch):
    rng = random.Random(5)
    nodes = [(1, i, str(rng.randint(0, 80)), str(rng.randint(0, 80))) for i in range(60)]
    ways = [(1, w, [str(rng.randint(0, 70)) for _ in range(rng.randint(0, 40))]) for w in range(30)]
    way, node = table(spark, ways, nodes)
    place = {n: (float(x), float(y)) for _, n, x, y in nodes}
    users = {}
    for _, w, nd in ways:
        for r in nd:
            users.setdefault(int(r), set()).add(w)
    want = []
    for _, w, nd in ways:
        pts = [(k, int(r)) for k, r in enumerate(nd) if int(r) in place]
        x, y = [place[r][0] for _, r in pts], [place[r][1] for _, r in pts]
        want += [(1, w, p, pts[s][0], pts[e][0]) for s, e, p in brute(x, y, [len(users[r]) > 1 for _, r in pts], 100.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert rows(way_pieces(way, node)) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
