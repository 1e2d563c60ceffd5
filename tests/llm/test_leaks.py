import pickle
import random
import re
import tracemalloc

import numpy as np
import pytest

from roadloom.llm.leaks import LeakIndex, leaked_items, minhashes
from tests.conftest import rows

WORDS = [f"w{i}" for i in range(40)]


def brute(docs, items, n):
    cut = lambda t: [w.lower() for w in re.findall(r"[A-Za-z0-9_]+", t or "")]
    runs = lambda t: {tuple(w[i : i + n]) for w in [cut(t)] for i in range(len(w) - n + 1)}
    known = [(i, runs(t)) for i, t in items]
    return sorted({(d, i) for d, t in docs for i, r in known if d is not None and i is not None and runs(t) & r}, key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string")


@pytest.mark.parametrize("chars", [16_000_000, 800])
def test_against_brute_force(spark, chars):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 40)))) for i in range(30)] + [(50, None), (51, ""), (None, "a " * 20)]
    docs = []
    for i in range(80):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 200))]
        if i % 2:  # a passage of 8 to 16 words of an item, laid out differently
            own = items[rng.randrange(30)][1].split()
            k = rng.randint(8, 16)
            at = rng.randint(0, max(0, len(own) - k))
            words[3:3] = [w.upper() for w in own[at : at + k]]
        docs.append((i, "".join(w + rng.choice([" ", "\n  ", ", ", " é ", "K"]) for w in words)))
    docs += [(900, None), (901, ""), (None, items[0][1]), (902, " ".join(i[1] or "" for i in items[:30]) * 3)]
    got = leaked_items(*frames(spark, docs, items), index_chars=chars)
    assert rows(got.select("doc_id", "item_id")) == brute(docs, items, 12)


def test_limits_and_repeats(spark):
    twelve = "a b c d e f g h i j k l"
    docs = [(1, twelve), (1, twelve), (2, twelve[:-2]), (3, twelve.replace(" ", "\t;") + "_"), (4, "x" * 200_000 + " " + twelve)]
    items = [(1, twelve.upper()), (2, "z " + twelve + " y"), (1, twelve)]
    got = leaked_items(*frames(spark, docs, items))
    assert rows(got) == [(1, 1, 1), (1, 2, 1), (4, 1, 1), (4, 2, 1)]
    d, i = frames(spark, docs, items)
    assert leaked_items(d, i.limit(0)).count() == 0
    assert leaked_items(d.limit(0), i).count() == 0


def test_minhashes_choose_the_candidates(spark):
    value = np.random.default_rng(1).integers(0, 1 << 60, 50_000).astype(np.uint64)
    place, low = minhashes(value, np.zeros(len(value), np.int64), 12, 5)
    assert len(place) < len(value) / 4 and (np.diff(place) > 0).all() and place[-1] >= len(value) - 12
    index = LeakIndex([(1, " ".join(WORDS))])
    index.low = index.low[:0]  # without MinHashes nothing is found
    assert index.search([(1, " ".join(WORDS))]) == {}


def test_one_passage_in_most_items(spark):
    common = " ".join(WORDS[:14])
    items = [(i, f"{common} tail{i} " + " ".join(f"x{i}y{k}" for k in range(20))) for i in range(3000)]
    index = LeakIndex(items)
    got = index.search([(7, "q " * 50 + common + " z"), (8, " ".join(WORDS[:11]))])
    assert len(got) == 3000 and set(got.values()) == {3} and {d for d, _ in got} == {7}


def test_memory_of_a_full_index():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    items = [(i, " ".join(rng.choice(words) for _ in range(300))) for i in range(9000)]
    items = items[: next((k for k, total in enumerate(np.cumsum([len(t) for _, t in items])) if total > 16_000_000), len(items))]
    tracemalloc.start()
    index = LeakIndex(items)
    assert tracemalloc.get_traced_memory()[1] < 600e6
    tracemalloc.stop()
    size = len(pickle.dumps(index))
    assert size / sum(len(t) for _, t in items) < 9 and size < 150e6
