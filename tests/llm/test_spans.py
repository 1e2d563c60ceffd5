import random
import time

import pytest

from roadloom.llm.spans import shared_chars
from tests.conftest import rows


def brute(docs, n):
    held = {}
    for d, t in docs:
        for i in range(len(t or "") - n + 1):
            held.setdefault(t[i : i + n], set()).add(d)
    out = {}
    for d, t in docs:
        cover = out.setdefault(d, set())
        for i in range(len(t or "") - n + 1):
            if len(held[t[i : i + n]] - {None}) > 1:
                cover.update(range(i, i + n))
    return sorted(((d, len(c)) for d, c in out.items() if c and d is not None), key=str)


@pytest.mark.parametrize(("span", "width", "group"), [(30, 8, 20_000), (30, 8, 3), (30, 29, 5), (12, 1, 4)])
def test_against_brute_force(spark, span, width, group):
    rng = random.Random(span + group)
    pieces = ["".join(rng.choice("ab€𝄞c") for _ in range(rng.randint(5, 90))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [rng.choice(pieces) if rng.random() < 0.5 else "".join(rng.choice("xyzäö") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 6))]
        docs.append((i, "".join(p[rng.randint(0, 4) :] for p in parts)))
    header = "".join(rng.choice("hdr") for _ in range(70))  # one header in very many texts, each going on differently
    docs += [(100 + i, header + "".join(rng.choice("uvw") for _ in range(50))) for i in range(40)]
    docs += [(200, pieces[0] * 4), (201, docs[5][1]), (202, None), (203, ""), (204, "a" * 300), (205, "b" + "a" * 299), (206, "ab" * 200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(shared_chars(df, span, width, group)) == brute(docs, span)


def test_defined_cases(spark):
    line = "0123456789" * 3
    schema = "doc_id long, text string, start string"
    df = spark.createDataFrame([(1, line * 2, "x"), (1, line * 2, None), (None, line, None), (2, line[:29], None)], schema)
    assert rows(shared_chars(df, 30, 8)) == []
    df = spark.createDataFrame([(1, line, "x"), (2, "ab" + line + "c", None), (2, "other text of the same document, long enough", None)], schema)
    assert rows(shared_chars(df, 30, 8)) == [(1, 30), (2, 30)]
    assert rows(shared_chars(df, 31, 8)) == []
    assert shared_chars(df.limit(0), 30, 8).count() == 0
    with pytest.raises(ValueError):
        shared_chars(df, 30, 30)


def test_long_text(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    df = spark.createDataFrame([(1, long), (2, "q" * 100 + long[40_000:41_000] + "q" * 5000), (3, long[59_700:])], "doc_id long, text string")
    assert rows(shared_chars(df)) == [(1, 1300), (2, 1000), (3, 300)]


def test_time_grows_with_the_text_only(spark):
    """Two texts that differ every 450 characters: a context is open at every difference."""

    def seconds(n):
        rng = random.Random(n)
        one = [rng.choice("abcdefghijklmnop ") for _ in range(n)]
        two = list(one)
        for i in range(225, n, 450):
            two[i] = "#"
        df = spark.createDataFrame([(1, "".join(one)), (2, "".join(two))], "doc_id long, text string").repartition(2).cache()
        df.count()
        at = time.time()
        got = rows(shared_chars(df))
        took = time.time() - at
        ends = [-1, *range(225, n, 450), n]
        want = sum(b - a - 1 for a, b in zip(ends, ends[1:]) if b - a - 1 >= 200)
        assert got == [(1, want), (2, want)]
        return took

    seconds(20_000)
    small, large = seconds(400_000), seconds(1_600_000)
    assert large < 4 * small + 4
