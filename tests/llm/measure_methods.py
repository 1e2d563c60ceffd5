"""python -m tests.llm.measure_methods SF_DIR: figures on two methods that were weighed, without Spark.

1. MinHash of whole documents for p7: how many hashes the true cases would need, by size class of the document.
2. Suffix automata of shards for p8: time and memory per character to build one and to stream texts through it.
"""

import sys
import time
import tracemalloc

import duckdb
import numpy as np

from roadloom.llm.queries import SQL


def whole_documents(con) -> None:
    pairs = con.execute(SQL["p7_found"]).fetchall()
    shingles = lambda table, key, col: dict(con.execute(f"select {key}, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: hash(lower(array_to_string(w[i:i + 4], ' '))))) from (select {key}, regexp_extract_all({col}, '[A-Za-z0-9_]+') as w from {table})").fetchall())
    docs, items = ({k: set(v) for k, v in shingles(*a).items()} for a in (("documents", "doc_id", "text"), ("eval_item", "item_id", "item_text")))
    rows = []
    for d, i in pairs:
        both = len(docs[d] & items[i])
        rows.append((len(docs[d]), both / len(items[i]), both / len(docs[d] | items[i])))
    size, containment, similarity = np.array(rows).T
    print(f"{len(rows)} cases; containment of the item below 0.8 in {np.mean(containment < 0.8):.2f} of them")
    for lo, hi in ((0, 100), (100, 400), (400, 1600), (1600, 1 << 40)):
        at = (size >= lo) & (size < hi)
        if at.any():
            j = similarity[at]
            recall = " ".join(f"{b}: {np.mean(1 - (1 - j) ** b):.3f}" for b in (16, 128, 1024))
            print(f"documents of {lo} to {hi} shingles: {at.sum()} cases, median similarity {np.median(j):.4f}, recall by hashes {recall}")


def automaton(con, chars: int = 500_000) -> None:
    text = "\0".join(t for (t,) in con.execute("select text from documents where text is not null order by doc_id").fetchall())[:chars]
    tracemalloc.start()
    at, link, length, step, last = time.time(), [-1], [0], [{}], 0
    for c in text:
        cur = len(length)
        length.append(length[last] + 1), link.append(0), step.append({})
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(length)
                length.append(length[p] + 1), link.append(link[q]), step.append(dict(step[q]))
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    built, held = time.time() - at, tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    at, state, match = time.time(), 0, 0
    for c in reversed(text):
        while state and c not in step[state]:
            state = link[state]
            match = length[state]
        if c in step[state]:
            state, match = step[state][c], match + 1
    print(f"automaton of {len(text)} characters: {built / len(text) * 1e6:.1f} us and {held / len(text):.0f} bytes a character (traced), {(time.time() - at) / len(text) * 1e6:.2f} us a character to stream")


if __name__ == "__main__":
    con = duckdb.connect()
    for table in ("documents", "eval_item"):
        con.execute(f"create view {table} as select * from '{sys.argv[1]}/{table}.parquet'")
    whole_documents(con)
    automaton(con)
