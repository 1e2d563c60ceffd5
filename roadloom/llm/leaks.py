"""Evaluation items whose passages stand in corpus texts: MinHash containment search by size, then exact shingles.

Containment search by MinHash needs sets of like sizes: a set of k shingles inside one of n has a similarity of k / n, so
a passage in a long text is found only by about n / k hashes. Both sides are therefore partitioned into stretches of one
size, the least passage that counts. A passage contained in a text equals one of its stretches, their similarity is 1 and
one MinHash finds it for certain. Neighbouring stretches mostly have the same MinHash, so only every fourth or fifth
place of a text is looked up at all, and only places with an equal MinHash in an item are verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.text import chunks, mix, words

#: Words of the least passage that counts as leaked.
PASSAGE = 12
#: Words of the shingles that MinHash runs over.
SHINGLE = 5
#: Characters of items that one index holds; more items take several indexes, one pass over the corpus each. An index
#: takes about 7 bytes a character (measured in tests/llm/test_leaks.py), in the driver and in every Python worker.
INDEX_CHARS = 16_000_000
_CHUNK = 1 << 20
#: Candidates that are verified at a time.
_PAIRS = 1 << 18


def _runs(value: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    n = len(value) - width + 1
    if n <= 0:
        return value[:0]
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + value[k : k + n]
    return mix(total)


def minhashes(value: np.ndarray, text: np.ndarray, passage: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The MinHashes of all stretches of ``passage`` words inside one text: the shingle of least hash, the first of
    equals, as its first word's number, and that hash. A shingle that many stretches share is given once."""
    hashes, wide = _runs(value, shingle), passage - shingle + 1
    n = len(value) - passage + 1
    if n <= 0:
        return np.zeros(0, np.int64), value[:0]
    least, at = hashes[:n].copy(), np.zeros(n, np.int64)
    for k in range(1, wide):
        less = hashes[k : k + n] < least
        least[less], at[less] = hashes[k : k + n][less], k
    place = (at + np.arange(n))[text[:n] == text[passage - 1 :]]
    place = place[np.r_[True, place[1:] != place[:-1]]] if len(place) else place  # places never go back
    return place, hashes[place]


_SEPARATORS = bytes(b if chr(b) in "0123456789_abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))


def _passage(data: bytes, start: int, end: int) -> bytes:
    """The words of a stretch in lower case, one space between them."""
    return b" ".join(data[start:end].lower().translate(_SEPARATORS).split())


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for every value in every row's range."""
    n = hi - lo
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]


class LeakIndex:
    """The words of a bounded set of items, and the MinHashes of their stretches in order.

    Places with one MinHash and equal words all round it, as items that repeat each other have, are one entry with
    several places, and are verified once.
    """

    def __init__(self, items: list[tuple[int, str]], passage: int = PASSAGE, shingle: int = SHINGLE):
        self.passage, self.shingle = passage, shingle
        parts, data, texts = [], [], 0
        with np.errstate(over="ignore"):
            for part in chunks(items, lambda r: len(r[1]), _CHUNK):
                value, text, start, end, raw = words([t for _, t in part])
                base = sum(map(len, data))
                parts.append((value, (text + texts).astype(np.int32), (start + base).astype(np.int32), (end + base).astype(np.int32)))
                data.append(raw)
                texts += len(part)
            none = (np.zeros(0, np.uint64), *(np.zeros(0, np.int32) for _ in range(3)))
            self.value, self.text, self.start, self.end = (np.concatenate(c) for c in zip(none, *parts))
            self.data, self.ids = b"".join(data), np.array([i for i, _ in items], np.int64)
            whole = _runs(self.value, passage)
            self.stretch = np.unique(whole, return_inverse=True)[1].astype(np.int32) if len(whole) else np.zeros(0, np.int32)
            place, low = minhashes(self.value, self.text, passage, shingle)
            around = self._around(self.value, self.text, place)[0]
            context = mix((around * (np.arange(around.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(0xD6E8FEB86659FD93))).sum(1, dtype=np.uint64))
        order = np.lexsort((context, low))
        low, context, self.place = low[order], context[order], place[order].astype(np.int32)
        new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (context[1:] != context[:-1])]) if len(low) else np.zeros(0, np.int64)
        self.low, self.first = low[new], np.r_[new, len(low)].astype(np.int64)

    def _around(self, value: np.ndarray, text: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words that a stretch with its MinHash at a place can have, and which of them are in the place's text."""
        reach = self.passage - self.shingle
        at = place[:, None] + np.arange(-reach, self.passage)
        at_safe = np.clip(at, 0, max(len(value) - 1, 0))
        inside = (at == at_safe) & (text[at_safe] == text[place][:, None])
        return np.where(inside, value[at_safe], np.uint64(0)), inside

    def search(self, docs: list[tuple[int, str]]) -> dict[tuple[int, int], int]:
        """How many different passages each document shares with each item."""
        value, text, start, end, data = words([t for _, t in docs])
        place, low = minhashes(value, text, self.passage, self.shingle)
        lo, hi = np.searchsorted(self.low, low, side="left"), np.searchsorted(self.low, low, side="right")
        near = np.flatnonzero(hi > lo)
        found: set[tuple[int, int, int]] = set()
        cuts = np.searchsorted(np.cumsum((hi - lo)[near]), np.arange(_PAIRS, (hi - lo)[near].sum() + _PAIRS, _PAIRS))
        for some in np.split(near, cuts):
            self._verify(some, lo, hi, place, value, text, start, end, data, found)
        out: dict[tuple[int, int], int] = {}
        for doc, item, _ in found:
            out[docs[doc][0], item] = out.get((docs[doc][0], item), 0) + 1
        return out

    def _verify(self, some, lo, hi, place, value, text, start, end, data, found) -> None:
        row, entry = _ranges(lo[some], hi[some])
        if not len(row):
            return
        p, q = place[some][row], self.place[self.first[entry]].astype(np.int64)
        (mine, here), (theirs, there) = self._around(value, text, p), self._around(self.value, self.text, q)
        same, reach = (mine == theirs) & here & there, self.passage - self.shingle
        ahead = np.logical_and.accumulate(same[:, reach:], axis=1).sum(1)
        back = np.logical_and.accumulate(same[:, reach - 1 :: -1] if reach else same[:, :0], axis=1).sum(1)
        for i in np.flatnonzero((ahead >= self.shingle) & (ahead + back >= self.passage)).tolist():
            a, b, n = int(p[i] - back[i]), int(q[i] - back[i]), int(ahead[i] + back[i])
            if _passage(data, int(start[a]), int(end[a + n - 1])) != _passage(self.data, int(self.start[b]), int(self.end[b + n - 1])):
                continue
            doc, kinds = int(text[p[i]]), self.stretch[b : b + n - self.passage + 1].tolist()
            for item in set(self.ids[self.text[self.place[self.first[entry[i]] : self.first[entry[i] + 1]]]].tolist()):
                found.update((doc, item, k) for k in kinds)


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for part in chunks(rows, lambda r: len(r[1]), _CHUNK):
                    if found := known.search(part):
                        docs, items = zip(*found)
                        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(list(found.values()), pa.int64())], ["doc_id", "item_id", "passages"])

    return run


def leaked_items(documents: DataFrame, items: DataFrame, passage: int = PASSAGE, index_chars: int = INDEX_CHARS) -> DataFrame:
    """(doc_id, item_id, passages): documents and items that have at least ``passage`` consecutive words in common, and
    how many different passages of just that length they share.

    Items are a query set: their texts are indexed in blocks of about ``index_chars`` characters (measured before
    anything is fetched), each block's index is broadcast and the corpus is streamed against it. The documents are
    never shuffled, and a text of any length is searched whole. Candidates are places with an equal MinHash; they are
    verified word by word round that place, first by the words' hashes and then by the words themselves.

    Null, empty and too short texts share nothing. Items that share a passage each count; repeated rows of a document or
    item change nothing; rows without id are left out; other columns are ignored; no items give no rows.
    """
    spark = documents.sparkSession
    texts = items.select("item_id", "item_text").where(F.col("item_id").isNotNull() & F.col("item_text").isNotNull())
    total = texts.agg(F.sum(F.length("item_text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / index_chars))
    docs = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    every = None
    for block in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else texts
        index = spark.sparkContext.broadcast(LeakIndex([(r[0], r[1]) for r in part.collect()], passage))
        hits = docs.mapInArrow(_search(index), "doc_id bigint, item_id bigint, passages bigint")
        every = hits if every is None else every.unionByName(hits)
    return every.groupBy("doc_id", "item_id").agg(F.max("passages").alias("passages"))
