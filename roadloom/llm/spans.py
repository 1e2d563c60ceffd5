"""Long exact spans that texts share, by content-chosen anchors and the windows round them.

A suffix automaton of reference shards, broadcast to a stream of all documents, cannot do this at size: every shard
meets every document, so the steps are shards times corpus, and an automaton has tens of bytes of state per character.
Here shards are formed by content instead: a window of the least span length names one anchor inside it, equal windows
name equal anchors, so a span can only be shared inside the shard of an anchor, and each text meets only the shards of
its own anchors. Within a shard the matching is exact for every window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.text import Rolling, chunks, code_points, mix, sliding_min
from roadloom.operators.skew import relay_join
from roadloom.storage import Scratch

SPAN = 200
#: Characters of an anchor. Longer ones are rarer by chance; there are about 2 / (SPAN - ANCHOR) anchors a character.
ANCHOR = 64
#: Contexts of one anchor that one task compares. An anchor with more is split and merged by its windows' hashes.
GROUP = 20_000
_CHUNK = 1 << 19
_LOW = np.uint64((1 << 22) - 1)


def anchors(points: np.ndarray, bounds: np.ndarray, span: int, width: int) -> tuple[np.ndarray, ...]:
    """The anchors of texts in a row: (text, first window, last window, anchor hash, context hash).

    Each window of ``span`` characters takes the ``width`` characters inside it with the least hash, the first of
    equals. A run of windows with one anchor is its context; the context hash covers its text and the anchor's place
    in it.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(points) < span:
        return none
    rolling = Rolling(points)
    grams = rolling.every(width)
    packed, offset = grams & ~_LOW, np.arange(len(grams), dtype=np.uint64)
    at = []
    stretch = 1 << 22  # places within a stretch fit the low bits; longer texts go by overlapping stretches
    windows = len(points) - span + 1
    for lo in range(0, windows, stretch // 2):
        part = slice(lo, min(lo + stretch // 2 + span - width, len(grams)))
        at.append((sliding_min(packed[part] | (offset[part] - np.uint64(lo)), span - width + 1) & _LOW).astype(np.int64) + lo)
    chosen = np.concatenate(at)[:windows]
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = np.flatnonzero(text[:windows] == text[span - 1 :])
    if not len(inside):
        return none
    chosen, text = chosen[inside], text[inside]
    first = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])
    lo, hi = inside[first], inside[np.r_[first[1:] - 1, len(inside) - 1]]
    place = chosen[first]
    shape = mix(((place - lo) * 4096 + (hi - lo)).astype(np.uint64))
    return text[first], lo, hi, grams[place], mix(rolling.of(lo, hi + span) + shape)


def _anchor_rows(span: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for part in chunks((r for r in rows if len(r[1]) >= span), lambda r: len(r[1]), _CHUNK):
                    points, bounds = code_points([t for _, t in part])
                    text, lo, hi, anchor, context = anchors(points, bounds, span, width)
                    doc = np.array([d for d, _ in part], np.int64)[text]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(doc), pa.array((lo - bounds[text]).astype(np.int32)), pa.array((hi - lo + 1).astype(np.int32))],
                        ["anchor", "context", "doc_id", "lo", "n"],
                    )

    return run


CUT = "anchor bigint, context bigint, salt int, split boolean, doc_lo bigint, doc_hi bigint, lo int, n int, again boolean, text string"


def _cut_out(span: int):
    """Texts with the places wanted of each -> the texts of these places. A text is gone through once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts, places = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).flatten()
            of = np.repeat(np.arange(len(docs)), batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            lo, n = (places.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "n"))
            end = lo + n + span - 1
            size = np.cumsum(end - lo)
            cuts = np.r_[0, np.flatnonzero(np.diff(size // _CHUNK)) + 1, len(of)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a < b:
                    text = [texts[i][x:y] for i, x, y in zip(of[a:b].tolist(), lo[a:b].tolist(), end[a:b].tolist())]
                    part = places.slice(a, b - a)
                    own = {"doc_lo": pa.array(docs[of[a:b]]), "text": pa.array(text, pa.string())}
                    yield pa.RecordBatch.from_arrays([own[c] if c in own else part.field(c) for c in _CUT_NAMES], _CUT_NAMES)

    return run


_CUT_NAMES = [c.split()[0] for c in CUT.split(", ")]


def _window_keys(texts: list[str], counts: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """(context number, window number, window hash) of all windows of contexts. Equal windows of one anchor hold it at
    equal places, so the window's text alone decides."""
    points, bounds = code_points(texts)
    every = Rolling(points).every(span)
    of = np.repeat(np.arange(len(texts)), counts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of, k, every[bounds[of] + k]


def _match(span: int, width: int):
    """Contexts, whole (anchor, salt) groups in one partition -> shared stretches of those that one document has, and,
    for anchors that are split over salts, the windows left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows < 2000:
                continue
            a, s = table["anchor"].to_numpy(), table["salt"].to_numpy()
            cut = np.flatnonzero((a[1:] != a[:-1]) | (s[1:] != s[:-1]))
            if len(cut):  # the last group may go on in the next batch
                yield from _matched(table.slice(0, cut[-1] + 1), span, width)
                table = table.slice(cut[-1] + 1)
            held = table.to_batches()
        if held:
            yield from _matched(pa.Table.from_batches(held, schema=held[0].schema), span, width)

    return run


def _matched(table: pa.Table, span: int, width: int) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    with np.errstate(over="ignore"):
        texts, n = table["text"].to_pylist(), table["n"].to_numpy()
        # a document given under one id with several texts meets each; only the text that the context is from counts
        points, bounds = code_points(texts)
        at, first, last, _, context = anchors(points, bounds, span, width)
        same = (first == bounds[at]) & (last - first + 1 == n[at]) & (context.view(np.int64) == table["context"].to_numpy()[at])
        table = table.take(pa.array(np.unique(at[same])))
        if not table.num_rows:
            return
        anchor, split, lo_doc, hi_doc, lo, n = (table[c].to_numpy() for c in ("anchor", "split", "doc_lo", "doc_hi", "lo", "n"))
        of, k, key = _window_keys(table["text"].to_pylist(), n, span)
        key = mix(key ^ mix(anchor.view(np.uint64))[of])
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        head = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]])
        least, most = np.minimum.reduceat(lo_doc[of][order], head), np.maximum.reduceat(hi_doc[of][order], head)
        group = np.empty(len(key), np.int64)
        group[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(key)]))
        single = lo_doc == hi_doc  # contexts that several documents hold are shared as a whole; here they only provide
        shared = (least < most)[group] & single[of]
        run = np.flatnonzero(shared)
        if len(run):
            new = np.r_[True, (run[1:] != run[:-1] + 1) | (of[run[1:]] != of[run[:-1]])]
            first, last = run[new], run[np.r_[np.flatnonzero(new)[1:] - 1, len(run) - 1]]
            yield _spans(table, of[first], lo[of[first]] + k[first], lo[of[last]] + k[last] + span)
        if split.any():
            tell = split[of]
            unsettled = np.flatnonzero(tell & ~shared & single[of])
            offered = head[np.flatnonzero(np.isin(np.arange(len(head)), group[tell]))]
            g = group[order[offered]]
            none = np.full(len(g), -1)
            yield _spans(table, of[order[offered]], none, none, sorted_key[offered], least[g], most[g])
            begin = lo[of[unsettled]] + k[unsettled]
            yield _spans(table, of[unsettled], begin, begin + span, key[unsettled])


MATCHED = "doc_id bigint, start int, end int, key bigint, other bigint, anchor bigint, context bigint, lo int, again boolean"


def _spans(table: pa.Table, of: np.ndarray, start: np.ndarray, end: np.ndarray, key=None, doc=None, other=None) -> pa.RecordBatch:
    """Stretches of the contexts numbered ``of``, or with ``doc`` and ``other`` the documents that offer a window."""
    n = len(of)
    maybe = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x.view(np.int64))
    take = lambda c: table[c].combine_chunks().take(pa.array(of))
    cols = [take("doc_lo") if doc is None else pa.array(doc), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), maybe(key), maybe(other)]
    return pa.RecordBatch.from_arrays([*cols, take("anchor"), take("context"), take("lo"), take("again")], ["doc_id", "start", "end", "key", "other", "anchor", "context", "lo", "again"])


def shared_spans(documents: DataFrame, span: int = SPAN, width: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """(doc_id, start, end): stretches of each text, in code points, of which every window of ``span`` characters also
    stands in a text with another doc_id. Stretches of one document may overlap; together they cover all shared spans.

    1. One pass over the texts gives their anchors, with a hash of each anchor's context.
    2. Anchors that only one document has are dropped: least and greatest document per anchor, aggregated in part
       before the shuffle, then a semi join, whose frequent keys the adaptive skew join splits.
    3. Contexts that several documents hold are shared as they stand. That settles nearly all of the shared text
       without looking at it again.
    4. The others, at the ends of shared spans, are fetched once per distinct context and compared by their windows'
       hashes within their anchor's group. A group with more than ``group`` contexts is split over salts, and the
       windows still open there meet through an aggregate by hash.

    Equality is by hashes of anchor and window together, 128 bits. Null and short texts share nothing; a passage
    repeated only inside one document is not shared; rows under one id count as one document, whose stretches in several
    texts are united by place; null ids are left out; other columns are ignored.
    """
    if not 0 < width < span <= 4096:
        raise ValueError("an anchor must be shorter than the span, and the span at most 4096")
    store = Scratch(documents.sparkSession, "spans")
    docs = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") >= span))
    every = store.save(docs.mapInArrow(_anchor_rows(span, width), "anchor bigint, context bigint, doc_id bigint, lo int, n int"), "anchors")
    common = every.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).where("_a < _b").select("anchor")
    near = store.save(every.join(common, "anchor", "left_semi"), "near")
    store.drop("anchors")
    context = near.groupBy("anchor", "context").agg(F.min(F.struct("doc_id", "lo", "n")).alias("_at"), F.max("doc_id").alias("doc_hi"), (F.count("*") > 1).alias("again"))
    context = store.save(context.select("anchor", "context", F.col("_at.doc_id").alias("doc_lo"), "doc_hi", "_at.lo", "_at.n", "again"), "contexts")
    held = context.where("doc_lo < doc_hi").select("anchor", "context", F.lit(True).alias("whole"))
    whole = relay_join(near, held, ["anchor", "context"], F.struct("doc_id", "lo")).where("whole").select("doc_id", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + span).alias("end"))
    # only anchors with an open context need their texts
    sizes = context.groupBy("anchor").agg(F.count("*").alias("size"), F.max(F.expr("doc_lo = doc_hi")).alias("open")).where("open and size > 1").drop("open")
    open_ = relay_join(context, sizes, ["anchor"], F.col("context")).where("size is not null")
    parts = F.ceil(F.col("size") / F.lit(group))
    open_ = open_.select("anchor", "context", F.when(parts > 1, F.pmod(F.xxhash64("context"), parts)).otherwise(0).cast("int").alias("salt"), (parts > 1).alias("split"), "doc_lo", "doc_hi", "lo", "n", "again")
    # all places of one document in one row, as its text is, and cut out of the text in one pass
    place = F.struct("anchor", "context", "salt", "split", "doc_hi", "lo", "n", "again")
    wanted = store.save(open_.groupBy("doc_lo").agg(F.collect_list(place).alias("places")), "wanted")
    cut = docs.withColumnRenamed("doc_id", "doc_lo").join(wanted, "doc_lo").select("doc_lo", "text", "places").mapInArrow(_cut_out(span), CUT)
    found = cut.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    found = store.save(found.mapInArrow(_match(span, width), MATCHED), "matched")
    offers = found.where("start < 0").groupBy("key").agg(F.min("doc_id").alias("_a"), F.max("other").alias("_b")).where("_a < _b").select("key", F.lit(True).alias("hit"))
    late = relay_join(found.where("start >= 0 and key is not null"), offers, ["key"], F.struct("doc_id", "start")).where("hit")
    settled = found.where("key is null").unionByName(late.select(*found.columns))
    # a document may hold a context at several places; one stood for all of them
    places = near.select("anchor", "context", F.col("lo").alias("at"))
    more = settled.where("again").join(places, ["anchor", "context"]).where("at <> lo").select("doc_id", (F.col("start") - F.col("lo") + F.col("at")).alias("start"), (F.col("end") - F.col("lo") + F.col("at")).alias("end"))
    return whole.unionByName(settled.select("doc_id", "start", "end")).unionByName(more)


def shared_chars(documents: DataFrame, span: int = SPAN, width: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """(doc_id, shared_chars): how many characters of each document lie in spans of at least ``span`` characters that
    another document holds verbatim; only documents with any. Cases are those of ``shared_spans``."""
    line = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gain = F.greatest(F.col("end") - F.greatest(F.col("start"), before), F.lit(0))
    covered = shared_spans(documents, span, width, group).withColumn("gain", gain)
    return covered.groupBy("doc_id").agg(F.sum("gain").cast("bigint").alias("shared_chars"))
