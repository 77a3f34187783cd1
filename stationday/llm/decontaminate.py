"""Benchmark decontamination: SimHash of item-sized windows, then exact overlap.

Items and documents are word sequences (A-Z folded); shingles have ``K`` words,
fewer only for an item that is shorter. A shingle weighs the bytes of its
words. An item of n words is compared with the windows of n words of a
document, and a document of fewer words with its whole text as the one window
(so a copy that lacks its last words is found too): both have a 64-bit SimHash of their weighted shingles, and a window is
a candidate for every item of its size within ``RADIUS`` bits. The index is
multi-index Hamming: fingerprints are cut into ``BLOCKS`` blocks, and two that
differ in at most ``RADIUS`` bits agree up to ``RADIUS // BLOCKS`` bits in one
block, so each item is filed under all block values that near and a window
looks up its own blocks: no fingerprint within the radius is missed. Candidates
are verified exactly: the similarity is the weight of the item's shingles
(with repeats) that the window holds, divided by the weight of all of them, and
``LEAST`` or more is contamination.

Windows without any of the benchmark's shingles have similarity 0 and are not
fingerprinted; all others are, over whole texts. Of texts shorter than the item
those are, once for all sizes, whose shingles of the benchmark weigh enough to
reach ``LEAST`` of the lightest item; no other one can.

The benchmark is small against the corpus: its items go to the tasks in parts
of at most ``PART_BYTES`` bytes of text, each part one pass over the documents,
so what is broadcast is bounded whatever the benchmark's size. Documents are
never shuffled.

NULL and empty texts match nothing, nor do items without words. Rows that share
a doc_id are searched one by one; an item that repeats another is reported
besides it. Empty tables give an empty result. Of docs only doc_id and text are
looked at, of the benchmark item_id and text.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationday.llm import words as W
from stationday.llm.common import map_texts, on_workers, table

K = 5
LEAST = 0.8
RADIUS = 23
BLOCKS = 8
PART_BYTES = 4 << 20

_BITS = 64 // BLOCKS
_POPCOUNT = np.array([bin(x).count("1") for x in range(1 << _BITS)], np.uint8)


def shingle_stream(w: W.Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, weight, text) of the shingle that begins at each word; those
    that would leave their text have weight 0."""
    n = len(w.hash)
    weights = W.constants(k, 101)
    h = np.zeros(n, np.uint64)
    bytes_ = np.zeros(n, np.int64)
    size = w.end - w.start
    for j in range(min(k, n)):
        h[: n - j] += w.hash[j:] * weights[j]
        bytes_[: n - j] += size[j:]
    doc = w.doc
    inside = np.arange(n) + k <= w.ptr[1:][doc]
    return W.mix(h + np.uint64(k)), np.where(inside, bytes_, 0), doc


def _signs(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The weighted +1/-1 bits of shingles, one row each."""
    bits = (h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return np.where(bits == 1, weight[:, None], -weight[:, None])


def _packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return sum(_POPCOUNT[(x >> np.uint64(i * _BITS) & np.uint64((1 << _BITS) - 1)).astype(np.int64)].astype(np.int64) for i in range(BLOCKS))


class Index:
    """Items of one size: fingerprints under all near block values."""

    def __init__(self, n: int, items: list[int], k: int, h: list[np.ndarray], weight: list[np.ndarray]):
        self.n, self.k, self.items = n, k, items
        self.prints = np.array([_packed(_signs(a, b).sum(axis=0)[None, :])[0] for a, b in zip(h, weight)], np.uint64)
        self.known = np.unique(np.concatenate(h))
        self.total = [int(b.sum()) for b in weight]
        self.bags = []
        for a, b in zip(h, weight):
            values, first, counts = np.unique(a, return_index=True, return_counts=True)
            self.bags.append((values, b[first], counts))
        near = np.flatnonzero(_POPCOUNT <= RADIUS // BLOCKS)
        self.blocks = []
        for i in range(BLOCKS):
            own = (self.prints >> np.uint64(i * _BITS) & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            value = (own[:, None] ^ near[None, :]).ravel()
            item = np.repeat(np.arange(len(items)), len(near))
            order = np.argsort(value, kind="stable")
            self.blocks.append((np.searchsorted(value[order], np.arange((1 << _BITS) + 1)).astype(np.int32), item[order].astype(np.int32)))

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, each once."""
        found = []
        for i, (starts, items) in enumerate(self.blocks):
            v = (prints >> np.uint64(i * _BITS) & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            counts = starts[v + 1] - starts[v]
            window = np.repeat(np.arange(len(prints)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            found.append(window * len(self.items) + items[np.repeat(starts[v], counts) + place])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(self.items), pairs % len(self.items)
        near = _distance(prints[window], self.prints[item]) <= RADIUS
        return window[near], item[near]

    def overlap(self, item: int, h: np.ndarray) -> float:
        values, weight, counts = self.bags[item]
        at = np.minimum(np.searchsorted(values, h), len(values) - 1)
        held = np.bincount(at[values[at] == h], minlength=len(values))
        return float((weight * np.minimum(held, counts)).sum()) / self.total[item]


def build(items: list[tuple]) -> list[Index]:
    """One index for each item size, from (item_id, text) rows; items are named
    by their place in the list."""
    w = W.words(pa.array([t for _, t in items], pa.string()))
    by_size: dict[int, list[int]] = {}
    for i, n in enumerate(w.counts.tolist()):
        if n:
            by_size.setdefault(n, []).append(i)
    out = []
    for n, rows in sorted(by_size.items()):
        k = min(K, n)
        h, weight, _ = shingle_stream(w, k)
        cut = [slice(w.ptr[i], w.ptr[i + 1] - k + 1) for i in rows]
        out.append(Index(n, rows, k, [h[c] for c in cut], [weight[c] for c in cut]))
    return out


_FILTER_BITS = 20


def _filters(indexes: list[Index]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each shingle size the benchmark's shingles and a table of their
    upper bits, which rules out nearly all others with one look-up."""
    out = {}
    for k in {x.k for x in indexes}:
        known = np.unique(np.concatenate([x.known for x in indexes if x.k == k]))
        quick = np.zeros(1 << _FILTER_BITS, bool)
        quick[(known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        out[k] = (known, quick)
    return out


def _among(sorted_: np.ndarray, h: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, h), len(sorted_) - 1)] == h


def search(texts: pa.Array, indexes: list[Index], filters: dict) -> list[tuple[int, int, float, int]]:
    """(text, item, similarity, first word) of the best window of each item in
    each text that reaches ``LEAST``."""
    w = W.words(texts)
    size = w.counts
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for k, (known, quick) in filters.items():
        if len(w.hash) < k:
            continue
        h, weight, doc = shingle_stream(w, k)
        at = np.flatnonzero(quick[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & (weight > 0))
        at = at[_among(known, h[at])]
        if not len(at):
            continue
        whole: dict[int, np.uint64] = {}
        for index in indexes:
            if index.k != k:
                continue
            own = at[_among(index.known, h[at])]
            if not len(own):
                continue
            for text, item in _short(index, h, weight, w.ptr, size, doc, own, whole):
                s = index.overlap(item, h[w.ptr[text] : w.ptr[text + 1] - k + 1])
                if s >= LEAST:
                    best[text, index.items[item]] = (s, int(w.ptr[text]))
            m = index.n - k + 1  # shingles of a window
            begins = _begins(own, m, w.ptr[doc[own]], w.ptr[doc[own] + 1] - index.n)
            if not len(begins):
                continue
            for window, item in _windows(index, h, weight, begins, m):
                text = int(doc[window])
                s = index.overlap(item, h[window : window + m])
                if s >= LEAST:
                    key = (text, index.items[item])
                    if key not in best or (s, -window) > (best[key][0], -best[key][1]):
                        best[key] = (s, int(window))
    return [(t, i, s, p - int(w.ptr[t])) for (t, i), (s, p) in sorted(best.items())]


def _begins(own: np.ndarray, m: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where windows of m shingles begin that hold a place of ``own`` (rising),
    between ``first`` and ``last`` of the place's text: the union of intervals,
    so the work follows the result and not the item's length."""
    lo, hi = np.maximum(own - m + 1, first), np.minimum(own, last)
    lo[1:] = np.maximum(lo[1:], np.maximum.accumulate(hi)[:-1] + 1)
    size = np.maximum(hi - lo + 1, 0)
    return np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _short(index: Index, h: np.ndarray, weight: np.ndarray, ptr: np.ndarray, size: np.ndarray, doc: np.ndarray, own: np.ndarray, whole: dict[int, np.uint64]):
    """Candidates among the texts with fewer words than the items: (text, item).
    ``own`` are the places of the index's shingles; ``whole`` keeps the texts'
    fingerprints."""
    own = own[size[doc[own]] < index.n]
    if not len(own):
        return
    held = np.bincount(doc[own], weight[own])
    texts = np.flatnonzero((held > 0) & (held / min(index.total) >= LEAST))
    for t in texts.tolist():
        if t not in whole:
            sums = np.zeros(64, np.int64)
            end = ptr[t + 1] - index.k + 1
            for lo in range(ptr[t], end, 4096):
                part = slice(lo, min(lo + 4096, end))
                sums += _signs(h[part], weight[part]).sum(axis=0)
            whole[t] = _packed(sums[None, :])[0]
    if len(texts):
        window, item = index.candidates(np.array([whole[t] for t in texts.tolist()], np.uint64))
        yield from zip(texts[window].tolist(), item.tolist())


def _windows(index: Index, h: np.ndarray, weight: np.ndarray, begins: np.ndarray, m: int):
    """Candidates among the windows at ``begins``, which are fingerprinted from
    running sums, stretch by stretch."""
    cuts = np.flatnonzero(np.diff(begins) > m) + 1
    for part in np.split(begins, cuts):
        for lo in range(0, len(part), 4096):
            own = part[lo : lo + 4096]
            first, last = own[0], own[-1] + m
            sums = np.zeros((last - first + 1, 64), np.int64)
            np.cumsum(_signs(h[first:last], weight[first:last]), axis=0, out=sums[1:])
            window, item = index.candidates(_packed(sums[own - first + m] - sums[own - first]))
            yield from zip(own[window].tolist(), item.tolist())


def benchmark_parts(bench: DataFrame) -> list[list[tuple]]:
    """The benchmark's rows in parts of about ``PART_BYTES``, one at a time."""
    rows = bench.filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // PART_BYTES))
    for p in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == p) if n > 1 else rows
        yield sorted(((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()), key=lambda r: (r[0] is not None, r[0], r[1]))


def contamination(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words): for every document
    and item with a window that reaches ``LEAST``, the best and first such;
    n_words are the item's, of which a shorter document holds fewer."""
    spark = docs.sparkSession
    on_workers(spark)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(bench.dtypes)['item_id']}, similarity double, first_word bigint, n_words bigint"
    item_type = pa.schema(bench.sparkSession.createDataFrame([], bench.select("item_id").schema).toArrow().schema).field(0).type

    def found(items: list[tuple]) -> DataFrame:
        indexes = build(items)
        sizes = {i: x.n for x in indexes for i in x.items}
        shared = spark.sparkContext.broadcast((indexes, _filters(indexes), [i for i, _ in items], sizes))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            idx, filters, names, n = shared.value
            hits = search(batch.column(1), idx, filters)
            if not hits:
                return None
            text, item, s, p = zip(*hits)
            cols = [batch.column(0).take(pa.array(text)), pa.array([names[i] for i in item], item_type), pa.array(s, pa.float64()), pa.array(p, pa.int64()), pa.array([n[i] for i in item], pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        return map_texts(docs.select("doc_id", "text"), run, schema)

    return reduce(DataFrame.unionByName, (found(items) for items in benchmark_parts(bench)))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    spark = docs.sparkSession
    on_workers(spark)
    names = docs.columns

    def without(rows: DataFrame, items: list[tuple]) -> DataFrame:
        indexes = build(items)
        shared = spark.sparkContext.broadcast((indexes, _filters(indexes)))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            idx, filters = shared.value
            hits = {t for t, _, _, _ in search(batch.column(names.index("text")), idx, filters)}
            return batch.filter(pa.array([i not in hits for i in range(batch.num_rows)], pa.bool_())) if hits else batch

        return map_texts(rows, run, rows.schema)

    return reduce(without, benchmark_parts(bench), docs)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
