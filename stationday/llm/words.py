"""Words and word shingles of Arrow string columns as 64-bit hashes.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. All functions work on the
UTF-8 bytes of many texts at once, so a task's cost is a few array passes per
byte and no Python object is made per word. Texts are cut into groups of whole
rows (``row_slices``), so the memory of a task follows the group size or the
longest single text, not the size of the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * step) | np.uint64(1)


_BYTE = constants(256, 11)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i for i < n, for a slice at least, and kept."""
    if not _powers or len(_powers[0]) < n:
        size = max(SLICE_BYTES + 1, n)
        tables = []
        for p in (_P, _P_INV):
            t = np.full(size, p, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Words:
    """The words of some texts, in order. Text i has the words
    ``ptr[i]:ptr[i + 1]``; word j is ``data[start[j]:end[j]]``, hashed in
    ``hash[j]``."""

    data: np.ndarray
    ptr: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    @property
    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offset of each text; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each; one longer text
    is a range of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offs = utf8(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def words(texts: pa.Array, lower: bool = True, hashes: bool = True) -> Words:
    """Words of every text; ``lower`` folds A-Z only."""
    data, offs = utf8(texts)
    if lower:
        data = _FOLD[data]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    begins = inside[1:-1] & ~inside[:-2]
    first = offs[:-1][offs[:-1] < offs[1:]]
    begins[first] = inside[1:-1][first]
    ends = inside[1:-1] & ~inside[2:]
    last = offs[1:][offs[:-1] < offs[1:]] - 1
    ends[last] = inside[1:-1][last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    ptr = np.searchsorted(start, offs)
    if not hashes:
        return Words(data, ptr, start, end, np.zeros(0, np.uint64))
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return Words(data, ptr, start, end, mix((sums[end] - sums[start]) * down[start]))


def hash_words(ws: list[str]) -> np.ndarray:
    """Hashes of single words, as ``words`` gives them."""
    out = np.zeros(len(ws), np.uint64)
    for i, w in enumerate(ws):
        b = _FOLD[np.frombuffer(w.encode(), np.uint8)]
        out[i] = (_BYTE[b] * _power_tables(len(b) + 1)[0][: len(b)]).sum(dtype=np.uint64)
    return mix(out)


def shingles(w: Words, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of k words: (hash, text, first word). With
    ``short``, a text with 1 to k - 1 words gives its whole sequence."""
    weights = constants(k, 101)
    n = len(w.hash)
    m = max(0, n - k + 1)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out += w.hash[j : j + m] * weights[j]
    doc = w.doc
    whole = doc[:m] == doc[k - 1 : k - 1 + m] if k > 1 else np.ones(m, bool)
    pos = np.flatnonzero(whole)
    out, doc_of = mix(out[pos] + np.uint64(k)), doc[pos]
    if short:
        counts = w.counts
        few = np.flatnonzero((counts > 0) & (counts < k))
        if len(few):
            extra = np.zeros(len(few), np.uint64)
            for j in range(k - 1):
                has = counts[few] > j
                extra[has] += w.hash[w.ptr[few[has]] + j] * weights[j]
            extra = mix(extra + counts[few].astype(np.uint64))
            at = np.searchsorted(doc_of, few)
            out, pos = np.insert(out, at, extra), np.insert(pos, at, w.ptr[few])
            doc_of = np.insert(doc_of, at, few)
    return out, doc_of, pos


def order_per_text(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The order by (text, hash); doc must not fall."""
    if len(doc) and doc[-1] < 1 << 16:  # a few texts: by hash, then by text number, which is a radix sort
        order = np.argsort(h)
        return order[np.argsort(doc.astype(np.uint16)[order], kind="stable")]
    return np.lexsort((h, doc))


def distinct_per_text(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, sorted by text and hash."""
    order = order_per_text(h, doc)
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
