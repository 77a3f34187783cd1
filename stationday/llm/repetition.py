"""Quality rules from the repeated substrings of a text (suffix array).

The suffixes of every text are sorted by word, many texts at once: prefix
doubling on (text, word) ranks, in which only suffixes that are still tied take
part in the next round. The longest common prefix of neighbouring suffixes
follows from the ranks of each round. A word's longest repeat is the larger of
its two neighbours' prefixes, so the spans ``[p, p + longest[p])`` are the
maximal repeated substrings and their union is what repeats cover.

A text fails when repeats of ``min_repeat`` words or more cover more than
``max_covered`` percent of its words, or one repeat has more than
``max_longest`` words. The base rules (too few words, too many words in
repeated 3-word windows) come first.

NULL and empty texts have no words, fail the base rule and are not kept.
Columns other than doc_id and text are not looked at; rows with the same
doc_id are judged one by one; an empty table gives an empty result. A task
holds one slice of texts, or one longer text, at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationday.llm import words as W
from stationday.llm.common import map_texts, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_REPEAT = 10
MAX_COVERED = 45
MAX_LONGEST = 100

SYMBOLS = "#*$%&|<>"
STRIP = " \t\n\r\x0b\x0c"

SCHEMA = (
    "doc_id {id}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, n_covered_words bigint, longest_repeat bigint"
)


def longest_repeats(w: W.Words) -> np.ndarray:
    """For every word, the most words from it on that occur again in its text."""
    n = len(w.hash)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    whole = np.int32 if n < 1 << 31 else np.int64  # places and ranks are below n
    doc = w.doc
    stop = w.ptr[1:].astype(whole)[doc]
    order = np.lexsort((w.hash, doc)).astype(whole)
    new = np.ones(n, bool)
    new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    del doc
    starts = np.flatnonzero(new).astype(whole)
    rank = np.empty(n, whole)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    del new, starts
    h = 1
    tied = _tied(rank[order])
    first_word = rank.copy()
    while len(tied):
        at = order[tied]  # suffixes that share their first h words with another
        nxt = at + h
        key = np.full(len(at), -1, whole)
        inside = nxt < stop[at]
        key[inside] = rank[nxt[inside]]
        by = np.lexsort((key, rank[at]))
        at, key = at[by], key[by]
        del nxt, inside, by
        order[tied] = at
        old = rank[at]
        change = np.ones(len(at), bool)
        change[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(change)
        rank[at] = np.repeat(tied[first], np.diff(np.append(first, len(at))))
        del old, change, key
        h *= 2
        tied = tied[_tied(rank[at])]
    del rank
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(first_word[a] == first_word[b])
    a, b = a[near], b[near]
    lcp = common_prefixes(w.hash, a, b, stop, h)
    longest[a] = lcp  # each suffix has one neighbour before it and one behind
    longest[b] = np.maximum(longest[b], lcp)
    return longest


#: A prime below 2**61, so that products can be reduced in 64 bits.
PRIME = np.uint64((1 << 61) - 1)
_BASE = 0x1F3D5B79A2C4E687 % ((1 << 61) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b modulo ``PRIME``, by halves."""
    low = np.uint64((1 << 31) - 1)
    ah, al, bh, bl = a >> np.uint64(31), a & low, b >> np.uint64(31), b & low
    mid = ah * bl + al * bh
    mid = (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << np.uint64(31))
    return _reduced(_reduced((ah * bh << np.uint64(1)) + mid) + _reduced(al * bl))


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, step = 1, _BASE
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = _times(out[:more], np.uint64(step))
        step = step * step % int(PRIME)
        have += more
    return out


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray, most: int) -> np.ndarray:
    """How many words the suffixes at a and b share, less than ``most`` (a power
    of two), by halving steps over prefix sums of one polynomial. What is held is
    a few numbers for each word, however often the text repeats."""
    n = len(words)
    power = _powers(n)
    term = _times(_reduced(words), power)
    high = _reduced(np.cumsum(term >> np.uint64(31)))
    low = _reduced(np.cumsum(term & np.uint64((1 << 31) - 1)))
    del term
    sums = np.zeros(n + 1, np.uint64)
    sums[1:] = _reduced(_times(high, np.uint64(1 << 31)) + low)
    del high, low
    a, b = np.minimum(a, b), np.maximum(a, b)
    lcp, step = np.zeros(len(a), a.dtype), min(most // 2, 1 << (n.bit_length() - 1))
    while step:
        x, y = a + lcp, b + lcp
        at = np.flatnonzero((x + step <= stop[a]) & (y + step <= stop[b]))
        x, y = x[at], y[at]
        first = _reduced(sums[x + step] + PRIME - sums[x])
        second = _reduced(sums[y + step] + PRIME - sums[y])
        lcp[at[_times(first, power[y - x]) == second]] += step
        step //= 2
    return lcp


def _tied(sorted_rank: np.ndarray) -> np.ndarray:
    """Places whose rank equals a neighbour's."""
    same = sorted_rank[1:] == sorted_rank[:-1]
    t = np.zeros(len(sorted_rank), bool)
    t[1:] |= same
    t[:-1] |= same
    return np.flatnonzero(t)


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of ``least`` words or more."""
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:-1]) > 0


def _per_text(flags: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ptr[1:]] - sums[ptr[:-1]]


def duplicate_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(STRIP)]
    return len(lines) - len(set(lines))


def repetition(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, min_repeat: int = MIN_REPEAT, max_covered: int = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per row of docs, columns as in ``SCHEMA``."""
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        w = W.words(texts, lower=False)
        raw, offs = W.utf8(texts)
        n = w.counts
        point = (raw & 0xC0) != 0x80
        chars = _per_text(point & ~W._SPACE[raw], offs)
        longest = longest_repeats(w)
        repeat = _per_text(covered(longest, 3), w.ptr)
        cover = _per_text(covered(longest, min_repeat), w.ptr)
        most = np.zeros(len(n), np.int64)
        np.maximum.at(most, w.doc, longest)
        failed = (n < min_words) | (100 * repeat > max_repeat_percent * n)
        kept = ~failed & (100 * cover <= max_covered * n) & (most <= max_longest)
        lines = [duplicate_lines(t) for t in texts.to_pylist()]
        cols = [batch.column(0), n, chars, _per_text(symbol[raw], offs), lines, repeat, failed, kept, cover, most]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=NAMES)

    schema = SCHEMA.format(id=dict(docs.dtypes)["doc_id"])
    return map_texts(docs.select("doc_id", "text"), judge, schema)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered_words", "longest_repeat"]


def op10_repetition(spark, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents")).drop("longest_repeat")
