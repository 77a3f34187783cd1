"""One text of 5 MB: what a task holds for it stays a few numbers a word."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from stationday.llm import decontaminate, katz, language, ngram_join, quality, repetition, toxicity
from stationday.llm import words as W

RNG = random.Random(11)
WORDS = [f"w{i:04x}" for i in range(5000)]
PLAIN = " ".join(RNG.choice(WORDS) for _ in range(830_000))
REPEATED = " ".join(["ab cde fg hij"] * 380_000)


def peak(fn) -> float:
    """MB that a call holds at most."""
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module", params=["plain", "repeated"])
def text(request):
    out = {"plain": PLAIN, "repeated": REPEATED}[request.param]
    assert 4.9e6 < len(out) < 5.5e6
    return out


def test_repetition_memory(text):
    w = W.words(pa.array([text]))
    assert peak(lambda: repetition.longest_repeats(w)) < 200e-6 * len(w.hash)


def test_longest_repeats_of_a_repeated_text():
    w = W.words(pa.array(["x " + " ".join(["a b c"] * 20_000), "a b"]))
    got = repetition.longest_repeats(w)
    assert got[0] == 0 and got[1] == 59_997 and got[4] == 59_997 and got[-2:].tolist() == [0, 0]


def test_products_modulo_the_prime():
    p = int(repetition.PRIME)
    x = [0, 1, 2, 5, p - 1, p - 2, 2**60 + 12345, 2**31, 2**31 - 1]
    for i in x:
        got = repetition._times(np.array(x, np.uint64), np.uint64(i))
        assert got.tolist() == [i * j % p for j in x]
    assert repetition._powers(9).tolist() == [pow(repetition._BASE, i, p) for i in range(9)]


def test_decontamination_memory_of_long_items():
    """An item of 6,000 words, and the long text that holds most of it."""
    own = PLAIN.split()
    item = own[1000:7000]
    changed = list(own)
    for i in range(1000, 7000, 100):
        changed[i] = "other"
    texts = pa.array([" ".join(changed), " ".join(item), "short"])
    indexes = decontaminate.build([(1, " ".join(item))])
    found = []
    used = peak(lambda: found.extend(decontaminate.search(texts, indexes, decontaminate._filters(indexes))))
    hits = {t: s for t, _, s, _ in found}
    assert hits[1] == 1.0 and 0.8 <= hits[0] < 1
    assert used < 400


def test_window_starts_are_the_union_of_intervals():
    for _ in range(50):
        ends = np.cumsum([0, *(RNG.randrange(0, 30) for _ in range(4))])
        n, m = RNG.randrange(1, 9), RNG.randrange(1, 9)
        own = np.array(sorted(RNG.sample(range(int(ends[-1])), min(int(ends[-1]), RNG.randrange(0, 8)))), np.int64)
        doc = np.searchsorted(ends, own, side="right") - 1
        first, last = ends[doc], ends[doc + 1] - n
        want = sorted({b for p, f, l in zip(own, first, last) for b in range(max(p - m + 1, f), min(p, l) + 1)})
        assert decontaminate._begins(own, m, first, last).tolist() == want


def test_join_memory(text):
    def run():
        h, ptr, place = ngram_join._sets(pa.array([text, "short text here"]), 5, np.ones(1 << ngram_join.WORD_BITS))
        ngram_join._keys(h, ptr, 80, 10, place)
        ngram_join._toggled(h, ptr)

    assert peak(run) < 400


def test_katz_memory(text):
    word, counts = katz.tokens(pa.array([text, None]))
    assert counts.tolist() == [len(text.split()) + 1, 1]
    local = np.unique(word, return_inverse=True)[1]
    packed = katz.pack(counts, local)
    assert len(packed) < 3 * len(local)
    assert (katz.unpack(packed)[1] == local).all()


@pytest.mark.parametrize("name", ["toxicity", "quality", "language"])
def test_classifier_memory(text, name):
    if name == "toxicity":
        reader = toxicity.Model(dict(toxicity.SEEDS)).reader()
        used = peak(lambda: reader.evidence([text]))
    elif name == "quality":
        model = quality.fit([(i % 2, f"{'good words here' if i % 2 else 'bad stuff there'} {i} " * 30) for i in range(80)])
        used = peak(lambda: model.scores([text]))
    else:
        model = language.Model([("de", 0, "haus", 5, 5), ("en", 1, "w", 9, 9)])
        used = peak(lambda: model.judge([text]))
    assert used < 250


def test_slices_and_their_tables_stay_small():
    texts = pa.array([" ".join(WORDS[i : i + 300]) for i in range(0, 4500, 3)])
    W._powers.clear()

    def run():
        for lo, hi in W.row_slices(texts):
            ngram_join._sets(texts.slice(lo, hi - lo), 5)

    assert peak(run) < 90  # two slices of text at least, with the tables of powers
    assert sum(x.nbytes for x in W._powers) < 20e6
