"""The prefix trie against a plain one that rebuilds all texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

import brute
from stationday.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth bigint, m string, size int, bytes string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "m", 1, "b") for r in rows], SCHEMA).repartition(4)


def check(spark, rows):
    got = [tuple(r) for r in T.prefix_trie(frame(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute.prefix_trie(rows)))


def odd_rows():
    rng = random.Random(2)
    words = ["", "a", "ä€", "long " * 50, None]
    rows = []
    for c in [-7, -5, -1, 0, 1, 2, 3, 4, 6, 7, 10, 11, 12, 13, 14, *range(40, 80)]:
        for t in range(rng.randrange(1, 14)):
            rows.append((c, None if t == 0 and rng.random() < 0.5 else t * 3, rng.choice(["user", "assistant", None]), rng.choice(words)))
    same = [(t, "user", f"turn {t}") for t in range(10)]
    rows += [(c, *x) for c in range(1000, 1060) for x in same]  # copies
    rows += [(c, *x) for c in range(2000, 2040) for x in same[:3]]
    rows += [(3000, t, "user", str(t % 3)) for t in range(700)]  # most rows in one conversation
    rows += [(3001, t, "user", str(t % 3)) for t in range(700)]
    rows += [(None, 1, "user", "x"), (None, None, None, None)]
    return rows


def test_trie_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "CHAIN", 64)
    monkeypatch.setattr(T, "ID_BLOCK", 8)
    check(spark, odd_rows())


def test_trie_of_few_rows(spark):
    assert T.prefix_trie(frame(spark, [])).count() == 0
    assert T.prefix_trie(frame(spark, [(None, 1, "u", "x")])).count() == 0
    check(spark, [(1, 1, None, None)])  # an h of one turn or more leaves a turnless one


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(5, 1, "u", "x")] * 3 + [(5, 2, "u", "y")]
    got = T.prefix_trie(frame(spark, rows)).agg({"depth": "max"}).first()[0]
    assert got == 4


def test_colliding_hashes_are_found_and_replaced(spark, monkeypatch):
    """With hashes that make different turns equal, the stored turns tell."""
    real, used = T.F.xxhash64, []

    def weak(seed, *cols):
        used.append(1)
        return T.F.lit(1).cast("long") if len(used) <= 4 else real(seed, *cols)

    monkeypatch.setattr(T.F, "xxhash64", weak)
    rows = [(5, 1, "u", "x"), (5, 2, "u", "y"), (7, 1, "u", "z")]
    assert not T.hashes_agree(frame(spark, rows), 1)
    check(spark, rows)
    assert len(used) > 4


def test_products_are_a_group():
    rng = np.random.default_rng(1)
    m, a = rng.integers(0, 2**63, 50).astype(np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, 50).astype(np.uint64)
    assert (m * T.inverse(m) == 1).all()
    group = np.repeat(np.arange(5), 10)
    pm, pa = T.prefix_products(m, a, group)
    for g in range(5):
        x, y = 1, 0
        for i in range(10 * g, 10 * g + 10):
            x, y = x * int(m[i]) % 2**64, (y * int(m[i]) + int(a[i])) % 2**64
            assert (int(pm[i]), int(pa[i])) == (x, y)
    back = T.without_last(*T.times(m[:5], a[:5], m[5:10], a[5:10]), m[5:10], a[5:10])
    assert (back[0] == m[:5]).all() and (back[1] == a[:5]).all()
    rest = T.suffix(m[:5], a[:5], *T.times(m[:5], a[:5], m[5:10], a[5:10]))
    assert (rest[0] == m[5:10]).all() and (rest[1] == a[5:10]).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_nodes_end_hashes(spark, monkeypatch, seed):
    monkeypatch.setattr(T, "ID_BLOCK", 4)
    rng = random.Random(seed)
    rows = [(c, 1, "u", rng.choice("ab")) for c in rng.sample(range(-300, 300), 200)]
    check(spark, rows)
