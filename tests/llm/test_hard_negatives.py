"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

import brute
from stationday.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, row string, shard int, cell string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 0.5, "r", 1, "c") for r in rows], schema).repartition(4)


def check(spark, rows, schema=SCHEMA):
    got = [tuple(r) for r in H.hard_negatives(frame(spark, rows, schema)).collect()]
    assert Counter(got) == Counter(brute.hard_negatives(rows))
    return got


def vectors(n: int, seed: int, dim: int = 6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, dim))
    rows = []
    for i in range(n):
        v = middle[rng.integers(5)] + 0.4 * rng.normal(size=dim)
        v = v / np.linalg.norm(v)
        # values that floats of either width hold alike
        rows.append((i * 10 + int(rng.integers(10)) * (i % 4 > 0), (np.round(v * 512) / 512).tolist(), int(rng.integers(10))))
    return rows


def odd_rows():
    rows = vectors(260, 3)
    same = rows[0][1]
    rows += [(5000 + i, same, 1 + i % 2) for i in range(120)]  # many copies of one vector
    rows += [(6000, None, 1), (6100, same, None), (6200, [0.5, None] + same[2:], 1), (6300, [math.nan] + same[1:], 2), (6400, [math.inf] + same[1:], 2)]
    rows += [(None, same, 1), (None, same, 2), (7000, [], 1), (7100, same[:3], 1), (7200, same + [0.25, 0.5], 2), (-700, same, 3)]
    rows += [(None, [round(0.7 * x * 512) / 512 for x in same], 5 + i) for i in range(2)]
    rows += [(7300, [-x for x in same], 9), (7301, same, 9)]  # a positive below 0
    return rows


@pytest.mark.parametrize("codes, shard", [(1, 10_000), (4, 50), (7, 16)])
def test_matches_all_pairs(spark, monkeypatch, codes, shard):
    monkeypatch.setattr(H, "CELL_ROWS", 400 / codes**2)
    monkeypatch.setattr(H, "SHARD_ROWS", shard)
    monkeypatch.setattr(H, "SHARD_BYTES", shard * 16)  # one vector has 8 numbers of 2 bytes
    monkeypatch.setattr(H, "BLOCK_ROWS", 20)
    got = check(spark, odd_rows())
    assert any(r[3] is None for r in got) and len(got) > 100


def test_no_rows_no_anchors_and_repeated_rows(spark):
    none = H.hard_negatives(frame(spark, []))
    assert none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and none.count() == 0
    assert H.hard_negatives(frame(spark, [(1, [1.0], 1), (2, [0.5], 2)])).count() == 0
    assert H.hard_negatives(frame(spark, [(100, [], 1), (2, [], 2)])).count() == 0
    # the anchor's copy is its positive, and the other way round
    got = [tuple(r) for r in H.hard_negatives(frame(spark, [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [0.5, 0.0], 2)])).collect()]
    assert got == [(100, 100, 1, 3, 65536, 32768)] * 2


def test_wide_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i * 50, [float(rng.randrange(-(2**20), 2**20)) for _ in range(5)], rng.randrange(3)) for i in range(40)]
    schema = SCHEMA.replace("float", "double")
    check(spark, rows, schema)
    with pytest.raises(ValueError):
        H.hard_negatives(frame(spark, [(100, [1e30], 1)], schema))


def test_visits_fall_and_bound_their_cells():
    rows = np.array([r[1] for r in vectors(300, 8)]) * 256
    x = np.floor(rows)
    ix = H.Index(6, 256, [H.codebook(h, 5) for h in (x[:, :3], x[:, 3:])])
    cell, r1, r2 = ix.encode(x)
    blocks = [{"cell": int(c), "ids": [0], "vectors": x[p : p + 1].astype(ix.kind).tobytes(), "labels": np.zeros(1, np.int64).tobytes(), "rows": np.zeros(1, np.int64).tobytes(), "r1": r1[p], "r2": r2[p]} for p, c in enumerate(cell)]
    shard = H.Shard(ix, blocks)
    seen, last = set(), math.inf
    for bound, at in shard.visits(x[0]):
        assert bound <= last + 1e-6 and at not in seen
        seen.add(at)
        last = bound
        if at in shard.cells:
            assert (shard.cells[at][0] @ x[0]).max() <= bound
    assert set(shard.cells) <= seen


def test_search_stops_early(spark):
    """On vectors in clusters, certified windows leave most cells unread."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(20, 8)) * 4
    x = np.floor(np.concatenate([m + 0.1 * rng.normal(size=(50, 8)) for m in middle]) * 64)
    ix = H.Index(8, 4096, [H.codebook(h, 20) for h in (x[:, :4], x[:, 4:])])
    cell, r1, r2 = ix.encode(x)
    one = lambda p: {"cell": int(cell[p]), "ids": [p], "vectors": x[p : p + 1].astype(ix.kind).tobytes(), "labels": np.array([p % 2]).tobytes(), "rows": np.array([p]).tobytes(), "r1": r1[p], "r2": r2[p]}
    shard = H.Shard(ix, [one(p) for p in range(len(x))])
    read, cells = [], shard.cells

    class Counted(dict):
        def __getitem__(self, k):
            read.append(k)
            return cells[k]

    shard.cells = Counted(cells)
    shard.search(x[0], 0, 0, True, [(-H.FAR, H.FAR, -H.FAR)], 5)
    assert len(read) < len(cells) / 3
