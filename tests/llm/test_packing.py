import random
from collections import Counter

import numpy as np
import pytest

from folioflow.llm import packing


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.normal(size=(8, 20)), rng.normal(size=8)
        x = packing.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 1e-9]).max(initial=0) < 1e-6


def test_patterns_are_all_that_fill():
    brute = {(i, j, k) for i in range(13) for j in range(i + 1) for k in range(j + 1) if i + j + k == 12 and i > 0}
    assert {tuple(x + (0,) * (3 - len(x))) for x in map(tuple, packing.patterns(12, 3))} == brute


@pytest.mark.parametrize("seed", range(8))
def test_plan_takes_each_length_once_and_beats_first_fit_slack(seed):
    rng = random.Random(seed)
    histogram = Counter(min(64, 1 + int(rng.expovariate(1 / 15))) for _ in range(5000))
    planned = packing.plan(histogram)
    used = Counter()
    for pattern, n in planned:
        assert sum(pattern) <= 64 and n > 0
        for b in pattern:
            used[b] += n
    assert used == histogram
    least = -(-sum(b * n for b, n in histogram.items()) // 64)
    assert sum(n for _, n in planned) <= 1.02 * least + 2


def test_plan_of_extremes():
    assert packing.plan({}) == []
    assert sum(n for _, n in packing.plan({40: 10**12})) == 10**12
    assert sum(n for _, n in packing.plan({1: 64 * 10**9 + 1})) == 10**9 + 1


@pytest.mark.parametrize("share_rows", [200_000, 20])
def test_every_character_is_packed_once(spark, share_rows, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", share_rows)
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abé😀 ") for _ in range(rng.choice([1, 5, 63, 64, 65, 200, 1000])))) for i in range(150)]
    rows += [(None, "null id"), (5, rows[5][1]), (5, rows[5][1]), (900, None), (901, ""), (902, "x" * 5000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, place int")
    got = packing.pack(docs, capacity=128, units=16).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    pieces = Counter()
    for r in got:
        assert r.n_chars == sum(map(len, r.texts)) <= 128
        pieces.update(zip(r.doc_ids, r.starts, r.texts))
    expected = Counter((i, k, t[k : k + 128]) for i, t in rows if t for k in range(0, len(t), 128))
    assert pieces == expected
    assert packing.pack(docs.limit(0), capacity=128, units=16).collect() == []
