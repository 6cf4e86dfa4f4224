import math
from collections import Counter

import numpy as np
import pytest

from folioflow.llm import lm_scoring as lm

TEXTS = [(1, "the cat sat on the mat"), (2, "the dog sat on the log"), (3, "a cat and a dog"), (4, None), (5, "..."), (None, "the cat sat on the mat"), (7, "one " * 3000)]


def brute(rows, order):
    """Deleted interpolation with dictionaries."""
    docs = [["<s>", *lm.words(t), "</s>"] if lm.words(t) else None for _, t in rows]
    grams = [Counter(tuple(x[i : i + o]) for i in range(len(x) - o + 1)) if x else Counter() for o in range(1, order + 1) for x in docs]
    by = [grams[(o - 1) * len(docs) : o * len(docs)] for o in range(1, order + 1)]
    total = [sum(x, Counter()) for x in by]
    n = sum(len(x) - 1 for x in docs if x)
    uniform = 1 / (1 + len(total[0]))
    events = []
    for d, x in enumerate(docs):
        events.append(Counter())
        for i in range(1, len(x or ())):
            estimates, top = [], 0.0
            for o in range(order, 0, -1):
                if i - o + 1 < 0:
                    estimates.append(0.0)
                    continue
                g = tuple(x[i - o + 1 : i + 1])
                c = total[o - 1][g] - by[o - 1][d][g]
                context = total[o - 2][g[:-1]] - by[o - 2][d][g[:-1]] if o > 1 else n - (len(x) - 1)
                estimates.append(c / context if context > 0 else 0.0)
                if o == order and o > 1:
                    top = context
            code = lm.codes([np.array([p]) for p in estimates], np.array([top]))[0]
            events[-1][int(code)] += 1
    every = sorted(sum(events, Counter()).items())
    weights = lm.fit(np.array([c for c, _ in every]), np.array([float(k) for _, k in every]), order, uniform)
    out = []
    for (i, _), x, e in zip(rows, docs, events):
        log = None
        if x:
            log = 0.0
            for c, k in e.items():
                b, p = lm.components(np.array([c]), order, uniform)
                log += k * math.log2((weights[b] * p).sum())
        out.append((i, len(x) - 2 if x else 0, log))
    return out


@pytest.mark.parametrize(("order", "chars", "shard"), [(1, 10**6, 1 << 20), (2, 10**6, 1 << 20), (2, 60, 300), (3, 60, 300)])
def test_scores_are_brute_force(spark, monkeypatch, order, chars, shard):
    monkeypatch.setattr(lm, "BATCH_CHARS", chars)
    monkeypatch.setattr(lm, "SHARD_BYTES", shard)
    docs = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id bigint, text string, perplexity string")
    got = sorted(((r.doc_id, r.n_words, r.log2_prob) for r in lm.score(docs, order=order).collect()), key=str)
    for a, b in zip(got, sorted(brute(TEXTS, order), key=str)):
        assert a[:2] == b[:2] and (a[2] is None) == (b[2] is None)
        if a[2] is not None:
            assert a[2] == pytest.approx(b[2], rel=1e-9)


def test_expectation_maximisation_raises_the_likelihood():
    rng = np.random.default_rng(0)
    code = np.unique(lm.codes([rng.random(200) ** 4, rng.random(200) ** 6], rng.integers(0, 100, 200).astype(float)))
    times = rng.integers(1, 50, len(code)).astype(float)

    def likelihood(k):
        b, p = lm.components(code, 2, 1e-3)
        return (times * np.log((lm.fit(code, times, 2, 1e-3, k)[b] * p).sum(axis=1))).sum()

    assert likelihood(0) < likelihood(1) < likelihood(10) <= likelihood(40) + 1e-6
    assert np.allclose(lm.fit(code, times, 2, 1e-3).sum(axis=1), 1)


def test_counts_of_any_size_survive():
    counts = np.array([0, 1, 254, 255, 256, 2**40], np.uint64)
    assert (lm._unpacked(lm._packed(counts), 6) == counts).all()


def test_nothing_to_score(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.score(docs).collect() == []
    only = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert [tuple(r) for r in lm.score(only).collect()] == [(1, 0, None, None)]
