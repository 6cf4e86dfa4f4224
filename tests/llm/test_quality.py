import math
import random

import numpy as np
import xxhash

from folioflow.llm import quality_model, quality_rules


def test_classifier_learns_held_out_grades(spark):
    rng = random.Random(2)
    good, bad, rude = [f"good{i}" for i in range(50)], [f"bad{i}" for i in range(50)], ["idiot", "fool"]

    def doc(grade):
        words = rng.choices(good if grade else bad, k=40) + rng.choices([f"n{i}" for i in range(300)], k=30)
        words += rude if grade == 1 else []
        rng.shuffle(words)
        return " ".join(words)

    grades = [(0, 1, *[2] * 5)[i % 7] for i in range(600)]
    rows = [(i, doc(g)) for i, g in enumerate(grades)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(grades[i] > 0), int(grades[i] == 1)) for i, _ in rows[:400]] + [(None, 1, 0), (3, None, 1)], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in quality_model.select(docs, labels).collect()}
    right = sum((i in kept) == (grades[i] == 2) for i in range(400, 600))
    assert right >= 190


def test_classifier_gradient_and_order():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 300)
    rows = [np.unique([g * 7, 100 + int(rng.integers(0, 20))]) for g in grades]
    weights, theta = quality_model.fit_rows(rows, grades)
    assert (np.diff(theta) > 0).all()
    assert weights[0] < weights[7] < weights[14]
    none, _ = quality_model.fit_rows([], np.zeros(0, np.int64))
    assert not none.any()


def test_classifier_gradient_is_that_of_the_likelihood():
    """The likelihood is written out in plain Python, its gradients are taken by differences."""
    rng = np.random.default_rng(4)
    n, k = 40, 6
    grades, weight = rng.integers(0, 3, n), rng.uniform(0.5, 3, n)
    docs = [sorted(rng.choice(k, rng.integers(1, 4), replace=False).tolist()) for _ in range(n)]
    row, flat = np.repeat(np.arange(n), [len(d) for d in docs]), np.concatenate(docs)
    w, raw = rng.normal(size=k), np.array([-0.7, 0.3])

    def plain(w, raw):
        theta, out = [raw[0], raw[0] + math.exp(raw[1])], 0.0
        for d, g, c in zip(docs, grades, weight):
            z = sum(w[j] for j in d)
            below = [0.0, *(1 / (1 + math.exp(-(t - z))) for t in theta), 1.0]
            out -= c * math.log(below[g + 1] - below[g])
        return out / n + 0.01 / 2 * sum(x * x for x in w)

    value, gw, graw = quality_model.likelihood(w, raw, row, flat, grades, weight, 0.01)
    assert math.isclose(value, plain(w, raw), rel_tol=1e-9)
    for got, at in ((gw, 0), (graw, 1)):
        for j in range(len(got)):
            step = [np.zeros(k), np.zeros(2)]
            step[at][j] = 1e-5
            slope = (plain(w + step[0], raw + step[1]) - plain(w - step[0], raw - step[1])) / 2e-5
            assert math.isclose(got[j], slope, rel_tol=1e-4, abs_tol=1e-7)


def test_selection_is_brute_force(spark):
    """The score of each document from its features one by one, with weights of a fitted model."""
    rows = [(i, " ".join([*(f"w{(i * j) % 37}" for j in range(1, 9)), *(("bad", "rude", "good")[min(i % 4, 2)],) * 3])) for i in range(120)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, score string, `__score` int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 4 == 1)) for i in range(90)], "doc_id bigint, quality int, toxic int")
    weights, theta = quality_model.fit(docs, labels)
    expected = {}
    for i, t in rows:
        z = sum(weights[s] for s in {xxhash.xxh3_64_intdigest(f) % quality_model.BUCKETS for f in quality_model.features(t)})
        tails = [1 - 1 / (1 + math.exp(-(x - z))) for x in theta]
        if tails[1] >= quality_model.MIN_TAIL:
            expected[i] = round(sum(tails), 9)
    got = {r.doc_id: round(r.expected_grade, 9) for r in quality_model.select(docs, labels).collect()}
    assert got == expected and 0 < len(got) < 120


def test_classifier_takes_nulls_ties_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "", 2), (2, "x " * 100000, 3)], "doc_id bigint, text string, P_TAIL int")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality_model.scored(docs, quality_model.fit(docs, labels))
    assert got.columns == ["doc_id", "text", "expected_grade", "p_tail"]
    rows = got.collect()
    assert len(rows) == 4 and rows[0].p_tail == rows[1].p_tail
    assert quality_model.select(docs.limit(0), labels).collect() == []


def test_rules_name_what_fails(spark):
    clean = "The cat of the house is on the mat and it was with us for a time. " * 3
    cases = {
        clean: [],
        None: ["too_short", "word_length"],
        "": ["too_short", "word_length"],
        "De.": [],
        "xq### zv$$$ " * 40: ["symbols", "repeated_words", "stop_words"],
        "THE HOUSE OF THE CAT IS ON THE MAT AND IT WAS. " * 4: ["capitals"],
        "\n".join(["the same line of it"] * 9): ["repeated_lines"],
        "\n".join(f"the line {i} of it..." for i in range(9)): ["ellipsis_lines"],
    }
    rows = [(i, t, "x") for i, t in enumerate(cases)]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id bigint, text string, N_WORDS string")
    got = quality_rules.measured(docs).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        expected = [x for x in cases[r.text] if x != "word_length"]
        assert r.failed == expected, (r.text, r.failed)
    assert quality_rules.select(docs.limit(0)).collect() == []


def test_rules_are_one_projection_without_functions_of_users(spark):
    plan = quality_rules.select(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
