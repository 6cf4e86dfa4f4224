import math
import random
from collections import Counter

import pytest
import xxhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from folioflow.llm import packing, quality_model, secrets, simhash  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    good, bad = [f"good{i}" for i in range(400)], [f"bad{i}" for i in range(100)]
    rows = [(i, " ".join(rng.choices(bad if i % 5 == 0 else good, k=80)), "en", "s", 1) for i in range(200)]
    rows += [(500 + i, rows[i][1], "en", "s", 1) for i in range(1, 60, 2)] + [(700 + i, rows[i][1] + " extra", "en", "s", 1) for i in range(1, 60, 3)]
    rows += [(900, rows[1][1][::-1] + ' token = "abe29cfcdae4f03e1e339fcaa4c5bb6c83baff71"', "en", "s", 1), (901, None, None, None, None), (902, "", "en", "s", 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i in range(150)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_are_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    weights, theta = quality_model.fit(docs, labels)

    def tail(text):
        places = {xxhash.xxh3_64_intdigest(f) % quality_model.BUCKETS for f in quality_model.features(text or "")}
        return 1 / (1 + math.exp(theta[quality_model.MIN_GRADE - 1] - sum(weights[x] for x in places)))

    rows = [r for r in docs.collect() if tail(r.text) >= quality_model.MIN_TAIL]
    assert 0 < len(rows) < docs.count()
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(("null", r.doc_id) if r.text is None else r.text, r)
    rows = list(first.values())
    prints = {r.doc_id: p for r in rows if (p := simhash.fingerprint(r.text or ""))}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, x in prints.items():
            for j, y in prints.items():
                if root[j] < root[i] and sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(x, y)) <= simhash.ACCEPT:
                    root[i], changed = root[j], True
    rows = [r for r in rows if root.get(r.doc_id, r.doc_id) == r.doc_id]
    expected = Counter()
    for r in rows:
        text = secrets.redacted(r.text, secrets.scan(r.text))
        for k in range(0, len(text or ""), packing.CAPACITY):
            expected[r.doc_id, k, text[k : k + packing.CAPACITY]] += 1
    got = Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        got.update(zip(r.doc_ids, r.starts, r.texts))
    assert got == expected and any("<assignment>" in t for _, _, t in got)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "secret_scan", "best_fit_packing"]
