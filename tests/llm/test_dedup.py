import random
import re

import pyarrow as pa
import pytest

from folioflow.llm import exact_dedup, simhash
from folioflow.llm.exact_dedup import OpenTable
from folioflow.llm.shared import components, split_words

SCHEMA = "doc_id bigint, text string, N_COPIES int, bucket string, h int"


def brute(rows):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None:
            out.append([i, t, 1])
        elif t in first:
            first[t][2] += 1
        else:
            first[t] = [i, t, 1]
            out.append(first[t])
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize(("bucket", "hot"), [(1 << 20, 1 << 20), (200, 1 << 20), (200, 300)])
def test_exact_dedup_is_brute_force(spark, bucket, hot):
    rng = random.Random(3)
    texts = ["", "a", "b" * 5000, None, *(f"t{i}" for i in range(40))]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(None, "a"), (7, "a"), (7, "a"), (None, "only")]
    docs = spark.createDataFrame([(i, t, 9, "x", 1) for i, t in rows], SCHEMA)
    got = exact_dedup.exact_dedup(docs, bucket_bytes=bucket, hot_bytes=hot)
    assert got.columns == ["doc_id", "text", "bucket", "h", "n_copies"]
    assert sorted(((r.doc_id, r.text, r.n_copies) for r in got.collect()), key=str) == brute(rows)


def test_exact_dedup_splits_all_buckets_of_a_level(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_SPLIT", 2)
    rows = [(i, f"t{i % 150:03d}" * 5) for i in range(450)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), bucket_bytes=200)
    assert sorted(((r.doc_id, r.text, r.n_copies) for r in got.collect()), key=str) == brute(rows)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_open_table_compares_contents():
    table = OpenTable()
    assert [table.add(x) for x in (b"a", b"b", b"a")] == [(0, True), (1, True), (0, False)]
    for i in range(500):
        table.add(b"%d" % i)
    assert table.add(b"b") == (1, False)


def distance(a, b):
    return sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a, b))


def test_masks_cover_every_pair_within_the_radius():
    family = [int(m) for m in simhash.masks(4)[:, 0]]
    rng = random.Random(1)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << bit
        assert any(x & m == y & m for m in family)


def parents(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_near_groups_are_brute_force_components(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(60):
        base = rng.choices(words, k=120)
        rows.append((3 * i, " ".join(base)))
        for k in (1, 2):
            copy = list(base)
            for _ in range(k * 2):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((3 * i + k, " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, "..."), (None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = {i: simhash.fingerprint(t) for i, t in rows if t and i is not None}
    prints = {i: p for i, p in prints.items() if p}
    ids = sorted(prints)
    close = [(n, m) for n, i in enumerate(ids) for m, j in enumerate(ids[:n]) if distance(prints[i], prints[j]) <= simhash.ACCEPT]
    expected = {i: ids[r] for i, r in zip(ids, parents(len(ids), close))}
    assert len(set(expected.values())) < 80
    for _, radii in simhash.RADII:
        assert {r.id: r.root for r in simhash.near_groups(docs, radius=radii).collect()} == expected
    named = docs.selectExpr("lpad(cast(doc_id as string), 6, '0') as doc_id", "text")
    assert {int(r.id): int(r.root) for r in simhash.near_groups(named).collect()} == expected


def test_components_are_brute_force(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    rows = [*pairs, pairs[0], (None, 3), (4, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    root = parents(361, pairs)
    assert got == {x: root[x] for x in {x for a, b in pairs if a != b for x in (a, b)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_every_pair_up_to_the_accepted_distance_meets():
    rng = random.Random(6)
    for _, radii in simhash.RADII:
        family = [tuple(m) for m in simhash._families(radii).tolist()]
        for _ in range(300):
            x = rng.getrandbits(64), rng.getrandbits(64)
            bits = rng.sample(range(128), simhash.ACCEPT)
            y = [x[h] ^ sum(1 << b % 64 for b in bits if b // 64 == h) for h in (0, 1)]
            assert any(x[0] & m == y[0] & m and x[1] & n == y[1] & n for m, n in family)


def test_a_long_text_is_summed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text) == whole


def test_split_words_are_those_of_the_expression():
    rng = random.Random(9)
    signs = "aB9_ .,-\n\t\x1c\u00a0\u2003éßŉ中“—़١²·" + "".join(map(chr, range(0x2190, 0x2200)))
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 200)))
        assert split_words(text) == re.findall(r"\w+", text)


def test_groups_at_the_accepted_distance(spark, monkeypatch):
    rng = random.Random(7)
    made = {}
    for i in range(150):
        x = rng.getrandbits(64), rng.getrandbits(64)
        bits = rng.sample(range(128), simhash.ACCEPT)
        y = tuple(x[h] ^ sum(1 << b % 64 for b in bits if b // 64 == h) for h in (0, 1))
        made |= {f"{2 * i}": x, f"{2 * i + 1}": y}
    signed = {t: tuple(v - (1 << 64) if v >> 63 else v for v in p) for t, p in made.items()}

    def prints(batches):
        for batch in batches:
            a, b = zip(*(signed[t] for t in batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["id", "a", "b"])

    monkeypatch.setattr(simhash, "_fingerprints", prints)
    docs = spark.createDataFrame([(int(t), t) for t in made], "doc_id bigint, text string")
    got = {r.id: r.root for r in simhash.near_groups(docs).collect()}
    assert got == {i: i - i % 2 for i in range(300)}


def test_near_dedup_keeps_the_first_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text), (2, text + " more"), (9, None), (9, None), (8, ""), (None, text), (1, "another text of other words entirely")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, N_near int")
    got = simhash.near_dedup(docs)
    assert got.columns == ["doc_id", "text", "n_near"]
    assert sorted(((r.doc_id, r.n_near) for r in got.collect()), key=str) == sorted([(1, 1), (2, 2), (8, 1), (9, 1), (9, 1), (None, 1)], key=str)
    assert simhash.near_dedup(docs.limit(0)).collect() == []
