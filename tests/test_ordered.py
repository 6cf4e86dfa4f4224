"""Window forms against plain loops on random rows, and the sequential operators on made-up books."""

import random

from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import checks, ordered, sequential
from folioflow.sources import files, sinks


def books(rng, n, make):
    return [(b, i, v) for b in range(n) for i, v in enumerate(make() for _ in range(rng.randint(0, 12)))]


def by_book(rows):
    out = {}
    for b, i, v in rows:
        out.setdefault(b, []).append(v)
    return out


def test_pairs(spark):
    rng = random.Random(1)
    rows = books(rng, 60, lambda: rng.random() < 0.5)
    expected = []
    for b, seconds in by_book(rows).items():
        i = pair = 0
        while i < len(seconds):
            n = 2 if i + 1 < len(seconds) and seconds[i + 1] else 1
            pair += 1
            expected += [(b, i + k, pair, n == 1) for k in range(n)]
            i += n
    df = spark.createDataFrame(rows, "b int, i int, second boolean")
    got = ordered.paired(df, ["b"], ["i"], F.col("second"))
    assert sorted((r.b, r.i, r.pair, r.half) for r in got.collect()) == sorted(expected)


def test_merged_halves(spark):
    rng = random.Random(2)
    rows = books(rng, 60, lambda: rng.random() < 0.6)
    expected = []
    for b, halves in by_book(rows).items():
        i = n = 0
        while i < len(halves):
            k = 2 if halves[i] and i + 1 < len(halves) and halves[i + 1] else 1
            n += 1
            expected += [(b, i + j, n) for j in range(k)]
            i += k
    df = spark.createDataFrame(rows, "b int, pair int, half boolean")
    assert sorted((r.b, r.pair, r.merged) for r in ordered.halves_merged(df, ["b"]).collect()) == sorted(expected)


def test_bridges(spark):
    rng = random.Random(3)
    rows = books(rng, 80, lambda: rng.choice(["verse", "verse", "unknown", "prose", "toc"]))
    expected = []
    for b, kinds in by_book(rows).items():
        out, i = list(kinds), 0
        while i < len(kinds):
            j = i
            while j < len(kinds) and kinds[j] == kinds[i]:
                j += 1
            inside = i > 0 and j < len(kinds) and kinds[i - 1] == "verse" and kinds[j] == "verse"
            if inside and (kinds[i] == "unknown" or kinds[i] == "prose" and j - i == 1):
                out[i:j] = ["verse"] * (j - i)
            i = j
        expected += [(b, k, v) for k, v in enumerate(out)]
    df = spark.createDataFrame(rows, "b int, i int, kind string")
    assert sorted((r.b, r.i, r.bridged) for r in ordered.bridged(df, ["b"], ["i"]).collect()) == sorted(expected)


def test_body_start(spark):
    rng = random.Random(4)
    rows = [(b, i, rng.random() < 0.8, rng.random() < 0.5) for b in range(80) for i in range(rng.randint(1, 14))]
    expected = {}
    for b in {r[0] for r in rows}:
        own = [r[2:] for r in rows if r[0] == b]
        starts = [i for i in range(len(own) - 3) if all(own[i + k] == (True, k % 2 == 1) for k in range(4))]
        expected[b] = starts[0] if starts else len(own)
    df = spark.createDataFrame(rows, "b int, i int, fits boolean, second boolean")
    assert {r.b: r.start for r in ordered.body_start(df, ["b"], "i", F.col("fits"), F.col("second")).collect()} == expected


def test_body_start_backs_up_to_a_separator(spark):
    rng = random.Random(14)
    books = ["-v2v2", "v-vv2v2", "-pv2v2", "p-vv2v2v", "--v2-v2v2", "v2v-", "v2v2-", "p-p-vv2v2"]
    books += ["".join(rng.choices("v2-p", [4, 4, 1, 1], k=rng.randint(1, 20))) for _ in range(120)]
    expected = {}
    for b, kinds in enumerate(books):
        start = kinds.find("v2v2")
        expected[b] = len(kinds) if start < 0 else start
        for i in range(start - 1, -1, -1):
            if kinds[i] in "-p":
                expected[b] = i + 1 if kinds[i] == "-" else start
                break
    df = spark.createDataFrame([(b, i, k) for b, kinds in enumerate(books) for i, k in enumerate(kinds)], "b int, i int, k string")
    got = ordered.body_start(df, ["b"], "i", F.col("k").isin("v", "2"), F.col("k") == "2", separator=F.col("k") == "-", prose=F.col("k") == "p")
    assert {r.b: r.start for r in got.collect()} == expected


def test_runs_of_codes_and_digits(spark):
    rng = random.Random(5)
    rows = sorted({(b, 2 * rng.randint(0, 30), rng.choice([5, 65, 66])) for b in range(30) for _ in range(15)})
    seen, unique = set(), []
    for b, o, c in rows:
        if (b, o) not in seen:
            seen.add((b, o))
            unique.append((b, o, c))
    expected = sorted(r for r in unique if ((r[0], r[1] - 2) in seen or (r[0], r[1] + 2) in seen) and r[2] >= 32)
    df = spark.createDataFrame(unique, "b int, offset int, code int")
    assert sorted(map(tuple, ordered.isolated_dropped(df, ["b"]).collect())) == expected
    text = "ab123c45d6"
    letters = spark.createDataFrame([(1, i, c) for i, c in enumerate(text)], "b int, idx int, letter string")
    assert "".join(r.letter for r in ordered.digits_reversed(letters, ["b"]).orderBy("idx").collect()) == "ab321c54d6"


def test_publish_status(spark):
    staged = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, body string")
    flagged = spark.createDataFrame([(1,), (1,)], "id int")
    archive = spark.createDataFrame([(2, "b"), (3, "x"), (1, "a")], "id int, body string")
    got = {r.id: r.status for r in checks.publish_status(staged, flagged, archive, "id", "body").collect()}
    assert got == {1: "refused", 2: "skipped", 3: "differs", 4: "new"}


def test_words_are_counted_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "a b a é"), (1, "a, 7"), (2, None), (3, " "), (None, "b")], "id int, text string")
    found = checks.word_counts(df, ["id"], "text")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, "a", 2), (1, "b", 1), (1, "é", 1), (1, "a", 1), (None, "b", 1)], key=str)


def test_poems(spark):
    first = [("moon rise", "sun rise"), ("x one", "late rise"), ("y two", "dawn rise"), ("z three Zed", "noon rise")]
    second = [("red wall", "tall wall"), ("p", "small wall"), ("q", "old wall")]
    assert sequential.poems(first + second, "Zed") == [0, 0, 0, 0, 1, 1, 1]
    assert sequential.poems([]) == [] and sequential.poems([("", "")]) == [0]
    rows = [("b", i, a, c) for i, (a, c) in enumerate(first + second)]
    df = spark.createDataFrame(rows, "book_slug string, idx int, first string, second string")
    assert [r.poem for r in sequential.split_poems(df, "Zed").orderBy("idx").collect()] == [0, 0, 0, 0, 1, 1, 1]


def test_scalars(spark):
    df = spark.createDataFrame([("a/b-300x200.jpg", "One, two:  three! " * 10, 123)], "u string, t string, n int")
    row = df.select(X.image_path(F.col("u")).alias("u"), X.slug(F.col("t"), 20).alias("s"), X.local_digits(F.col("n")).alias("d"), X.skeleton(F.col("t")).alias("k")).first()
    assert (row.u, row.s, row.d) == ("b.jpg", "one-two-three-one", "۱۲۳") and row.k.startswith("One two three One")
    assert df.select(X.cleaned(F.lit("a&amp;b<br/><br> c <i>d</i>")).alias("x")).first().x == "a&b\nc d"


def test_sources(spark, tmp_path):
    (tmp_path / "p.md").write_text("---\ntitle: One: two\nkind: essay\n---\nBody\n", encoding="utf-8")
    row = files.front_matter(spark, str(tmp_path / "p.md")).first()
    assert row.fields == {"title": "One: two", "kind": "essay"} and row.body.strip() == "Body"
    (tmp_path / "r.json").write_text('{"12": "/a", "7": "/b"}')
    assert sorted(map(tuple, files.redirects(spark, str(tmp_path / "r.json")).collect())) == [(7, "/b"), (12, "/a")]
    xml = """<rss xmlns:wp="w" xmlns:content="c"><channel>
    <item><title>T</title><content:encoded><![CDATA[<p>x</p>]]></content:encoded><wp:post_id>5</wp:post_id><wp:post_type>post</wp:post_type>
    <wp:status>publish</wp:status><wp:post_date>2020-01-02 03:04:05</wp:post_date><wp:post_name>t</wp:post_name>
    <category domain="category">K</category><category domain="tag">no</category></item>
    <item><title>D</title><wp:post_id>6</wp:post_id><wp:post_type>post</wp:post_type><wp:status>draft</wp:status></item></channel></rss>"""
    (tmp_path / "e.xml").write_text(xml)
    assert [tuple(r) for r in files.posts(spark, str(tmp_path / "e.xml")).collect()] == [(5, "T", "<p>x</p>", ["K"], "2020-01-02", "t", 0)]
    staged = spark.createDataFrame([(1, "new"), (2, "skipped")], "id int, status string")
    for _ in range(2):
        sinks.write_insert_only(staged, str(tmp_path / "out"), ["id"])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(1,)]
