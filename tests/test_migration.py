"""Posts to pieces, files, and passages in texts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import migrate
from folioflow.operators.containment import contained
from folioflow.sources import files, sinks

AUTHOR = "A. Author"
KINDS = {"Video": "videos", "Memoir": "memoir", "Poem": "ghazals", "Song": "nazms", "Review": "reviews", "Punjabi": "nazms"}


def posts(spark, rows):
    return spark.createDataFrame(rows, "post_id bigint, seq bigint, title string, body string, categories array<string>, published string")


def built(spark, rows, overrides=(), dead=()):
    known = spark.createDataFrame(list(overrides), "title string, reviewed_book string, reviewed_author string")
    gone = spark.createDataFrame([(d,) for d in dead], "video_id string")
    return migrate.pieces(posts(spark, rows), AUTHOR, KINDS, {"Punjabi": "punjabi"}, {"urdu": "nastaliq", "punjabi": "shahmukhi"}, ("Misc",), {"site": "site.example"}, known, gone)


def test_kinds_of_posts(spark):
    poem = "<!-- wp:p --><p class='x'>one<br>two</p><!-- /wp:p --><p>th&amp;ree<br/>four</p><p>---</p><p>Lahore, May</p><p>A. Author</p>"
    memoir = '<p>text</p><img class="a" src="http://h/up/pic_o-1-300x200.jpg"><p>more</p><p>تحریر: A. Author</p>'
    embed = '<!-- wp:core-embed/wordpress {"providerNameSlug":"site"} --><figure><p>not mine</p></figure><!-- /wp:core-embed/wordpress -->'
    rows = [
        (1, 1, "Poemـ one", poem, ["Misc", "Poem"], "2020-01-01"),
        (2, 2, "Part 7", memoir, ["Memoir", "tag", "tag"], None),
        (3, 3, "Book / Who", f"<p>words</p>{embed}", ["Review"], ""),
        (4, 4, "Film", '<p>see https://youtu.be/abcdefghijk</p>', ["Video", "Punjabi", "Story"], "2020-01-01"),
        (5, 5, "Film two", '<blockquote>A day 05-11-2019 &amp; more Posted by X on Y</blockquote> https://www.facebook.com/some.one/videos/123/', ["Video"], "2020-01-01"),
        (6, 6, "Song", "<p>one</p><p>two</p>", ["Punjabi"], "2020-01-01"),
        (7, 7, "Known", "<p>x</p>", ["Review"], "2020-01-01"),
        (8, 8, "Dead", "https://www.youtube.com/watch?v=AAAAAAAAAAA", ["Video"], "2020-01-01"),
        (9, 9, "???", None, None, None),
    ]
    found = built(spark, rows, [("Known", None, "Someone")], ["AAAAAAAAAAA"])
    got = {r.post_id: r for r in found.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert (got[1].title, got[1].body, got[1].written_note, got[1].removed) == ("Poem one", "one\ntwo\n\nth&ree\nfour", "Lahore, May", ["---", "Lahore, May", "A. Author"])
    assert (got[2].slug, got[2].part, got[2].tags, got[2].body, got[2].removed) == ("dars-gah-7", 7, ["tag", "tag"], "text\n\n![](/media/images/pic_o.jpg)\n\nmore", ["تحریر: A. Author"])
    assert (got[3].reviewed_book, got[3].reviewed_author, got[3].body, got[3].published_in) == ("Book", "Who", "words", ["site.example"])
    assert (got[4].kind, got[4].language, got[4].script, got[4].tags, got[4].video_id, got[4].body) == ("videos", "punjabi", "shahmukhi", ["Story"], "abcdefghijk", "")
    assert (got[5].source, got[5].recorded, got[5].description) == ("facebook", "2019-11-05", "A day 05-11-2019 & more")
    assert (got[6].kind, got[6].body) == ("nazms", "one\ntwo")
    assert (got[7].reviewed_book, got[7].reviewed_author) == (None, "Someone")
    assert (got[9].kind, got[9].slug) == ("nazms", "nazms-9")
    assert migrate.gates(found.where("post_id < 9")).collect() == []
    migrate.passed(migrate.gates(found.where("post_id < 9")))


def test_gates_abort(spark):
    rows = [(1, 1, "P", "<p>one<br>two</p><p>three<br>x<br>y</p>", ["Poem"], ""), (2, 2, "no number", "<p>bare</p>text outside", ["Memoir"], ""), (3, 3, "V", "none", ["Video"], "")]
    got = {(r.gate, r.message) for r in migrate.gates(built(spark, rows)).collect()}
    assert got == {("verse", "sher 2 has 3 misra"), ("fidelity", "source 15 chars, emitted 4 chars"), ("part", "no part number"), ("video", "no video")}
    with pytest.raises(ValueError, match="nothing is written"):
        migrate.passed(migrate.gates(built(spark, rows)))
    lost = built(spark, [(4, 4, "R", '<p>x</p><img src="a.jpg">', ["Review"], "")]).withColumn("body", F.lit("x"))
    assert [r.message for r in migrate.gates(lost).collect()] == ["source has 1 image(s), emitted 0"]


def test_part_numbers_of_any_length(spark):
    rows = [(1, 1, "Part 004512160218721939", "<p>x</p>", ["Memoir"], ""), (2, 2, "Part " + "9" * 40, "<p>x</p>", ["Memoir"], "")]
    found = built(spark, rows)
    assert {r.post_id: (r.slug, r.part) for r in found.collect()} == {1: ("dars-gah-4512160218721939", 4512160218721939), 2: ("dars-gah-" + "9" * 40, None)}
    assert [(r.key, r.message) for r in migrate.gates(found).collect()] == [("2", "part number of more than 38 digits")]


def test_entities_that_were_cut_off(spark):
    pages = ["<t>a &amp;&am</t>p{b} &amp;middot;", "<t>a &amp</t><p>p; &#65;&#x42;&copy;&copy &no;", None]
    df = spark.createDataFrame([(n, p) for n, p in enumerate(pages)], "n int, html string")
    got = df.select("n", X.without_tags(F.col("html"), ended=True), X.cleaned(F.col("html"), ended=True)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {0: ("a&&amp{b}&middot;", "a &&amp{b} &middot;"), 1: ("a&ampp;AB©&copy&no;", "a &ampp; AB©&copy &no;"), 2: (None, None)}


def test_duplicates_and_redirects(spark):
    rows = [(n, n, "Same" if n in (2, 5, 9) else f"Other {n}", "<p>a<br>b</p>", ["Poem"], "") for n in (5, 2, 9, 3)]
    kept = migrate.merged(built(spark, rows), ["kind", "slug"], "seq", "post_id")
    assert {r.post_id: r.source_ids for r in kept.collect()} == {2: [2, 5, 9], 3: [3]}
    known = migrate.redirects(kept)
    assert sorted(map(tuple, known.collect())) == [(2, "/ghazal/same"), (3, "/ghazal/other-3"), (5, "/ghazal/same"), (9, "/ghazal/same")]
    asked = spark.createDataFrame([("9",), ("77",), (None,)], "post_id string")
    assert sorted(((r.post_id or "", r.status, r.location) for r in migrate.looked_up(asked, known, "post_id", F.lit("/")).collect())) == [("", 200, "/"), ("77", 200, "/"), ("9", 301, "/ghazal/same")]
    (one,) = sinks.redirect_map(known).collect()
    assert json.loads(one.content) == {"2": "/ghazal/same", "3": "/ghazal/other-3", "5": "/ghazal/same", "9": "/ghazal/same"} and one.content.index('"3"') < one.content.index('"5"')
    assert sinks.redirect_map(known.limit(0)).first().content == "{}"


def test_files_come_back(spark, tmp_path):
    rows = [("ghazals", "a", 'Say "x" \\ y', "urdu", "nastaliq", None, ["t,1", "u"], 3, "", "one\ntwo\n"), ("memoir", "b", "B", "urdu", "nastaliq", "2020-01-01", [], None, "note", "text")]
    df = spark.createDataFrame(rows, "kind string, slug string, title string, language string, script string, published string, tags array<string>, part int, written_note string, body string")
    made = {r.path: r.content for r in sinks.markdown(df).collect()}
    assert made["ghazals/a.md"] == '---\ntitle: "Say \\"x\\" \\\\ y"\nslug: "a"\nlanguage: "urdu"\nscript: "nastaliq"\ntags: ["t,1", "u"]\npart: 3\n---\n\none\ntwo\n'
    assert 'published: 2020-01-01\nwritten_note: "note"' in made["memoir/b.md"]
    for _ in range(2):
        sinks.write_files(sinks.markdown(df), str(tmp_path))
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["a.md", "b.md"]
    read = files.front_matter(spark, f"{tmp_path}/ghazals/a.md")
    row = read.select(files.unquoted(F.col("fields")["title"]).alias("title"), files.listed(F.col("fields")["tags"]).alias("tags"), "body").first()
    assert (row.title, row.tags, row.body.strip()) == ('Say "x" \\ y', ["t,1", "u"], "one\ntwo")
    books = spark.createDataFrame([("bk", "B", "P", 1999, None, 2, "", "nazms", "y"), ("bk", "B", "P", 1999, None, 1, "S", "ghazals", "x")], "book_slug string, book_title string, publisher string, year int, collected_in string, ord int, section string, kind string, slug string")
    sinks.write_files(sinks.books(books).unionByName(sinks.container(df, "T", "tt", "D", "slug")), str(tmp_path))
    got = files.containers(spark, f"{tmp_path}/books/bk.yaml").orderBy("pos").collect()
    assert [(r.title, r.slug, r.section, r.kind, r.entry) for r in got] == [("B", "bk", "S", "ghazals", "x"), ("B", "bk", None, "nazms", "y")]
    assert [r.entry for r in files.containers(spark, f"{tmp_path}/containers/tt.yaml").orderBy("pos").collect()] == ["a", "b"]
    (tmp_path / "segments.json").write_text(json.dumps([{"kind": "ghazals", "title": "t", "body": "b", "order": 1, "flags": ["f"]}]))
    assert files.staged(spark, f"{tmp_path}/segments.json").select("kind", "order", "flags").first() == ("ghazals", 1, ["f"])
    staged = spark.createDataFrame([("a", 1), ("b", 2)], "book_slug string, x int")
    sinks.write_staged(staged, f"{tmp_path}/staged")
    sinks.write_staged(spark.createDataFrame([("a", 9)], "book_slug string, x int"), f"{tmp_path}/staged")
    assert sorted((r.book_slug, r.x) for r in spark.read.parquet(f"{tmp_path}/staged").collect()) == [("a", 9), ("b", 2)]


def test_images_and_attachments(spark, tmp_path):
    (tmp_path / "e.xml").write_text("""<rss xmlns:wp="w"><channel><item><wp:post_id>1</wp:post_id><wp:post_type>attachment</wp:post_type><wp:attachment_url>http://h/a-1.jpg</wp:attachment_url></item>
    <item><wp:post_id>2</wp:post_id><wp:post_type>attachment</wp:post_type><wp:attachment_url>http://h/a.jpg</wp:attachment_url></item><item><wp:post_id>3</wp:post_id><wp:post_type>post</wp:post_type></item></channel></rss>""")
    urls = files.attachments(spark, str(tmp_path / "e.xml"))
    assert sorted(map(tuple, urls.collect())) == [(1, "http://h/a-1.jpg"), (2, "http://h/a.jpg")]
    assert [tuple(r) for r in files.keep_first_image(urls, "url", "post_id").collect()] == [(1, "http://h/a-1.jpg", "a.jpg")]


def test_contained_is_a_nested_loop(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    docs = [(n, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for n in range(80)] + [(5, "again w1 w2 w3"), (None, "w1 w2 w3 w4 w5 w6"), (81, None)]
    cut = lambda t: t[rng.randint(0, 3) : len(t) - rng.randint(0, 3)]
    needles = [(n, cut(" ".join(rng.choices(words, k=rng.randint(1, 7))))) for n in range(150)] + [(n + 200, cut(docs[n][1][: rng.randint(10, 80)])) for n in range(60)] + [(1, "w1 w2"), (None, "w3"), (400, ""), (401, None)]
    expected = sorted(((d, n) for d, t in docs for n, s in needles if t is not None and s is not None and s in t), key=str)
    df, nf = spark.createDataFrame(docs, "id int, text string"), spark.createDataFrame(needles, "n int, text string")
    got = contained(df, nf, "text", "text", ["id"], ["n"]).collect()
    assert sorted(((r.id, r.n) for r in got), key=str) == expected and len(expected) > 300

def test_contained_moves_no_words(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x a b c d ez"), (None, "b c"), (3, None)], "id int, text string")
    needles = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "b c"), (4, ""), (5, "b c d e f g"), (None, "c d e"), (6, None)], "n int, text string")
    found = contained(docs, needles, "text", "text", ["id"], ["n"])
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    got, joined = (sorted(((r.id, r.n) for r in f.collect()), key=str) for f in (found, contained(docs, needles, "text", "text", ["id"], ["n"], most=0)))
    assert got == joined == sorted([(1, 1), (1, 2), (1, 3), (1, 4), (1, None)] * 2 + [(2, 1), (2, 2), (2, 3), (2, 4), (2, None), (None, 3), (None, 4)], key=str)


def test_numbers_slugs_and_strings(spark):
    df = spark.createDataFrame([("007",), ("99999999999999999999",), ("12",), ("0",)], "n string")
    assert df.agg(X.largest_of(F.col("n")).alias("m")).first().m == "99999999999999999999"
    row = spark.range(1).select(X.capped(F.lit("a" * 50 + "-" + "b" * 50)).alias("c"), X.capped(F.lit("a" * 90)).alias("h"), X.one_line(F.lit("a\r\nb\rc\nd")).alias("o"), X.thumb(F.lit("x ![](p.jpg) ![](q)")).alias("t"), X.quoted(F.lit('a"\\\n\x01é')).alias("q"), X.stripped(F.lit("\u00a0\t a b \u2003\n")).alias("s")).first()
    assert (row.c, row.h, row.o, row.t, row.s) == ("a" * 50, "a" * 80, "a b c d", "p.jpg", "a b") and json.loads(row.q) == 'a"\\\n\x01é'
