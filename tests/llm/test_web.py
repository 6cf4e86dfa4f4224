import gzip
import random

import pyarrow as pa
import pytest

from folioflow.llm import html_extract, warc
from folioflow.llm.html_extract import parse


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three</p>", "one\ntwo\nthree"),
        ("<title>t</title><script>var t='</p>';</script><style>p{}</style><p>x</p>", "x"),
        ("<ul><li>a<li>b</ul>c", "a\nb\nc"),
        ("<p>a <b>bold</b>  word</p></div></p>", "a bold word"),
        ("<!-- c --><div title=\"a>b\">in</div><!-- open", "in"),
        ("a < b and <3", "a < b and <3"),
        ("<script>never closed", ""),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ],
)
def test_parse(page, text):
    assert parse(page)[0] == text


def test_equal_subtrees_have_equal_hashes():
    a, b = parse("<nav class=x><a href=1>A</a></nav><p>one</p>")[1], parse("<div><nav><a>A</a></nav></div>")[1]
    assert len(a & b) == 1
    drop = frozenset(a & b)
    assert parse("<nav class=x><a href=1>A</a></nav><p>one</p>", drop)[0] == "one"


def test_templates_are_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        host = f"h{i % 3}.example.com"
        nav = f"<nav><a>home {host}</a> <a>about</a></nav>"
        body = "".join(f"<p>text {rng.randint(0, 30)}</p>" for _ in range(4))
        rows.append((i, f"http://{host}/{i}", f"<html><body>{nav}{body}<footer>foot {i % 2}</footer></body></html>"))
    rows += [(100, None, rows[0][2]), (101, "no host", rows[0][2]), (102, rows[0][1], None), (103, rows[0][1], ""), (None, *rows[0][1:])]
    rows += [(200 + k, "http://one.example.com/", "<p>the same page</p>") for k in range(9)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, TEXT string, `__host` int")
    seen = {}
    for _, u, h in rows:
        host = u.split("/")[2] if u and "//" in u else None
        if host and h is not None:
            for x in parse(h)[1]:
                seen.setdefault((host, x), set()).add(h)
    expected = []
    for i, u, h in rows:
        host = u.split("/")[2] if u and "//" in u else None
        drop = frozenset(x for (at, x), on in seen.items() if at == host and len(on) >= html_extract.MIN_PAGES)
        expected.append((i, host, None if h is None else parse(h, drop)[0]))
    got = html_extract.extract(pages)
    assert got.columns == ["page_id", "__host", "url", "host", "text"]
    assert sorted(((r.page_id, r.host, r.text) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert "home" not in next(t for i, _, t in expected if i == 3) and "the same page" in next(t for i, _, t in expected if i == 200)
    assert html_extract.extract(pages.limit(0)).collect() == []


def test_content_on_few_pages_of_a_large_host_stays(spark):
    rows = []
    for i in range(400):
        # A menu of all pages, one of each of 20 sections, and in articles: a sentence on 5 pages, one on 40, a whole article on 6.
        said = "<h1>Same title</h1><p>said on five</p>" if i % 80 == 0 else "<p>said on forty</p>" if i % 10 == 3 else ""
        article = "<article><p>copied</p><ul><li>whole</li></ul></article>" if i % 70 == 1 else f"<article>{said}<p>only {i}</p></article>"
        rows.append((i, f"http://h.example/{i}", f"<nav><ul><li>home</li></ul></nav><div>section {i % 20}</div>{article}<p>all rights</p><footer><p>foot {i % 20}</p> page {i}</footer>"))
    rows += [(1000 + i, f"http://small.example/{i}", f"<p>said on five</p><p>other {i}</p>") for i in range(5)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(400):
        said = "Same title\nsaid on five\n" if i % 80 == 0 else "said on forty\n" if i % 10 == 3 else ""
        assert got[i] == ("copied\nwhole" if i % 70 == 1 else f"{said}only {i}") + f"\npage {i}"
    assert [got[1000 + i] for i in range(5)] == [f"other {i}" for i in range(5)]


def read(spark, files):
    return warc.responses(warc.records(spark.createDataFrame([(f,) for f in files], "content binary"))).collect()


def test_segments_are_reassembled_in_any_order(spark, tmp_path):
    rng = random.Random(2)
    bodies = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 999, 1000, 5000, 40000]))) for _ in range(30)]
    records = [r for k, b in enumerate(bodies) for r in warc.response(f"<urn:x:{k}>", f"http://h/{k}", b, k, 700)]
    records += records[:5]
    rng.shuffle(records)
    for k in range(3):
        part = records[k::3]
        data = b"".join(map(gzip.compress, part)) if k == 1 else b"".join(part)
        (tmp_path / f"{k}.warc").write_bytes(data)
    got = {int(r.page): r for r in warc.responses(warc.read(spark, str(tmp_path))).collect()}
    assert len(got) == 30
    for k, body in enumerate(bodies):
        assert got[k].state == "complete" and bytes(got[k].body) == body and got[k].http_status == 200 and got[k].uri == f"http://h/{k}"


def test_states(spark):
    made = warc.response("<urn:x:1>", "u", b"b" * 3000, None, 1000)
    assert [r.state for r in read(spark, [b"".join(made)])] == ["complete"]
    assert [r.state for r in read(spark, [b"".join(made[:-1])])] == ["missing segment"]
    assert [r.state for r in read(spark, [b"".join(made[:1] + made[2:])])] == ["missing segment"]
    assert [r.state for r in read(spark, [b"".join(made[1:])])] == ["missing segment"]
    assert [r.state for r in read(spark, [b"".join(made)[:-50]])] == ["truncated"]
    assert [r.state for r in read(spark, [b"".join(made).replace(b"Total-Length: 3", b"Total-Length: 2")])] == ["wrong length"]
    other = warc.response("<urn:x:1>", "u", b"c" * 3000, None, 1000)
    assert [r.state for r in read(spark, [b"".join(made + other)])] == ["conflicting segments"]
    assert [r.state for r in read(spark, [warc._record("response", "<urn:x:2>", b"no http")])] == ["no http response"]
    broken = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc"
    assert [r.state for r in read(spark, [warc._record("response", "<urn:x:2>", broken)])] == ["broken chunk"]
    packed = b"HTTP/1.1 404 No\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"body")
    assert [(r.http_status, bytes(r.body)) for r in read(spark, [warc._record("response", None, packed), None, b"", b"junk"])] == [(404, b"body")]
    assert read(spark, [None]) == [] and read(spark, [warc._record("request", "<urn:x:2>", b"GET")]) == []


def test_chunks():
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for size in (1, 7, 1000):
        assert warc.dechunked(warc.chunked(b"x" * 3000, size)) == b"x" * 3000
    assert warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n") is None and warc.dechunked(b"") is None


def test_pages_round_trip(spark):
    rows = [(1, "http://h/1", "<p>é😀</p>" * 900), (None, None, None), (2, "http://h/2", ""), (2, "http://h/2", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = warc.responses(warc.records(warc.files(pages))).collect()
    assert sorted(((r.page, r.uri, bytes(r.body).decode()) for r in got), key=str) == sorted([("1", *rows[0][1:]), (None, None, ""), ("2", "http://h/2", ""), ("2", "http://h/2", "")], key=str)
    assert warc.responses(warc.records(warc.files(pages.limit(0)))).collect() == []
    assert isinstance(warc._RECORDS, pa.Schema)
