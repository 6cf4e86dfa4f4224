"""Decoding, classification, the assembler and its checks, against plain loops and small cases."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from folioflow.functions.codepage import BACK, CODES
from folioflow.functions.urdu import slugify
from folioflow.operators import assemble, classify, gates, sequential
from folioflow.sources import binary


def coded(text):
    return b"".join(bytes([4, BACK[c]]) for c in text)


def end(geometry):
    return b"\x0d" + struct.pack("<I", geometry)


def test_decoded_paragraphs(spark):
    data = coded("اب ") + end(63) + b"\x07\x07" + coded("۵۸۹۱ د") + end(1) + b"\x04" + bytes([BACK["ا"]]) + end(1) + coded("م") + b"\x07\x07" + coded("ن") + end(2) + coded("سن") + b"\x0d\x01"
    df = spark.createDataFrame([("b", bytearray(data)), ("n", None), ("e", bytearray())], "book_slug string, content binary")
    got = [(r.book_slug, r.idx, r.text, r.geometry) for r in sequential.decode(df).collect()]
    # Codes alone are left out, digits are turned round, and a geometry that the file cuts short is 0.
    assert got == [("b", 0, "اب", 63), ("b", 1, "۱۹۸۵ د", 1), ("b", 2, "سن", 0)]
    assert [tuple(r) for r in sequential.excluded(df).orderBy("book_slug").collect()] == [("b", 3, 3), ("e", 0, 0), ("n", 0, 0)]
    found = sequential.decode(df)
    assert gates.roundtrip(found).collect() == [] and gates.completeness(found).collect() == []
    odd = spark.createDataFrame([("b", 0, "ا", [0x81, 0xC4, 0xC4]), ("b", 1, "ب", [0x81])], "book_slug string, idx int, raw string, codes array<int>")
    assert [r.message for r in gates.completeness(odd).collect()] == ["unmapped codes: 0xc4"]
    assert [r.message for r in gates.roundtrip(odd).collect()] == ["paragraph 2"]


def test_runs_and_digits_are_those_of_the_windows():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(0, 60, 2), 12))
        pairs = [(p, n) for n, p in enumerate(places)]
        kept, alone = sequential.by_run(pairs)
        beside = {p for p in places if p - 2 in places or p + 2 in places}
        assert kept == [n for p, n in pairs if p in beside] and alone == [n for p, n in pairs if p not in beside]
        chars = rng.choices("اب۱۲۳", k=20)
        turned, codes = sequential.digits_turned(chars, list(range(20)))
        plain = "".join(chars)
        expected = "".join(run[::-1] if run[0] in "۱۲۳" else run for run in __import__("re").findall("[۱۲۳]+|[اب]", plain))
        assert "".join(turned) == expected and [plain[c] for c in codes] == turned


def test_runs_by_an_expression_are_those_of_the_walk():
    rng = random.Random(6)
    for _ in range(2000):
        data = bytes(rng.choices([4, 4, 4, 13, 7, 10, 0x81, 0xD1], k=rng.randint(0, 40)))
        plain = [(sequential.by_run(pairs)[0], sequential.by_run(pairs)[1], g) for pairs, g in sequential.walk(data)]
        quick = [([c for r in runs if len(r) > 1 for c in r], [c for r in runs if len(r) == 1 for c in r], g) for runs, g in sequential.runs_of(data)]
        assert quick == plain


def test_code_page_goes_both_ways():
    assert len(CODES) == len(BACK) and all(BACK[c] == k for k, c in CODES.items())
    assert CODES[0x81] == "ا" and CODES[0xA0] == "ن" and CODES[0xD9] == "۹" and CODES[0x20] == " "


def compound(name, stream, size=512):
    """A compound file of one stream, in whole sectors or, if it is short, in small ones."""
    small = len(stream) < 4096
    body = stream + b"\0" * (-len(stream) % size)
    n = len(body) // size
    fat = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE, *range(4, 3 + n), 0xFFFFFFFE]
    fat += [0xFFFFFFFF] * (size // 4 - len(fat))
    table = [*range(1, len(body) // 64), 0xFFFFFFFE] if small else []
    table += [0xFFFFFFFF] * (size // 4 - len(table))

    def entry(title, kind, start, length):
        raw = title.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HB", len(raw), kind) + b"\0" * 49 + struct.pack("<IQ", start, length)

    entries = entry("Root Entry", 5, 3 if small else 0xFFFFFFFE, len(body) if small else 0) + entry(name, 2, 0 if small else 3, len(stream))
    head = binary._SIGNATURE + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10 + struct.pack("<IIIIIIIII", 1, 1, 0, 4096, 2 if small else 0xFFFFFFFE, int(small), 0xFFFFFFFE, 0, 0)
    head += struct.pack("<108I", *[0xFFFFFFFF] * 108)
    return head + struct.pack(f"<{size // 4}I", *fat) + entries.ljust(size, b"\0") + struct.pack(f"<{size // 4}I", *table) + body


@pytest.mark.parametrize(("times", "long"), [(3, 1), (1200, 20)])
def test_book_files(spark, tmp_path, times, long):
    older = coded("اب") * times
    newer = b"\x01\x00" * 512 + ("ایک\rدو\r\rO\rتین\r" * (100 * long)).encode("utf-16-le") + b"\x00\x00" * 600
    for name, data in {"a.INP": compound("InPage100", older), "b.inp": compound("InPage300", newer), "c.inp": compound("Other", b"x"), "d.inp": b"none", "e.inp": compound("InPage100", older)[:700]}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.book_slug: r for r in binary.book_streams(spark, str(tmp_path)).collect()}
    assert bytes(got["a"].content) == older and got["a"].format == "older"
    assert got["b"].format == "newer" and got["b"].text.startswith("ایک\rدو\r\rO\rتین") and len(got["b"].text) == 1400 * long
    assert [got[k].problem for k in "cde"] == ["no stream of text", "no compound file", "no compound file"]
    lines = sequential.decode_newer(spark.createDataFrame([("b", got["b"].text[:14])], "book_slug string, text string")).collect()
    assert [(r.text, r.geometry) for r in lines] == [("ایک", 63), ("دو", 1), ("۰۰۰", 0), ("تین", 63)]


def loop_kinds(rows, headings, header):
    """The kinds by the rules, line by line. rows: (text, geometry)."""
    verse = lambda t: 15 <= len(t) <= 62
    start = len(rows)
    for n in range(len(rows) - 3):
        if all(verse(rows[n + k][0]) and (rows[n + k][1] == 1) == bool(k % 2) for k in range(4)):
            start = n
            for m in reversed(range(n)):
                if rows[m][0] == "۰۰۰":
                    start = m + 1
                if rows[m][0] == "۰۰۰" or len(rows[m][0]) > 100:
                    break
            break
    plain = [t for t, _ in rows]
    kinds = []
    for n, t in enumerate(plain):
        numbers = t and not t.strip("۰۱۲۳۴۵۶۷۸۹۔ ")
        if t == "۰۰۰":
            kinds.append("separator")
        elif numbers:
            kinds.append("toc")
        elif n >= start and t and len(t) < 101 and plain[start:].count(t) > header:
            kinds.append("running_header")
        elif t in headings:
            kinds.append("heading")
        elif t.endswith("۱۹۸۵ء"):
            kinds.append("colophon")
        elif len(t) > 100:
            kinds.append("prose")
        elif n >= start and 15 <= len(t) <= 100:
            kinds.append("verse")
        else:
            kinds.append("front_matter" if n < start else "unknown")
    group = [None if t.startswith("( نذر ") else "unknown" if k == "prose" and t[0] == "(" else k if k in ("unknown", "prose") else None for k, t in zip(kinds, plain)]
    n = 0
    while n < len(kinds):
        end = n + 1
        while end < len(kinds) and group[end] == group[n]:
            end += 1
        if group[n] and 0 < n and end < len(kinds) and kinds[n - 1] == kinds[end] == "verse" and (group[n] == "unknown" or end - n == 1):
            kinds[n:end] = ["verse"] * (end - n)
        n = end
    return start, kinds


def some_book(rng, n):
    made = {
        "v": lambda: "م" * rng.randint(15, 62), "l": lambda: "ن" * rng.randint(63, 100), "p": lambda: rng.choice("پ(") + "پ" * rng.randint(101, 130), "s": lambda: "۰۰۰",
        "t": lambda: "۱۲۔", "h": lambda: "غزلیں", "c": lambda: "مارچ ۱۹۸۵ء", "u": lambda: "ب" * rng.randint(1, 9), "d": lambda: "( نذر ا )", "r": lambda: "سرخی",
    }
    out = []
    while len(out) < n:
        k = rng.choice("vvvvvvlpstthcuudr")
        out += [(made["v"](), 63), (made["v"](), 1)] * rng.randint(1, 3) if k == "v" else [(made[k](), rng.choice([0, 1]))]
    return out


def test_kinds_are_those_of_a_loop(spark):
    rng = random.Random(3)
    books = {b: some_book(rng, rng.randint(0, 40)) for b in range(60)}
    rows = [(b, n, t, g) for b, book in books.items() for n, (t, g) in enumerate(book)]
    df = spark.createDataFrame(rows, "book_slug int, idx int, text string, geometry bigint")
    got = {(r.book_slug, r.idx): (r.start, r.kind) for r in classify.classified(df, ["book_slug"], "idx", ("غزلیں",), header=2).collect()}
    for b, book in books.items():
        start, kinds = loop_kinds(book, {"غزلیں"}, 2)
        assert [got[b, n] for n in range(len(book))] == [(start, k) for k in kinds]


def test_kinds_take_one_shuffle_and_books_longer_than_a_batch(spark):
    rng = random.Random(8)
    rows = [(b, n, t, g) for b in range(12) for n, (t, g) in enumerate(some_book(rng, rng.randint(1, 40)))]
    df = spark.createDataFrame(rows, "book_slug int, idx int, text string, geometry bigint")
    found = classify.classified(df, ["book_slug"], "idx", ("غزلیں",), header=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    whole = sorted(map(tuple, found.collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, found.collect())) == whole and len(whole) == len(rows)
        made = assemble.assembled(classify.with_sections(found.withColumn("book_slug", F.col("book_slug").cast("string")), ["book_slug"], "idx", ("غزلیں",)))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroups" not in plan and made.select("book_slug").distinct().count() == 12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sections_and_numbers(spark):
    rows = [("b", 0, "۹۹ ۱۲", "toc", 2), ("b", 1, "۰۰۰", "separator", 2), ("b", 2, "H", "running_header", 2), ("b", 3, "غزلیں", "heading", 2), ("b", 4, "x", "verse", 2), ("b", 5, "I", "running_header", 2), ("c", 0, "x", "verse", 0)]
    df = spark.createDataFrame(rows, "book_slug string, idx int, text string, kind string, start int")
    got = classify.with_sections(df, ["book_slug"], "idx", ("غزلیں",)).orderBy("book_slug", "idx").collect()
    assert [(r.collection, r.section, r.section_run) for r in got] == [("", "", 0), ("", "", 0), ("H", "", 0), ("H", "غزلیں", 1), ("H", "غزلیں", 1), ("I", "غزلیں", 1), ("", "", 0)]
    assert (got[0].first_heading, got[0].first_header, got[0].header_name, got[6].first_header) == (3, 2, "H", None)
    assert sorted(map(tuple, classify.contents_count(df, ["book_slug"], "idx").collect())) == [("b", "99"), ("c", None)]


def test_poems_by_rhyme():
    one = [("moon rise", "sun rise"), ("x one", "late rise"), ("y two", "dawn rise")]
    two = [("red wall", "tall wall"), ("p", "small wall"), ("q", "old wall")]
    assert sequential.poems(one + two) == [0, 0, 0, 1, 1, 1]
    # A second opening in the same rhyme goes on, unless the pen name has closed the poem.
    again = [("noon rise", "soon rise"), ("z", "far rise")]
    assert sequential.poems(one[:1] + again + one[1:]) == [0] * 5
    closed = [one[0], ("Zed said", "a rise"), *again]
    assert sequential.poems(closed, "Zed") == [0, 0, 1, 1]
    # One letter is no rhyme, also with the space before it.
    single = [("ab k", "cd k"), ("ef k", "gh k"), ("ij m", "kl k"), ("mn k", "op k")]
    assert sequential.poems(single) == [0, 0, 0, 0]
    # A half couplet has no say in the rhyme; a settled rhyme that breaks ends a poem.
    half = [one[0], ("half", ""), one[1], one[2], ("w", "other end"), ("v", "an end")]
    assert sequential.poems(half) == [0, 0, 0, 0, 1, 1]
    # A short rest with the pen name goes back.
    rest = [*one, ("red wall", "tall wall Zed")]
    assert sequential.poems(rest, "Zed") == [0, 0, 0, 0]
    assert sequential.poems([]) == [] and sequential.poems([("", "")]) == [0]


V = "م" * 20
P = "پ" * 120


def assemble_lines(spark, rows, **options):
    """rows: (kind, text, geometry)."""
    df = spark.createDataFrame([("b", n, t, g, k, 0) for n, (k, t, g) in enumerate(rows)], "book_slug string, idx int, text string, geometry bigint, kind string, start int")
    found = assemble.assembled(classify.with_sections(df, ["book_slug"], "idx", ("غزلیں", "نعت")), **options)
    return found, assemble.pieces(found).orderBy("ord").collect(), [(r.what, r.at) for r in found.where("what <> 'piece'").orderBy("at").collect()]


def test_assembler_branches(spark):
    rows = [
        ("colophon", "early ۱۹۸۵ء", 0), ("unknown", "lost title", 0), ("unknown", "A title", 0), ("verse", V + "1", 63), ("verse", V + "2", 63), ("colophon", "note", 0), ("unknown", "(نذرِ کسی)", 0),
        ("heading", "غزلیں", 0), ("verse", V + "3", 63), ("verse", V + "4", 1), ("verse", V + "5", 63), ("verse", V + "6", 1), ("running_header", "Coll", 0), ("separator", "۰۰۰", 0), ("unknown", "Head line", 0),
        ("unknown", "ڈاکٹر Name", 0), ("prose", P, 0), ("colophon", "later", 0), ("separator", "۰۰۰", 0), ("unknown", "tail", 0),
    ]
    found, pieces, rest = assemble_lines(spark, rows)
    assert [(p.kind, p.title, p.written_note) for p in pieces] == [("nazms", "A title", "early ۱۹۸۵ء note"), ("ghazals", V + "3", ""), ("reviews", "Head line", "later")]
    assert pieces[0].dedication == "(نذرِ کسی)" and pieces[0].body == f"{V}1\n{V}2"
    assert pieces[1].body == f"{V}3\n{V}4\n\n{V}5\n{V}6" and pieces[1].section == "غزلیں"
    assert pieces[2].reviewed_author == "ڈاکٹر Name" and pieces[2].body == f"Head line\n\nڈاکٹر Name\n\n{P}" and pieces[2].flags == []
    # Pieces before the first running header get its name; the section's owner has it too, so all keep the section.
    assert [p.collection for p in pieces] == ["Coll"] * 3 and [p.attributed for p in pieces] == [True, True, False]
    assert [p.precedes_first_heading for p in pieces] == [True, False, False]
    assert rest == [("dropped", 1), ("unreached", 7), ("unreached", 12), ("unreached", 13), ("unreached", 18), ("dropped", 19)]


def test_assembler_essays(spark):
    signed = [x for n in range(3) for x in (("prose", f"{P}{n}", 0), ("colophon", f"date{n}", 0), ("unknown", f"(Critic{n}- ‘‘Book{n}’’)", 0))]
    _, pieces, _ = assemble_lines(spark, [*signed, ("unknown", "after", 0)])
    assert [(p.title, p.reviewed_author, p.reviewed_book, p.written_note) for p in pieces] == [(f"Critic{n}", f"Critic{n}", f"Book{n}", f"date{n}") for n in range(3)] + [("after", "", "", "")]
    rows = [("unknown", "Cover", 0), ("unknown", "(imprint)", 0), ("unknown", "Essay", 0), ("prose", P, 0)]
    _, pieces, _ = assemble_lines(spark, rows, prose_titles=("Essay",))
    assert [(p.kind, p.title, p.flags) for p in pieces] == [("nazms", "Cover", [assemble.TITLE_PAGE]), ("reviews", "Essay", [assemble.BYLINE])]
    half = [("verse", V + str(n), g) for n, g in enumerate([63, 1] * 10)] + [("verse", "(نذرِ دوست)", 63)]
    _, (piece,), _ = assemble_lines(spark, half, explicit_pieces=True)
    assert piece.dedication == "(نذرِ دوست)" and piece.flags == [] and piece.body.count("\n\n") == 9


def test_assembled_verse_is_conserved(spark):
    rng = random.Random(9)
    rows = [(f"b{b}", n, f"{t}{n}" if len(t) > 14 else t, g) for b in range(25) for n, (t, g) in enumerate(some_book(rng, 40))]
    df = spark.createDataFrame(rows, "book_slug string, idx int, text string, geometry bigint")
    lines = classify.with_sections(classify.classified(df, ["book_slug"], "idx", ("غزلیں",), header=2), ["book_slug"], "idx", ("غزلیں",))
    found = assemble.assembled(lines)
    pieces = assemble.pieces(found)
    assert gates.conservation(lines, pieces).collect() == []
    fewer = pieces.where("ord > 1")
    assert gates.conservation(lines, fewer).count() > 0
    assert gates.conservation(lines, pieces.unionByName(pieces)).where("message like 'doubled%'").count() > 0
    # Each verse line is in a piece, and what isn't reached is told.
    assert found.where("what <> 'piece' and kind = 'verse'").count() == 0
    assert assemble.assembled(lines.limit(0)).collect() == []


def pieces_of(spark, rows):
    schema = "book_slug string, ord int, kind string, title string, body string, collection string, section string, flags array<string>, reviewed_author string, dedication string, section_run bigint, precedes_first_heading boolean"
    return spark.createDataFrame([(*r, "", "", 0, False)[:12] for r in rows], schema)


def test_gathered_collections(spark):
    names = spark.createDataFrame([("ماں کے نام", "One")], "dedication string, name string")
    page, other = "موسم\n(مئی ۱۹۸۵ئ، لاہور)\nماں کے نام", "x\n(۱۹۹۳ئ، لاہور)\nدوست کے لیے"
    rows = [("b", 1, "ghazals", "t", "a", "", "s", []), ("b", 2, "nazms", "موسم", page, "", "", []), ("b", 3, "ghazals", "t", "b", "old", "s", []), ("b", 4, "nazms", "x", other, "", "", []), ("b", 5, "ghazals", "t", "c", "old", "s", [])]
    got = assemble.gathered(pieces_of(spark, rows), names).orderBy("ord").collect()
    assert [r.collection for r in got] == ["", "", "One", "", ""]
    assert [assemble.TITLE_PAGE in r.flags for r in got] == [False, True, False, True, False] and got[3].title_page == "دوست کے لیے"
    kept = assemble.sections_kept(assemble.gathered(pieces_of(spark, rows), names)).orderBy("ord").collect()
    assert [r.section for r in kept] == ["s", "", "", "", "s"]


def test_flags_and_titles(spark):
    line = "ا" * 30
    rows = [("b", 1, "ghazals", "t", f"{line}\nب", "", "s", []), ("b", 2, "reviews", "t", f"{line}\n{line}\nx", "", "s", []), ("b", 3, "nazms", "t", "one", "", "", []), ("b", 4, "reviews", "t", "text", "", "", ["confirm-review-byline"])]
    df = pieces_of(spark, rows)
    flags = lambda d: [r.flags for r in d.orderBy("ord").collect()]
    assert flags(gates.flag_indexes(df, ["book_slug"], ["book_slug", "ord"])) == [[], [gates.INDEX], [], ["confirm-review-byline"]]
    assert flags(gates.flag_single_lines(gates.flag_single_lines(df))) == [[], [], [gates.SINGLE], ["confirm-review-byline"]]
    words = spark.createDataFrame([("w1",), ("one",)], "word string")
    long = pieces_of(spark, [("b", 1, "ghazals", "t", "one " * 12, "", "", []), ("b", 2, "ghazals", "t", "foo " * 12, "", "", []), ("b", 3, "ghazals", "t", "foo " * 11, "", "", [])])
    got = gates.flag_garbage(long, words, ["book_slug", "ord"]).orderBy("ord").collect()
    assert [(r.evidence, r.flags) for r in got] == [(None, []), ("known words", [gates.GARBAGE]), (None, [])]
    assert [r.section for r in gates.sections_cleared(df, ["book_slug"], 0.5).orderBy("ord").collect()] == ["", "", "", ""]
    printed = spark.createDataFrame([("", 1, "First", "A"), ("", 2, "Second", "B"), ("z", 1, "T", "C")], "collection string, pos int, title string, author string")
    named, problems = gates.titled(df, printed, ["collection"])
    assert [(r.title, r.reviewed_author, r.flags) for r in named.where("kind = 'reviews'").orderBy("ord").collect()] == [("First", "A", []), ("Second", "B", [])]
    assert [r.message for r in problems.collect()] == ["1 listed, 0 staged"]


def test_counts_and_floors(spark):
    lines = spark.createDataFrame([("b", 0, "۳ ۲", "toc", 3), ("b", 1, V, "front_matter", 3), ("b", 2, "غلط سطر" * 3, "front_matter", 3), ("b", 3, "x", "verse", 3)], "book_slug string, idx int, text string, kind string, start int")
    pieces = pieces_of(spark, [("b", 1, "ghazals", "t", f"{V}\nx", "", "", []), ("b", 2, "ghazals", "t", "y\nz", "", "", [gates.INDEX]), ("b", 3, "reviews", "t", "y", "", "", [])])
    assert [r.message for r in gates.contents_counts(lines, pieces).collect()] == ["2 poems, 3 declared"]
    declared = spark.createDataFrame([("", 1), ("gone", 2)], "collection string, expected int")
    assert [r.message for r in gates.declared_counts(pieces, declared).collect()] == ["0 poems, 2 declared"]
    floors = spark.createDataFrame([("b", 2)], "book_slug string, minimum int")
    assert [r.message for r in gates.front_floor(lines, pieces, floors).collect()] == ["1 lines match, at least 2 should"]
    assert [tuple(r) for r in gates.index_matches(lines, pieces).collect()] == [("b", "", 2, 2)]
    most = spark.createDataFrame([("b", "", 3), ("b", "none", 1)], "book_slug string, collection string, minimum int")
    assert sorted(r.message for r in gates.index_floors(lines, pieces, most).collect()) == ["0 of 0 poems match, at least 1 should", "2 of 2 poems match, at least 3 should"]


def test_holders(spark):
    one, two = "alpha beta gamma delta epsilon", "zeta eta theta iota kappa"
    known = spark.createDataFrame([("ok", f"{one}\n{two}"), ("none", "no such line here at all"), ("late", "lambda mu nu xi omicron")], "slug string, body string")
    pieces = pieces_of(spark, [("b", 1, "ghazals", "t", f"{one}\n{two}", "", "", []), ("b", 2, "ghazals", "t", "first line\nlambda mu nu xi omicron", "", "", [])])
    assert {r.key: r.message for r in gates.holders(pieces, known).collect()} == {"none": "held by 0 pieces", "late": "doesn't open its piece"}


def test_approval(spark):
    good = "# R\n## Approval\nsegmentation: ffffffffffffffff\napproved: true\n## Approval\nsegmentation: 0123456789abcdef\napproved: false\nseen\napproved: true\n"
    rows = [(1, good, "0123456789abcdef"), (2, good, "f" * 16), (3, good + "approved: yes\n", "0123456789abcdef"), (4, "approved: true\nsegmentation: 0123456789abcdef", "0123456789abcdef"), (5, None, "a")]
    df = spark.createDataFrame(rows, "id int, report string, digest string")
    got = df.select("id", gates.approved(F.col("report"), F.col("digest")).alias("a"), gates.restamped(F.col("report"), F.lit("a" * 16)).alias("r")).orderBy("id").collect()
    assert [r.a for r in got] == [True, False, True, False, False]
    assert got[0].r == good.replace("0123456789abcdef", "a" * 16)[: -len("approved: true\n")] + "approved: false\n"
    assert got[3].r is None and got[4].r is None
    pieces = pieces_of(spark, [("b", 1, "ghazals", "a\nb", "x\n\ny", "", "s", []), ("b", 2, "reviews", "t", "x", "", "", ["f"])]).withColumn("digest", F.lit("0123456789abcdef"))
    text = gates.report(pieces, gates.completeness(spark.createDataFrame([("b", [0xC4])], "book_slug string, codes array<int>")), "digest").first().report
    assert "2 pieces detected, 1 flagged." in text and "   1. ghazals  [s] a b  (2 sher)" in text and "(1 para)  ** f" in text and "completeness: unmapped codes: 0xc4" in text
    made = spark.createDataFrame([(text, "0123456789abcdef")], "report string, digest string")
    assert made.select(gates.approved(F.col("report"), F.col("digest")).alias("a")).first().a is False


def test_slugs_in_latin():
    assert slugify("درس گاہ-  53") == "dars-gah-53" and slugify("میں") == "mein" and slugify("") == ""
    assert slugify("یاد") == "yad" and slugify("مکتب") == "makatab" and slugify("Hello, World") == "hello-world" and slugify("قلم کار") == "qalam-kar"
