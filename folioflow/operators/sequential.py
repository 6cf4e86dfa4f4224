"""What depends on all that came before it: a file or a verse run at a time, in pandas."""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.codepage import BACK, CODES

_FOLD = str.maketrans("آۂۃؤۓق", "اہہوےک")
LETTERS = "ابپتٹثجچحخدڈذرڑزژسشصضطظعغفقکگلمنںوئیےہھآءۂۓؤۃ"
LOOK_AHEAD = 4
SHORTEST_RHYME = 2
#: Couplets from which on a poem's rhyme is settled, and of a rest that may go back to the poem before it.
SETTLED = 3
REST = 2
_DIGITS = frozenset("۰۱۲۳۴۵۶۷۸۹")
Couplet = tuple[str, str]


def walk(data: bytes) -> list[tuple[list[tuple[int, int]], int]]:
    """((place, code) pairs, geometry) of each paragraph: 04 begins a code, 0D ends a paragraph and has four bytes of
    geometry, which is 0 where the file ends within them. The last paragraph needs no end."""
    out, pairs, at = [], [], 0
    while at < len(data) - 1:
        if data[at] == 0x04:
            pairs.append((at, data[at + 1]))
            at += 2
        elif data[at] == 0x0D:
            geometry = data[at + 1 : at + 5]
            out.append((pairs, int.from_bytes(geometry, "little") if len(geometry) == 4 else 0))
            pairs, at = [], at + 5
        else:
            at += 2
    return [*out, (pairs, 0)]


def by_run(pairs: list[tuple[int, int]], least: int = 2) -> tuple[list[int], list[int]]:
    """The codes in runs of at least so many neighbours, two bytes apart, and the others."""
    kept, alone, run = [], [], []
    for n, (at, code) in enumerate(pairs):
        if run and at != pairs[n - 1][0] + 2:
            (kept if len(run) >= least else alone).extend(run)
            run = []
        run.append(code)
    (kept if len(run) >= least else alone).extend(run)
    return kept, alone


def digits_turned(chars: list[str], codes: list[int]) -> tuple[list[str], list[int]]:
    """Each maximal run of digits in the reverse order, in both lists."""
    order, n = [], 0
    while n < len(chars):
        end = n
        while end < len(chars) and chars[end] in _DIGITS:
            end += 1
        order += range(end - 1, n - 1, -1) if end > n else [n]
        n = max(end, n + 1)
    return [chars[k] for k in order], [codes[k] for k in order]


_PARTS = re.compile(rb"(?s)((?:\x04.)+)|\x0d(.{1,4})|(?:[^\x04\x0d].)+")
_TABLE = "".join(CODES.get(c, "\ufffe") for c in range(256))
_ENCODING = codecs.charmap_build(_TABLE)
_CONTROL = bytes(range(0x20))
_KNOWN = bytes(sorted(CODES))
_TURNED = re.compile(b"[" + bytes(c for c, x in CODES.items() if x in _DIGITS) + b"]{2,}")
#: Codes that a batch of decoded paragraphs holds before it goes on.
BATCH_CODES = 1 << 20


def runs_of(data: bytes) -> Iterator[tuple[list[bytes], int]]:
    """(runs of neighbouring codes, geometry) of each paragraph: the same as walk and by_run, by an expression."""
    runs: list[bytes] = []
    for m in _PARTS.finditer(data):
        if m[1]:
            runs.append(m[1][1::2])
        elif m[2]:
            yield runs, int.from_bytes(m[2], "little") if len(m[2]) == 4 else 0
            runs = []
    yield runs, 0


def decoded(data: bytes) -> list[tuple[str, int, str, bytes]]:
    """(text, geometry, raw, codes) of the paragraphs of an older book file that have text."""
    out = []
    for runs, geometry in runs_of(data):
        codes = b"".join(r for r in runs if len(r) >= 2).translate(None, _CONTROL)
        codes = _TURNED.sub(lambda m: m[0][::-1], codes)
        raw = codecs.charmap_decode(codes, "ignore", _TABLE)[0]
        if text := unicodedata.normalize("NFC", raw).strip():
            out.append((text, geometry, raw, codes))
    return out


def synthesised(text: str) -> list[tuple[str, int, str, bytes]]:
    """The same of a newer book's text, whose lines are parted by carriage returns: a blank line or an ornament begins
    a stanza, and its lines are first and second ones in turn."""
    out, first = [], True
    for line in map(str.strip, text.split("\r")):
        if line == "O":
            out.append(("۰۰۰", 0, "۰۰۰", b""))
        elif line:
            out.append((line, 63 if first else 1, line, b""))
        first = not (line and line != "O" and first)
    return out


def by_part(rows: DataFrame, part: list[str], order: str, make: Callable, schema) -> DataFrame:
    """What make gives for rows in their order: a record batch for a table of whole parts and the (first, end) of each.
    A part's rows come to one task, which takes many parts at a time and holds its largest one."""

    def run(batches):
        import pyarrow as pa

        held, last = [], None
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in part]))
            starts = [n for n, k in enumerate(keys) if k != (keys[n - 1] if n else last)]
            if keys:
                last = keys[-1]
            if starts:
                held.append(b.slice(0, starts[-1]))
                yield from made(pa.Table.from_batches(held))
                held = []
                b = b.slice(starts[-1])
            held.append(b)
        if held:
            yield from made(pa.Table.from_batches(held))

    def made(table):
        if table.num_rows:
            keys = list(zip(*[table.column(c).to_pylist() for c in part]))
            starts = [n for n, k in enumerate(keys) if not n or k != keys[n - 1]]
            yield from make(table, list(zip(starts, [*starts[1:], len(keys)]))).to_batches()

    return rows.repartition(*part).sortWithinPartitions(*part, order).mapInArrow(run, schema)


def _expanded(files: DataFrame, rows_of: Callable[[object], list], kind: str) -> DataFrame:
    def batch(rows):
        import numpy as np
        import pyarrow as pa

        slugs, idx, texts, geometry, raw, codes = zip(*rows)
        places = np.cumsum([0, *map(len, codes)])
        lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.frombuffer(b"".join(codes), np.uint8).astype(np.int32)))
        columns = [pa.array(slugs, pa.string()), pa.array(idx, pa.int32()), pa.array(texts, pa.string()), pa.array(geometry, pa.int64()), pa.array(raw, pa.string()), lists]
        return pa.RecordBatch.from_arrays(columns, names=["book_slug", "idx", "text", "geometry", "raw", "codes"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for slug, data in zip(b.column(0), b.column(1)):
                for i, row in enumerate(rows_of(data.as_py())):
                    held.append((slug.as_py(), i, *row))
                    size += len(row[2]) + len(row[3]) + 64
                    if size >= BATCH_CODES:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return files.select(F.col("book_slug").cast("string").alias("book_slug"), kind).mapInArrow(run, "book_slug string, idx int, text string, geometry bigint, raw string, codes array<int>")


def decode(files: DataFrame) -> DataFrame:
    """(book_slug, idx, text, geometry, raw, codes) of files (book_slug, content) of the older format, a file in one
    task. Null and empty contents have no paragraphs."""
    return _expanded(files, lambda data: decoded(data or b""), "content")


def decode_newer(texts: DataFrame) -> DataFrame:
    """The same of texts (book_slug, text) of the newer format."""
    return _expanded(texts, lambda text: synthesised(text or ""), "text")


def excluded(files: DataFrame) -> DataFrame:
    """(book_slug, isolated, mapped): how many codes stand alone and are left out, and how many of them the code page has."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            isolated, mapped = [], []
            for data in b.column(1):
                alone = b"".join(r for runs, _ in runs_of(data.as_py() or b"") for r in runs if len(r) == 1)
                isolated.append(len(alone))
                mapped.append(len(alone) - len(alone.translate(None, _KNOWN)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(isolated, pa.int64()), pa.array(mapped, pa.int64())], names=["book_slug", "isolated", "mapped"])

    return files.select(F.col("book_slug").cast("string").alias("book_slug"), "content").mapInArrow(run, "book_slug string, isolated bigint, mapped bigint")


def encoded(raw: str) -> bytes:
    """The same as encoded_again, as bytes."""
    return codecs.charmap_encode(raw, "ignore", _ENCODING)[0]


def encoded_again(raw: str) -> list[int]:
    """The codes of what of raw the code page has."""
    return [BACK[c] for c in raw if c in BACK]


def skeleton(line: str, letters: str | None = None) -> str:
    """The letters and single spaces of a line. letters: those of the alphabet; all of Unicode's if None."""
    plain = "".join(c for c in line if c.isspace() or (c.isalpha() if letters is None else c in letters))
    return " ".join(plain.split())


def rhyme_key(line: str, letters: str | None = None) -> str:
    """What of a line rhymes: variants of a letter are one, and a final ہ is ا."""
    return re.sub(r"ہ(?=\s|\Z)", "ا", skeleton(line, letters).translate(_FOLD))


def common_end(keys: list[str]) -> str:
    if not keys:
        return ""
    low, high = min(map(len, keys)), 0
    while high < low and len({k[-1 - high] for k in keys}) == 1:
        high += 1
    return keys[0][len(keys[0]) - high :].lstrip()


def poems(couplets: list[Couplet], pen_name: str | None = None, letters: str | None = None) -> list[int]:
    """The number of each couplet's poem.

    A couplet both of whose lines have the rhyme of the second lines from it on opens a poem, and one that breaks a
    settled rhyme begins another; but a further opening couplet in the same rhyme goes on with its poem, unless the one
    before it has the pen name, which closes a poem. Two couplets at most that have the pen name go back to a poem
    without it. Empty lines, of half couplets, count for no rhyme.
    """
    first = [rhyme_key(a, letters) for a, _ in couplets]
    second = [rhyme_key(b, letters) if b else None for _, b in couplets]
    signed = [bool(pen_name) and any(pen_name in k for k in (a, b) if k) for a, b in zip(first, second)]

    def seconds(where) -> list[str]:
        return [second[k] for k in where if second[k] is not None]

    groups: list[list[int]] = []
    opened = False
    for i, (a, b) in enumerate(couplets):
        ahead = seconds(range(i, min(i + LOOK_AHEAD, len(couplets))))
        forward = len(ahead) >= 2
        rhyme = common_end(ahead) if forward else common_end([first[i], second[i] or ""])
        opens = bool(a and b) and len(rhyme) >= SHORTEST_RHYME and first[i].endswith(rhyme)
        group = groups[-1] if groups else []
        own = seconds(group)
        shared = common_end(own)
        broken = bool(b) and len(group) >= SETTLED and len(shared) >= SHORTEST_RHYME and len(common_end([*own, second[i]])) < SHORTEST_RHYME
        anew = opens or broken
        if anew and group and opens and not broken:
            carried = bool(rhyme) and any(k.endswith(rhyme) for k in own)
            alike = bool(shared) and bool(rhyme) and (shared.endswith(rhyme) or rhyme.endswith(shared))
            anew = not ((carried or not forward) and alike and (len(group) > 1 or opened) and not signed[group[-1]])
        if anew or not group:
            groups.append([i])
        else:
            group.append(i)
        opened = opens
    out, number = [0] * len(couplets), -1
    kept: list[int] = []
    for group in groups:
        if not (kept and len(group) <= REST and any(signed[k] for k in group) and not any(signed[k] for k in kept)):
            kept, number = [], number + 1
        kept = kept + group
        for k in group:
            out[k] = number
    return out


def split_poems(couplets: DataFrame, pen_name: str | None = None, letters: str | None = None) -> DataFrame:
    """couplets (book_slug, idx, first, second) with poem, numbered within the book from 0. Null lines count as empty."""

    def run(book):
        book = book.sort_values("idx")
        return book.assign(poem=poems([(a or "", b or "") for a, b in zip(book["first"], book["second"])], pen_name, letters))

    rows = couplets.select("book_slug", "idx", "first", "second")
    return rows.groupBy("book_slug").applyInPandas(run, "book_slug string, idx int, first string, second string, poem int")
