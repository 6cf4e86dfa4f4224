"""The kinds of a book's lines, and what lines above them say of them: a book at a time, in its order."""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import text as X
from folioflow.operators import ordered, sequential

SEPARATOR = "۰۰۰"
#: Lengths of verse, up to two lines run together, and of prose from.
VERSE = (15, 62)
TOGETHER = 100
PROSE = 101
COLOPHON = 50
#: A line of the body that occurs more often is a running header.
HEADER = 55
MONTHS = "جنوری فروری مارچ اپریل مئی جون جولائی اگست ستمبر اکتوبر نومبر دسمبر"
_CONTENTS = r"\A[۰-۹۔\s ]+\z"
_YEAR = r"[۰-۹]{4}\s*[ئء]"
_MONTH = r"(?:" + "|".join(MONTHS.split()) + r")[۰-۹\s،,-]{0,6}[ئء]"
DEDICATION = r"\A\(\s*نذرِ?\s+.+\)\z"


def is_verse(t: Column) -> Column:
    return F.length(t).between(*VERSE)


def is_contents(t: Column) -> Column:
    return t.rlike(_CONTENTS)


def is_colophon(t: Column) -> Column:
    """A short line with a year, or with a month and not all in brackets."""
    dated = t.rlike(_YEAR) | (t.rlike(_MONTH) & ~t.rlike(r"(?s)\A\(.*\)\z"))
    return (F.length(t) <= COLOPHON) & dated


def header_like(t: Column, separator: str = SEPARATOR) -> Column:
    return (t != "") & (F.length(t) < PROSE) & (t != separator) & ~is_contents(t)


def with_start(rows: DataFrame, part: list[str], order: str, text: str = "text", geometry: str = "geometry", separator: str = SEPARATOR) -> DataFrame:
    """rows with start: where in its part the body begins, the number of rows if nowhere. order counts from 0."""
    t = X.stripped(F.col(text))
    found = ordered.body_start(rows, part, order, is_verse(F.col(text)), F.col(geometry) == 1, separator=t == separator, prose=F.length(t) >= PROSE)
    return rows.join(found, part)


def classified(
    rows: DataFrame,
    part: list[str],
    order: str,
    headings: tuple[str, ...] = (),
    separator: str = SEPARATOR,
    header: int = HEADER,
    text: str = "text",
    geometry: str = "geometry",
) -> DataFrame:
    """rows with start and kind. The first that fits: separator, toc, running_header, heading, colophon, prose, verse,
    front_matter, unknown; then unknown lines, and single ones of prose, between verse are verse.

    headings are compared by their letters. A text in brackets counts as unknown there even if it is prose, and a
    dedication is no verse. A null text is an empty one.
    """
    part = list(part)
    known = frozenset(X.plain_skeleton(h) for h in headings)
    plain = rows.withColumn(text, F.coalesce(F.col(text), F.lit("")))

    def make(table, bounds):
        import pyarrow as pa

        at, texts, marks = (table.column(c).to_pylist() for c in (order, text, geometry))
        starts, kinds = [], []
        for a, b in bounds:
            start, own = kinds_of(at[a:b], texts[a:b], marks[a:b], known, separator, header)
            starts += [start] * (b - a)
            kinds += own
        return table.append_column("start", pa.array(starts, pa.int64())).append_column("kind", pa.array(kinds, pa.string()))

    return sequential.by_part(plain, part, order, make, T.StructType([*plain.schema, T.StructField("start", T.LongType()), T.StructField("kind", T.StringType())]))


def _re(java: str) -> re.Pattern:
    return re.compile(java.replace(r"\z", r"\Z").replace(".+", r"[^\n\r\x85\u2028\u2029]+"), re.ASCII)


_CONTENTS_RE, _YEAR_RE, _MONTH_RE, _DEDICATION_RE = map(_re, (_CONTENTS, _YEAR, _MONTH, DEDICATION))


def _letters(line: str, most: int) -> str | None:
    """The letters and single spaces of a line; None where it has more letters than most."""
    out, n = [], 0
    for c in line:
        if c.isalpha():
            n += 1
            if n > most:
                return None
            out.append(c)
        elif c in " \t\r\n":
            out.append(c)
    return " ".join("".join(out).split())


def _start(at: list[int], texts: list[str], lines: list[str], marks: list, separator: str) -> int:
    """Where the body of a book begins, as ordered.body_start has it."""
    fits = [VERSE[0] <= len(t) <= VERSE[1] for t in texts]
    first = next((n for n in range(len(at) - 3) if all(fits[n + k] and marks[n + k] is not None and (marks[n + k] == 1) == (k % 2 == 1) for k in range(4))), None)
    if first is None:
        return len(at)
    fenced = next((n for n in range(first - 1, -1, -1) if lines[n] == separator), None)
    if fenced is None or any(len(t) >= PROSE for t in lines[fenced + 1 : first]):
        return at[first]
    return at[fenced + 1]


def kinds_of(at: list[int], texts: list[str], marks: list, known: frozenset[str], separator: str = SEPARATOR, header: int = HEADER) -> tuple[int, list[str]]:
    """(start, kinds) of a book's lines in their order; known has the letters of headings."""
    lines = [t.strip() for t in texts]
    start = _start(at, texts, lines, marks, separator)
    often = Counter(t for n, t in zip(at, lines) if n >= start)
    most = max((sum(map(str.isalpha, k)) for k in known), default=0)
    kinds = []
    for n, t in zip(at, lines):
        body, size = n >= start, len(t)
        if t == separator:
            kind = "separator"
        elif _CONTENTS_RE.match(t):
            kind = "toc"
        elif body and t and size < PROSE and often[t] > header:
            kind = "running_header"
        elif known and _letters(t, most) in known:
            kind = "heading"
        elif size <= COLOPHON and (_YEAR_RE.search(t) or _MONTH_RE.search(t) and not (size > 1 and t[0] == "(" and t[-1] == ")")):
            kind = "colophon"
        elif size >= PROSE:
            kind = "prose"
        elif body and VERSE[0] <= size <= TOGETHER:
            kind = "verse"
        else:
            kind = "unknown" if body else "front_matter"
        kinds.append(kind)
    groups = [None if k not in ("unknown", "prose") or _DEDICATION_RE.match(t) else "unknown" if t[:1] == "(" else k for k, t in zip(kinds, lines)]
    out, at_ = list(kinds), 0
    for group, run in groupby(groups):
        end = at_ + len(list(run))
        if group and 0 < at_ and end < len(kinds) and kinds[at_ - 1] == kinds[end] == "verse" and (group == "unknown" or end - at_ == 1):
            out[at_:end] = ["verse"] * (end - at_)
        at_ = end
    return start, out


def with_sections(rows: DataFrame, part: list[str], order: str, headings: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """classified rows with collection, the last running header so far; section, the last heading of the body so far;
    section_run, which heading that is; first_heading and first_header, where the first of the body are; header_name.

    Headings are named as in headings. Nothing so far is the empty text.
    """
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    named = F.create_map(*[x for h in headings for x in (F.lit(X.plain_skeleton(h)), F.lit(h))]) if headings else None
    is_heading = (F.col("kind") == "heading") & (F.col(order) >= F.col("start"))
    name = F.when(is_heading, named[X.skeleton(F.col(text))]) if headings else F.lit(None).cast("string")
    is_header = F.col("kind") == "running_header"
    header = F.when(is_header, F.col(text))
    return rows.withColumns(
        {
            "collection": F.coalesce(F.last(header, ignorenulls=True).over(w), F.lit("")),
            "section": F.coalesce(F.last(name, ignorenulls=True).over(w), F.lit("")),
            "section_run": F.count(F.when(is_heading, 1)).over(w),
            "first_heading": F.min(F.when(is_heading, F.col(order))).over(whole),
            "first_header": F.min(F.when(is_header, F.col(order))).over(whole),
            "header_name": F.min_by(header, F.when(is_header, F.col(order))).over(whole),
        }
    )


def contents_count(rows: DataFrame, part: list[str], order: str, separator: str = SEPARATOR, text: str = "text") -> DataFrame:
    """(part, declared): the largest number above 0 of the contents lines before the body; null where there is none.
    Numbers of any length are read."""
    t = X.stripped(F.col(text))
    front = rows.where((F.col(order) < F.col("start")) & (t != separator) & is_contents(t))
    found = front.select(*part, F.explode(F.regexp_extract_all(t, F.lit("[۰-۹]+"), 0)).alias("n"))
    largest = X.largest_of(X.latin_digits(F.col("n")))
    declared = found.groupBy(*part).agg(largest.alias("declared"))
    return rows.select(*part).distinct().join(declared.select(*part, F.when(F.col("declared") != "0", F.col("declared")).alias("declared")), part, "left")
