"""Scalar functions on text, as Spark columns. Nulls give nulls."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks of Arabic script over and under letters.
MARKS = r"\p{M}+"
FOLDED = ("يكىةأإ", "یکیہاا")
DIGITS = ("0123456789", "۰۱۲۳۴۵۶۷۸۹")


def skeleton(text: Column, letters: str = r"\p{L}") -> Column:
    """Letters and single spaces alone."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, rf"[^{letters} \t\r\n]", ""), r"[ \t\r\n]+", " "))


def plain_skeleton(text: str) -> str:
    """The same of a Python string."""
    return " ".join("".join(c for c in text if c.isalpha() or c in " \t\r\n").split())


#: What Python takes for white space, as characters of an expression.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def stripped(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(_SPACES))


def words(text: Column) -> Column:
    return F.filter(F.split(skeleton(text), " "), lambda w: w != "")


def lines(text: Column) -> Column:
    """The lines that aren't blank, trimmed."""
    return F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(s)), lambda s: s != "")


#: Texts that are held as Python's strings at a time.
SLICE = 256


def _each(make):
    """A function of a column that holds SLICE texts at a time besides the batch and its result."""

    def run(texts):
        import pyarrow as pa

        made = [pa.array([None if t is None else make(t) for t in texts.slice(n, SLICE).to_pylist()], pa.string()) for n in range(0, len(texts), SLICE)]
        return pa.concat_arrays(made) if made else texts

    return F.arrow_udf(run, T.StringType())


nfc = _each(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))
unescaped = _each(html.unescape)


_ENDED = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+)|[A-Za-z][A-Za-z0-9]*);")


def _read(found: re.Match) -> str:
    mark = found[0]
    return html.unescape(mark) if mark[1] == "#" else html5.get(mark[1:], mark)


#: Entities that a semicolon ends alone: one that was cut off stays as it is, and makes none with what comes next.
unescaped_ended = _each(lambda t: _ENDED.sub(_read, t) if "&" in t else t)


def folded(text: Column) -> Column:
    """What a search compares: composed, without marks, with variant letters as one, single spaces."""
    plain = F.translate(F.regexp_replace(nfc(text), MARKS, ""), *FOLDED)
    return F.trim(F.regexp_replace(plain, r"[ \t\r\n]+", " "))


def without_tags(page: Column, ended: bool = False) -> Column:
    """Comments, images, tags, lengthened letters and all white space dropped, and entities read. ended: those alone that
    a semicolon ends."""
    plain = F.regexp_replace(F.regexp_replace(page, r"(?s)<!--.*?-->", ""), r"!\[[^\]]*\]\([^)]*\)", " ")
    plain = (unescaped_ended if ended else unescaped)(F.regexp_replace(plain, r"<[^>]+>", " "))
    return F.regexp_replace(plain, rf"[ـ{SPACE}]+", "")


def stripped_lines(text: Column) -> Column:
    """The lines that aren't blank, without white space of any kind at their ends."""
    return F.filter(F.transform(F.split(text, "\n"), stripped), lambda s: s != "")


def cleaned(page: Column, ended: bool = False) -> Column:
    """Line breaks kept as lines, tags and lengthened letters dropped, entities read, blank lines dropped. ended: as above."""
    broken = F.regexp_replace(page, r"(?i)<br\s*/?>", "\n")
    read = (unescaped_ended if ended else unescaped)(F.regexp_replace(broken, r"<[^>]+>", ""))
    return F.array_join(stripped_lines(F.replace(read, F.lit("ـ"), F.lit(""))), "\n")


def largest_of(digits: Column) -> Column:
    """The largest of a group's whole numbers of any length, given and returned as their digits."""
    plain = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.max_by(plain, F.struct(F.length(plain), plain))


def capped(slug_: Column, most: int = 80) -> Column:
    """A slug of at most so many characters, cut at its last hyphen there if there is one."""
    head = F.substring(slug_, 1, most)
    at_word = F.regexp_extract(head, r"^(.+)-[^-]*$", 1)
    cut = F.regexp_replace(F.when(at_word == "", head).otherwise(at_word), "^-+|-+$", "")
    return F.when(F.length(slug_) <= most, slug_).otherwise(cut)


def one_line(text: Column) -> Column:
    """Line ends as spaces."""
    return F.regexp_replace(text, r"\r\n|\r|\n", " ")


def quoted(text: Column) -> Column:
    """text as a JSON string."""
    out = text
    for plain, mark in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        out = F.replace(out, F.lit(plain), F.lit(mark))
    rare = out
    for code in (*range(8), 11, *range(14, 32)):
        rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    out = F.when(out.rlike(r"[\x00-\x1f]"), rare).otherwise(out)
    return F.concat(F.lit('"'), out, F.lit('"'))


def slug(title: Column, most: int = 80) -> Column:
    """Lower case, one hyphen for what is neither letter nor digit; cut at a hyphen if longer than most."""
    full = F.regexp_replace(F.regexp_replace(F.lower(title), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    head = F.substring(full, 1, most)
    at_word = F.regexp_replace(head, r"-[^-]*$", "")
    whole = F.substring(full, most + 1, 1) == "-"
    return F.when(F.length(full) <= most, full).otherwise(F.regexp_replace(F.when(whole | (at_word == ""), head).otherwise(at_word), r"-+$", ""))


def image_path(url: Column) -> Column:
    """The file's name without a size or a copy's number before its ending."""
    name = F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1)
    return F.regexp_replace(F.regexp_replace(name, r"-\d+x\d+(\.[^.]*)$", "$1"), r"-\d+(\.[^.]*)$", "$1")


def thumb(text: Column) -> Column:
    """The address of the first image; null if there is none."""
    found = F.regexp_extract(text, r"!\[[^\]]*\]\(([^)]+)\)", 1)
    return F.when(found != "", found)


def incipit(text: Column, most: int = 13) -> Column:
    """The first words of the first line that isn't blank and isn't an image."""
    first = F.get(F.filter(lines(text), lambda s: ~s.startswith("![")), F.lit(0))
    parts = F.split(F.regexp_replace(first, r"[ \t\r]+", " "), " ")
    return F.concat(F.array_join(F.slice(parts, 1, most), " "), F.when(F.size(parts) > most, F.lit(" …")).otherwise(""))


def local_digits(number: Column) -> Column:
    return F.translate(number.cast("string"), *DIGITS)


def latin_digits(text: Column) -> Column:
    return F.translate(text, DIGITS[1], DIGITS[0])
