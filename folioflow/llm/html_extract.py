"""HTML extraction by site template removal (operator 9).

Each page is parsed into a tree of elements, and each block-level subtree that has text is hashed: its name, its texts and
the hashes of its children, not its attributes. Spark counts on how many different pages of a host a hash occurs, and how
many pages the host has. Subtrees that occur on a large enough share of them, such as menus, banners and footers, are
deleted, and the text of the rest is what the page says. Pages are parsed once to hash and once to extract; only hashes
are counted and joined.

A site has menus of sections, each on a few of a hundred pages, and articles that quote a sentence as often: one share
can't tell them apart. So where text is written (articles, paragraphs, titles, lists, tables) the share is a large one,
and in menus, footers, asides, forms and plain containers a small one. The lowest bit of a hash tells which.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.shared import fresh, readable, without, written

#: Different pages of a host on which a subtree has to occur at least to be part of the template.
MIN_PAGES = 5
#: It has to occur on one in so many of the host's different pages besides: a container, and what text is written in.
ONE_IN = 100
ONE_IN_PROSE = 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)[^<>\"']*(?:\"[^\"<]*\"[^<>\"']*|'[^'<]*'[^<>\"']*)*>",
    re.S,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style noscript template textarea title head svg math object iframe select".split())
_RAW = {t: re.compile(rf"</{t}[\s>/]", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening tag ends if they are open, and those beyond which it doesn't look.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
_PARAGRAPH = ({"p"}, {"div", "article", "section", "main", "aside", "header", "footer", "nav", "body", "html", "li", "td", "th", "blockquote", "form", "table", "dd", "figure"})
#: What is inside of the first is prose, of the second isn't, nor of the third if in neither; elsewhere but the last are.
_CONTENT = frozenset({"article", "main"})
_FURNITURE = frozenset({"aside", "dialog", "form", "menu", "nav"})
_MARGIN = frozenset({"footer", "header"})
_CONTAINER = frozenset({"center", "div", "fieldset", "section"})
_SPACE = re.compile(r"\s+")


class _Element:
    __slots__ = ("hashes", "name", "start", "zone")

    def __init__(self, name: str, start: int, zone: frozenset[str] | None = None) -> None:
        self.name = name
        #: Where in the page's parts of text its own begin.
        self.start = start
        #: What it is inside of: _CONTENT, _FURNITURE or None.
        self.zone = _CONTENT if name in _CONTENT else _FURNITURE if name in _FURNITURE or name in _MARGIN and zone is None else zone
        self.hashes: list[str] = []


def parse(page: str, drop: frozenset[int] = frozenset()) -> tuple[str, set[int]]:
    """(text, hashes): the text of page without the subtrees in drop, and the hashes of its block subtrees with text.

    Blocks are lines; white space is one space. Elements left open end with what holds them; closing tags of what isn't
    open are ignored. Scripts, styles, heads and other hidden elements have no text. Takes time in proportion to the page,
    however deep its elements are.
    """
    stack, parts, seen, hidden, at = [_Element("", 0)], [], set(), 0, 0
    #: Where in the stack the open elements of each name are.
    depths: dict[str, list[int]] = {}

    def close() -> None:
        nonlocal hidden
        e = stack.pop()
        depths[e.name].pop()
        if e.name in _HIDDEN:
            hidden -= 1
            del parts[e.start :]
            return
        block = e.name in _BLOCK
        if e.hashes:
            h = xxhash.xxh3_64_intdigest((e.name + "\0" + "\1".join(e.hashes)).encode("utf-8", "surrogatepass")) - (1 << 63)
            # The parent's hash has it without the bit: equal subtrees have equal hashes wherever they are.
            own = h & ~1 | (e.zone is _CONTENT or e.zone is None and e.name not in _CONTAINER)
            if block:
                seen.add(own)
            stack[-1].hashes.append(f"\2{h}")
        if not e.hashes or block and own in drop:
            del parts[e.start :]
        if block:
            parts.append("\n")

    def text(s: str) -> None:
        if s and not hidden:
            s = _SPACE.sub(" ", entities.unescape(s) if "&" in s else s)
            parts.append(s)
            if s != " ":
                stack[-1].hashes.append(s.strip())

    def innermost(names: frozenset[str] | set[str]) -> int:
        return max((d[-1] for n in names if (d := depths.get(n))), default=0)

    def close_down_to(depth: int) -> None:
        while len(stack) > depth:
            close()

    while True:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if found := depths.get(name):
                close_down_to(found[-1])
            continue
        if name == "br" or name == "hr":
            parts.append("\n")
        if name in _VOID:
            continue
        ends, within = _ENDS.get(name) or (_PARAGRAPH if name in _BLOCK else (None, None))
        if name == "body":
            ends, within = {"head"}, {"html"}
        if ends:
            # All that this tag ends, from the innermost on, up to what it doesn't look beyond.
            limit = innermost(within - ends)
            beyond = [d[bisect(d, limit)] for n in ends if (d := depths.get(n)) and d[-1] > limit]
            if beyond:
                close_down_to(min(beyond))
        if name in _RAW:
            end = _RAW[name].search(page, at)
            if name not in _HIDDEN:
                text(page[at : end.start() if end else len(page)])
            at = (page.find(">", end.start()) + 1 or len(page)) if end else len(page)
            continue
        hidden += name in _HIDDEN
        depths.setdefault(name, []).append(len(stack))
        stack.append(_Element(name, len(parts), stack[-1].zone))
        if name in _BLOCK and not hidden:
            parts.append("\n")
    close_down_to(1)
    lines = (_SPACE.sub(" ", x).strip() for x in "".join(parts).split("\n"))
    return "\n".join(x for x in lines if x), seen


def _of(host: str) -> int:
    """The host's hash, whose lowest bit is 0: mixed with it, a subtree's hash keeps its own."""
    return xxhash.xxh3_64_intdigest(host) - (1 << 63) & ~1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of each page, mixed with its host's: those of two hosts are different."""
    for batch in batches:
        sites = [_of(host) for host in batch.column(0).to_pylist()]
        rows = [[h ^ of for h in sorted(parse(t)[1])] for t, of in zip(batch.column(2).to_pylist(), sites)]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sites, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["page", "site", "hashes"])


def templates(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES, one_in: int = ONE_IN, one_in_prose: int = ONE_IN_PROSE) -> DataFrame:
    """(page, drop): for each different page of a host, by the hash of both, which subtrees belong to the template. The
    hashes in drop are mixed with the host's."""
    keyed = pages.select(_host(url).alias("host"), _page(url, html).alias("page"), readable(F.col(f"`{html}`")).alias("html"))
    hashed = keyed.where("host is not null and html is not null").mapInArrow(_hashed, "page bigint, site bigint, hashes array<bigint>")
    different = written(hashed.dropDuplicates(["page"]), "subtrees")
    sizes = different.groupBy("site").agg(F.count("*").alias("pages"))
    flat = different.select("page", "site", F.explode("hashes").alias("h"))
    counted = flat.groupBy("h").agg(F.count("*").alias("n"), F.min("site").alias("site")).where(F.col("n") >= min_pages)
    one_in = F.when(F.col("h").bitwiseAND(F.lit(1)) == 1, one_in_prose).otherwise(one_in)
    often = counted.join(sizes, "site").where(F.col("n") * one_in >= F.col("pages")).select("h")
    return flat.select("page", "h").join(often, "h", "left_semi").groupBy("page").agg(F.sort_array(F.collect_list("h")).alias("drop"))


def _page(url: str, html: str):
    return F.xxhash64(_host(url), readable(F.col(f"`{html}`")))


def _host(url: str):
    found = F.lower(F.regexp_extract(readable(F.col(f"`{url}`")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


@F.pandas_udf(T.BinaryType())
def _squeezed(pages):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pages.map(lambda t: None if t is None else squeeze(t.encode()))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        n = batch.num_columns
        out = []
        for host, page, drop in zip(*(batch.column(n - k).to_pylist() for k in (3, 2, 1))):
            own = frozenset(h ^ _of(host) for h in drop) if drop and host else frozenset()
            out.append(None if page is None else parse(expand(page).decode(), own)[0])
        columns = [batch.column(i) for i in range(n - 2)] + [pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[: n - 2], "text"])


def extract(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """The rows of pages less html, with host and text: what each page says without its host's template.

    A null html gives a null text, an empty one an empty text. Bytes that are no UTF-8 are read as replacement characters. Where url is null or has no host, host is null and nothing
    counts as template. Repeated rows, and equal pages of one host, count as one page and get equal texts. Pages of any
    length are parsed whole. Columns named host or text, in any case of letters, are replaced. An empty table gives an
    empty table.
    """
    kept = [c for c in pages.columns if c not in (url, html)]
    rows = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c in (url, html) or c.lower() not in ("host", "text")])
    kept = [c for c in without(pages, "host", "text").columns if c in kept]
    host, page, drop = fresh(rows, "__host", "__page", "__drop")
    # The pages move once, to meet what is dropped from them, and compressed well.
    keyed = rows.withColumns({host: _host(url), page: _page(url, html)}).withColumn(html, _squeezed(readable(F.col(f"`{html}`"))))
    known = templates(pages, url, html, min_pages).toDF(page, drop)
    joined = keyed.join(known, page, "left")
    columns = [F.col(f"`{c}`") for c in kept] + ([F.col(f"`{url}`")] if url.lower() not in ("host", "text") else [])
    final = joined.select(*columns, F.col(host).alias("host"), F.col(f"`{html}`").alias("__html"), F.col(drop).alias("__drop_list"))
    schema = T.StructType([*final.schema.fields[:-2], T.StructField("text", T.StringType())])
    return final.mapInArrow(_extracted, schema)
