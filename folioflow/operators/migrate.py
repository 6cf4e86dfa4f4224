"""Posts of an export to pieces: categories, block markup to lines, embeds, duplicates and the checks before writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.functions.urdu import slugified

VERSE = ("ghazals", "nazms")
PRIORITY = ("videos", "memoir", "ghazals", "nazms", "reviews")
MEDIA = "/media/images/"
_PART = "\x1e"
_COMMENT = r"(?s)<!--.*?-->"
_EMBED = r"(?s)<!-- wp:(?:core-embed/[\w-]+|embed|html).*?-->.*?<!-- /wp:(?:core-embed/[\w-]+|embed|html) -->"
_NODE = r'(?is)<p[^>]*>.*?</p>|<img[^>]*\bsrc="[^"]+"[^>]*>'
_SOURCE_IMAGE = r'(?i)<img[^>]*\bsrc="[^"]+"'
_IMAGE = r"!\[[^\]]*\]\([^)]*\)"
_RULE = rf"\A[-–—_=۔{X.SPACE}]{{3,}}\z"


def category_split(
    categories: Column, kinds: dict[str, str], language_of: dict[str, str], scripts: dict[str, str], noise: tuple[str, ...] = (), language: str = "urdu"
) -> dict[str, Column]:
    """kind, language, script and tags of a post's categories. kinds: category to kind; of several the first in PRIORITY,
    of none nazms. language_of: category to language, its default language. Tags are the other categories in order,
    repeated ones too, without noise. Null categories are none."""
    given = F.filter(F.coalesce(categories, F.array().cast("array<string>")), lambda c: ~c.isin(*noise) if noise else F.lit(True))
    kind = F.coalesce(*[F.when(F.arrays_overlap(given, F.array(*[F.lit(c) for c, k in kinds.items() if k == name])), name) for name in PRIORITY if name in kinds.values()], F.lit("nazms"))
    spoken = F.coalesce(*[F.when(F.array_contains(given, c), x) for c, x in language_of.items()], F.lit(language))
    script = F.create_map(*[F.lit(x) for pair in scripts.items() for x in pair])[spoken]
    return {"kind": kind, "language": spoken, "script": script, "tags": F.filter(given, lambda c: ~c.isin(*kinds, *language_of))}


def without_embeds(html: Column) -> Column:
    return F.regexp_replace(html, _EMBED, "")


def image_address(src: Column, root: str = MEDIA) -> Column:
    return F.concat(F.lit(root), X.image_path(src))


def markdown(html: Column, is_verse: Column, root: str = MEDIA) -> Column:
    """Paragraphs and images in their order, with blank lines between; verse of single-line paragraphs is one stanza.

    Entities of all paragraphs are read in one go, by a function of Python; the rest is built in.
    """
    nodes = F.regexp_extract_all(F.regexp_replace(html, _COMMENT, ""), F.lit(_NODE), F.lit(0))

    def plain(node: Column) -> Column:
        paragraph = F.regexp_replace(F.regexp_replace(node, r"(?is)\A<p[^>]*>(.*)</p>\z", "$1"), r"(?i)<br\s*/?>", "\n")
        image = F.concat(F.lit("![]("), image_address(F.regexp_extract(node, r'(?i)\bsrc="([^"]+)"', 1), root), F.lit(")"))
        return F.when(node.rlike(r"(?i)\A<img"), image).otherwise(F.regexp_replace(paragraph, r"<[^>]+>", ""))

    read = F.split(X.unescaped(F.array_join(F.transform(nodes, plain), _PART)), _PART)
    tidy = F.transform(read, lambda t: F.array_join(X.stripped_lines(F.replace(t, F.lit("ـ"), F.lit(""))), "\n"))
    tidy = F.filter(tidy, lambda t: t != "")
    one = is_verse & ~F.exists(tidy, lambda t: t.contains("\n"))
    return F.when(one, F.array_join(tidy, "\n")).otherwise(F.array_join(tidy, "\n\n"))


def _parts(body: Column) -> Column:
    return F.filter(F.split(body, "\n\n"), lambda p: X.stripped(p) != "")


def _kept(parts: Column, goes) -> Column:
    """How many parts stay when those at the end go for which goes holds."""
    return F.coalesce(F.array_max(F.transform(parts, lambda p, i: F.when(goes(p), 0).otherwise(i + 1))), F.lit(0))


def _after(parts: Column, kept: Column) -> Column:
    return F.transform(F.slice(parts, kept + 1, F.greatest(F.size(parts), F.lit(1))), X.stripped)


def byline_dropped(body: Column, author: str, label: str = "تحریر") -> Column:
    """(body, removed): body without the paragraphs at its end that name the author alone, and those."""
    form = rf"\A(?:{label}[{X.SPACE}]*[:؛]?[{X.SPACE}]*)?\Q{author}\E\z"
    parts = _parts(body)
    kept = _kept(parts, lambda p: X.stripped(p).rlike(form))
    return F.struct(F.array_join(F.slice(parts, 1, kept), "\n\n").alias("body"), _after(parts, kept).alias("removed"))


def notes_parted(body: Column, author: str) -> Column:
    """(body, notes, removed): verse without the single lines at its end; those, and of them those that are neither a
    rule nor the author's name."""
    parts = _parts(body)
    kept = _kept(parts, lambda p: ~p.contains("\n"))
    removed = _after(parts, kept)
    notes = F.filter(removed, lambda p: ~p.rlike(_RULE) & (p != author))
    return F.struct(F.array_join(F.slice(parts, 1, kept), "\n\n").alias("body"), notes.alias("notes"), removed.alias("removed"))


def published_in(html: Column, domains: dict[str, str]) -> Column:
    """The domains of the providers of its embeds, each once, in order."""
    found = F.regexp_extract_all(html, F.lit(r'"providerNameSlug":"([\w-]+)"'), F.lit(1))
    known = F.create_map(*[F.lit(x) for pair in domains.items() for x in pair])
    return F.array_distinct(F.filter(F.transform(found, lambda s: known[s]), lambda d: d.isNotNull()))


def video(html: Column) -> Column:
    """(source, video_id, url, description, recorded) of the first video of one site, else of the other; null if none."""
    tube = F.regexp_extract(html, r"(?:youtube\.com/watch\?v=|youtu\.be/)([\w-]{11})", 1)
    book = r"facebook\.com/([\w.-]+)/videos/(\d+)"
    who, number = F.regexp_extract(html, book, 1), F.regexp_extract(html, book, 2)
    quote = F.regexp_replace(F.regexp_extract(html, r"(?s)<blockquote[^>]*>(.*?)</blockquote>", 1), r"<[^>]+>", " ")
    caption = X.stripped(F.regexp_replace(X.unescaped(quote), rf"[{X.SPACE}]+", " "))
    caption = X.stripped(F.regexp_replace(caption, r"Posted by .*$", ""))
    day = r"(\d{2})-(\d{2})-(\d{4})"
    date = F.when(caption.rlike(day), F.concat_ws("-", *[F.regexp_extract(caption, day, k) for k in (3, 2, 1)])).otherwise("")

    def entry(source, ident, url, description, recorded) -> Column:
        values = (F.lit(source), ident, url, description, recorded)
        return F.struct(*[v.alias(k) for k, v in zip(("source", "video_id", "url", "description", "recorded"), values)])

    first = entry("youtube", tube, F.concat(F.lit("https://www.youtube.com/watch?v="), tube), F.lit(""), F.lit(""))
    second = entry("facebook", number, F.concat(F.lit("https://www.facebook.com/"), who, F.lit("/videos/"), number, F.lit("/")), caption, date)
    return F.when(tube != "", first).when(number != "", second)


def part_digits(title: Column) -> Column:
    """The first run of digits, of any script and length, without zeros before it; null where there is none."""
    found = F.regexp_extract(title, r"(?U)(\d+)", 1)
    return F.when(found != "", F.regexp_replace(X.latin_digits(found), "^0+(?=.)", ""))


def part_number(title: Column) -> Column:
    """The same as a number; null where there is none or it has more than 38 digits, which a check has to report."""
    return part_digits(title).try_cast("decimal(38,0)")


def reviewed(rows: DataFrame, overrides: DataFrame, title: str = "title") -> DataFrame:
    """rows with reviewed_book and reviewed_author: those that overrides (title, reviewed_book, reviewed_author) has for a
    title, else what a title of the form book/author says; null otherwise."""
    form = r"\A([^/]+)/([^/]+)\z"
    known = overrides.select(F.col(title).alias("__title"), F.col("reviewed_book").alias("__book"), F.col("reviewed_author").alias("__author"), F.lit(True).alias("__known"))
    found = rows.join(known, F.col(title) == F.col("__title"), "left")
    own = [F.when(F.col(title).rlike(form), X.stripped(F.regexp_extract(title, form, k))) for k in (1, 2)]
    named = {"reviewed_book": F.when(F.col("__known"), F.col("__book")).otherwise(own[0]), "reviewed_author": F.when(F.col("__known"), F.col("__author")).otherwise(own[1])}
    return found.withColumns(named).drop("__title", "__book", "__author", "__known")


def address(kind: Column, slug: Column) -> Column:
    """The page of a piece."""
    paths = {"ghazals": "/ghazal/", "nazms": "/nazm/", "reviews": "/tabsira/", "videos": "/video/", "memoir": "/dars-gah/"}
    path = F.create_map(*[F.lit(x) for pair in paths.items() for x in pair])[kind]
    return F.concat(path, F.when(kind == "memoir", F.regexp_replace(slug, r"\Adars-gah-", "")).otherwise(slug))


def pieces(
    posts: DataFrame,
    author: str,
    kinds: dict[str, str],
    language_of: dict[str, str],
    scripts: dict[str, str],
    noise: tuple[str, ...],
    domains: dict[str, str],
    overrides: DataFrame,
    dead_videos: DataFrame,
) -> DataFrame:
    """The posts (post_id, seq, title, body, categories, published) as pieces, before duplicates are merged: kind, slug,
    title, language, script, published, body, tags, removed and the fields of their kind. Dead videos go."""
    split = category_split(F.col("categories"), kinds, language_of, scripts, noise)
    rows = posts.withColumns(split).withColumn("title", X.stripped(F.replace("title", F.lit("ـ"), F.lit(""))))
    rows = rows.withColumn("video", F.when(F.col("kind") == "videos", video(F.col("body"))))
    rows = rows.join(dead_videos.select(F.col("video_id").alias("__dead")), F.col("video.video_id") == F.col("__dead"), "left_anti")
    text = F.when(F.col("kind") == "videos", "").otherwise(markdown(without_embeds(F.col("body")), F.col("kind").isin(*VERSE)))
    rows = rows.withColumns({"source_html": F.col("body"), "__text": text, "__slug": slugified(F.col("title"))})
    rows = rows.withColumns({"__verse": notes_parted(F.col("__text"), author), "__prose": byline_dropped(F.col("__text"), author)})
    is_verse, is_prose = F.col("kind") == "ghazals", F.col("kind").isin("reviews", "memoir")
    rows = reviewed(rows, overrides)
    none = F.lit(None).cast("string")
    part, digits = (F.when(F.col("kind") == "memoir", f(F.col("title"))) for f in (part_number, part_digits))
    other = F.concat(F.when(F.col("kind") == "videos", "video").otherwise(F.col("kind")), F.lit("-"), F.col("post_id").cast("string"))
    rows = rows.withColumns(
        {
            "body": F.when(is_verse, F.col("__verse.body")).when(is_prose, F.col("__prose.body")).otherwise(F.col("__text")),
            "removed": F.when(is_verse, F.col("__verse.removed")).when(is_prose, F.col("__prose.removed")).otherwise(F.array().cast("array<string>")),
            "written_note": F.when(is_verse & (F.size("__verse.notes") > 0), F.array_join("__verse.notes", " ")),
            "published_in": F.when(F.col("kind") != "videos", published_in(F.col("source_html"), domains)),
            "part": part,
            "slug": F.when(F.col("kind") == "memoir", F.concat(F.lit("dars-gah-"), digits)).otherwise(F.when(F.col("__slug") == "", other).otherwise(F.col("__slug"))),
            **{c: F.when(F.col("kind") == "reviews", F.col(c)).otherwise(none) for c in ("reviewed_book", "reviewed_author")},
            **{c: F.col(f"video.{c}") for c in ("source", "video_id", "url", "description", "recorded")},
        }
    )
    return rows.drop("__text", "__slug", "__verse", "__prose", "video", "categories")


def merged(rows: DataFrame, key: list[str], order: str, ident: str) -> DataFrame:
    """The first row of each key, with source_ids, the idents of all rows of the key in their order."""
    ids = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(ident).alias("i")))), lambda x: x["i"]).alias("source_ids")
    groups = rows.groupBy(*key).agg(ids, F.min(order).alias("__first"))
    groups = groups.select(*[F.col(k).alias(f"__{k}") for k in key], "source_ids", "__first")
    # The other columns come by a join: they aren't gathered for rows that go.
    same = F.col(order) == F.col("__first")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(groups, same).select(*rows.columns, "source_ids")


def redirects(survivors: DataFrame) -> DataFrame:
    """(post_id, url) of every post that a survivor stands for."""
    return survivors.select(F.explode("source_ids").alias("post_id"), address(F.col("kind"), F.col("slug")).alias("url"))


def looked_up(requests: DataFrame, known: DataFrame, ident: str, fallback: Column) -> DataFrame:
    """requests with status and location: 301 to the address that known (ident, url) has, else 200 and the fallback."""
    found = requests.join(known.select(F.col(ident).alias("__id"), F.col("url").alias("__url")), F.col(ident).cast("string") == F.col("__id").cast("string"), "left")
    hit = F.col("__url").isNotNull()
    return found.withColumns({"status": F.when(hit, 301).otherwise(200), "location": F.coalesce("__url", fallback)}).drop("__id", "__url")


def _gate(rows: DataFrame, name: str, key: Column, message: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("gate"), key.alias("key"), F.lit("error").alias("severity"), message.alias("message"))


def verse_parity(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """A gate row for each stanza of odd lines in a poem of several stanzas."""
    key = F.concat("kind", F.lit("/"), "slug") if key is None else key
    stanzas = rows.where(F.col("kind").isin(*VERSE)).withColumns({"__key": key, "__s": _parts(F.col("body"))}).where(F.size("__s") > 1)
    each = stanzas.select("__key", F.posexplode("__s").alias("__n", "__t")).withColumn("__k", F.size(X.stripped_lines(F.col("__t"))))
    return _gate(each.where(F.col("__k") % 2 == 1), "verse", F.col("__key"), F.format_string("sher %d has %d misra", F.col("__n") + 1, F.col("__k")))


def fidelity(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """A gate row for each piece whose text, with what was removed, isn't that of its source but for markup and space."""
    key = F.concat("kind", F.lit("/"), "slug") if key is None else key
    source, emitted = X.without_tags(without_embeds(F.col("source_html"))), X.without_tags(F.concat("body", F.array_join("removed", "")))
    found = rows.where("kind <> 'videos'").select(key.alias("__key"), source.alias("__a"), emitted.alias("__b")).where("__a <> __b")
    return _gate(found, "fidelity", F.col("__key"), F.format_string("source %d chars, emitted %d chars", F.length("__a"), F.length("__b")))


def media(rows: DataFrame, key: Column | None = None) -> DataFrame:
    """A gate row for each piece that has more or fewer images than its source."""
    key = F.concat("kind", F.lit("/"), "slug") if key is None else key
    n_source = F.regexp_count(without_embeds(F.col("source_html")), F.lit(_SOURCE_IMAGE))
    n_emitted = F.regexp_count(F.col("body"), F.lit(_IMAGE))
    found = rows.where("kind <> 'videos'").select(key.alias("__key"), n_source.alias("__a"), n_emitted.alias("__b")).where("__a <> __b")
    return _gate(found, "media", F.col("__key"), F.format_string("source has %d image(s), emitted %d", "__a", "__b"))


def missing_numbers(rows: DataFrame) -> DataFrame:
    """A gate row for each memoir without a part number, and each video post without a video."""
    what = F.when(F.col("slug").isNull(), "no part number").otherwise("part number of more than 38 digits")
    parts = _gate(rows.where("kind = 'memoir' and part is null"), "part", F.col("post_id").cast("string"), what)
    return parts.unionByName(_gate(rows.where("kind = 'videos' and video_id is null"), "video", F.col("post_id").cast("string"), F.lit("no video")))


def gates(rows: DataFrame) -> DataFrame:
    """(gate, key, severity, message): what is wrong with pieces. Any error forbids to write."""
    return verse_parity(rows).unionByName(fidelity(rows)).unionByName(media(rows)).unionByName(missing_numbers(rows))


def passed(found: DataFrame, most: int = 20) -> None:
    """Raises ValueError with the first errors if a gate found any."""
    errors = found.where("severity = 'error'").orderBy("gate", "key", "message").limit(most).collect()
    if errors:
        raise ValueError("nothing is written: " + "; ".join(f"{r.gate} {r.key}: {r.message}" for r in errors))
