"""Checks of an assembled book. Each gives rows (gate, key, severity, message), or pieces with flags added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions import text as X
from folioflow.functions.codepage import CODES
from folioflow.operators import checks, sequential
from folioflow.operators.classify import contents_count, is_verse
from folioflow.operators.containment import contained

VERSE = ("ghazals", "nazms")
GARBAGE, SINGLE, INDEX, TITLE_PAGE = "likely-decode-garbage", "single-line-piece", "first-line-index", "collection-title-page"
UNPUBLISHABLE = (GARBAGE, SINGLE, INDEX, TITLE_PAGE)
OPENING = 24
_KNOWN = sorted(CODES)
LONGER = 5


def _rows(found: DataFrame, gate: str, key: Column, message: Column, severity: str = "error") -> DataFrame:
    return found.select(F.lit(gate).alias("gate"), key.cast("string").alias("key"), F.lit(severity).alias("severity"), message.alias("message"))


def publishable() -> Column:
    return F.col("kind").isin(*VERSE) & ~F.arrays_overlap(F.col("flags"), F.array(*[F.lit(f) for f in UNPUBLISHABLE]))


def flagged(pieces: DataFrame, flag: str, where: Column) -> DataFrame:
    """pieces with the flag, once, where the condition holds."""
    return pieces.withColumn("flags", F.when(where, F.array_union("flags", F.array(F.lit(flag)))).otherwise(F.col("flags")))


def opening(body: Column) -> Column:
    """The letters of the first line."""
    return X.skeleton(F.substring_index(body, "\n", 1))


def flag_garbage(pieces: DataFrame, lexicon: DataFrame, key: list[str], known: float = 0.4, short: float = 0.6, least: int = 12) -> DataFrame:
    """pieces with flags and evidence: of at least so many words, too few are in the lexicon (word), or else too many
    have two letters at most. Words are counted by piece and joined once."""
    words = checks.word_counts(pieces, key, "body")
    found = words.join(lexicon.select("word").distinct().withColumn("__in", F.lit(1)), "word", "left")
    shares = found.groupBy(*key).agg(
        F.sum("k").alias("__n"), (F.sum(F.when(F.col("__in") == 1, F.col("k")).otherwise(0)) / F.sum("k")).alias("__known"), (F.sum(F.when(F.length("word") <= 2, F.col("k")).otherwise(0)) / F.sum("k")).alias("__short")
    )
    enough = F.col("__n") >= least
    unknown, broken = enough & (F.col("__known") < known), enough & (F.col("__short") > short)
    out = pieces.join(shares, key, "left").withColumn("evidence", F.when(unknown, "known words").when(broken, "short words"))
    return flagged(out, GARBAGE, F.col("evidence").isNotNull()).drop("__n", "__known", "__short")


def flag_single_lines(pieces: DataFrame) -> DataFrame:
    return flagged(pieces, SINGLE, F.col("kind").isin(*VERSE) & (F.size(X.stripped_lines(F.col("body"))) == 1))


def flag_indexes(pieces: DataFrame, part: list[str], key: list[str], share: float = 0.5) -> DataFrame:
    """pieces with flags: reviews of which more than this share of lines begin as a poem of the same book does."""
    heads = pieces.where(F.col("kind").isin(*VERSE)).select(*part, F.substring(opening(F.col("body")), 1, OPENING).alias("__head")).where(F.length("__head") == OPENING).distinct()
    lines = pieces.where("kind = 'reviews'").select(*key, F.explode(X.stripped_lines(F.col("body"))).alias("__line"))
    lines = lines.withColumn("__head", F.substring(X.skeleton(F.col("__line")), 1, OPENING)).join(heads.withColumn("__hit", F.lit(1)), [*part, "__head"], "left")
    shares = lines.groupBy(*key).agg((F.count("__hit") / F.count("*")).alias("__share"))
    return flagged(pieces.join(shares, key, "left"), INDEX, F.coalesce(F.col("__share") > share, F.lit(False))).drop("__share")


def sections_cleared(pieces: DataFrame, part: list[str], least: float = 0.9) -> DataFrame:
    """pieces with section emptied, on those of every kind, where one covers at least this share of a book's poems."""
    poems = pieces.where(F.col("kind").isin(*VERSE))
    total = poems.groupBy(*part).agg(F.count("*").alias("__all"))
    each = poems.where("section <> ''").groupBy(*part, "section").agg(F.count("*").alias("__n")).join(total, part)
    wide = each.where(F.col("__n") / F.col("__all") >= least).select(*part, "section", F.lit(True).alias("__wide"))
    return pieces.join(wide, [*part, "section"], "left").withColumn("section", F.when(F.col("__wide"), "").otherwise(F.col("section"))).drop("__wide")


def titled(pieces: DataFrame, printed: DataFrame, part: list[str]) -> tuple[DataFrame, DataFrame]:
    """(pieces, gate rows): essays without an author get the titles and authors that printed (part, pos, title, author)
    lists for their group, by position. Where their numbers differ, the group stays as it is and is reported."""
    plain = (F.col("kind") == "reviews") & (F.coalesce("reviewed_author", F.lit("")) == "") & ~F.arrays_overlap(F.col("flags"), F.array(*[F.lit(f) for f in UNPUBLISHABLE]))
    group = Window.partitionBy(*part)
    mine = pieces.where(plain).select(*part, "ord", F.row_number().over(group.orderBy("ord")).alias("__rn"), F.count("*").over(group).alias("__n"))
    theirs = printed.select(*part, F.col("title").alias("__title"), F.col("author").alias("__author"), F.row_number().over(group.orderBy("pos")).alias("__rn"), F.count("*").over(group).alias("__n"))
    named = mine.join(theirs, [*part, "__rn", "__n"]).select(*part, "ord", "__title", "__author")
    out = pieces.join(named, [*part, "ord"], "left")
    hit = F.col("__title").isNotNull()
    columns = {"title": F.when(hit, F.col("__title")).otherwise(F.col("title")), "reviewed_author": F.when(hit, F.col("__author")).otherwise(F.col("reviewed_author")), "flags": F.when(hit, F.array_remove("flags", "confirm-review-byline")).otherwise(F.col("flags"))}
    sizes = theirs.groupBy(*part).agg(F.count("*").alias("__listed")).join(mine.groupBy(*part).agg(F.count("*").alias("__staged")), part, "left")
    sizes = sizes.withColumn("__staged", F.coalesce("__staged", F.lit(0))).where("__listed <> __staged")
    return out.withColumns(columns).drop("__title", "__author"), _rows(sizes, "printed titles", F.concat_ws("/", *part), F.format_string("%d listed, %d staged", "__listed", "__staged"))


def printed_poems(collections: DataFrame) -> DataFrame:
    """collections with poems: the sum over sections of their ghazals and one for a hamd, or the number of pages listed
    where there are no sections. (sections array<struct<ghazals, hamd>>, poem_pages, devotional_pages arrays)."""
    sections = F.aggregate("sections", F.lit(0), lambda n, s: n + s["ghazals"] + F.when(s["hamd"], 1).otherwise(0))
    pages = F.greatest(F.size("poem_pages"), F.lit(0)) + F.greatest(F.size("devotional_pages"), F.lit(0))
    return collections.withColumn("poems", F.when(F.size("sections") > 0, sections).otherwise(pages))


def contents_counts(lines: DataFrame, pieces: DataFrame) -> DataFrame:
    """Books, not gatherings of collections, whose poems are not as many as the largest number of their contents."""
    declared = contents_count(lines, ["book_slug"], "idx")
    counted = (F.col("kind").isin(*VERSE)) & ~F.col("precedes_first_heading")
    actual = pieces.groupBy("book_slug").agg(F.count(F.when(counted, 1)).alias("actual"), F.max(F.col("collection") != "").alias("gathers"))
    found = declared.join(actual, "book_slug", "left").where("not coalesce(gathers, false)").withColumn("actual", F.coalesce("actual", F.lit(0)))
    differs = found.where("declared is null or declared <> cast(actual as string)")
    message = F.when(F.col("declared").isNull(), "no contents found").otherwise(F.format_string("%d poems, %s declared", "actual", "declared"))
    return _rows(differs, "contents count", F.col("book_slug"), message)


def declared_counts(pieces: DataFrame, declared: DataFrame) -> DataFrame:
    """Collections of declared (collection, expected) with more or fewer publishable poems; none count as 0."""
    actual = pieces.where(publishable()).groupBy("collection").agg(F.count("*").alias("actual"))
    found = declared.join(actual, "collection", "left").withColumn("actual", F.coalesce("actual", F.lit(0))).where("actual <> expected")
    return _rows(found, "declared count", F.col("collection"), F.format_string("%d poems, %d declared", "actual", "expected"))


def conservation(lines: DataFrame, pieces: DataFrame) -> DataFrame:
    """Verse that occurs in pieces less often than in its book, or more often than all lines of the book have it."""
    text = X.stripped(F.col("text")).alias("line")
    source = lines.select("book_slug", text, (F.col("kind") == "verse").cast("int").alias("v")).where("line <> ''").groupBy("book_slug", "line").agg(F.sum("v").alias("verse"), F.count("*").alias("all"))
    emitted = pieces.select("book_slug", F.explode(F.concat(X.stripped_lines(F.col("body")), X.stripped_lines(F.coalesce("dedication", F.lit(""))))).alias("line"))
    emitted = emitted.groupBy("book_slug", "line").agg(F.count("*").alias("emitted"))
    found = source.where("verse > 0").join(emitted, ["book_slug", "line"], "left").withColumn("emitted", F.coalesce("emitted", F.lit(0)))
    lost, doubled = F.col("emitted") < F.col("verse"), F.col("emitted") > F.col("all")
    message = F.when(lost, F.format_string("lost %d times: %s", F.col("verse") - F.col("emitted"), F.substring("line", 1, 40)))
    message = message.when(doubled, F.format_string("doubled %d times: %s", F.col("emitted") - F.col("all"), F.substring("line", 1, 40)))
    return _rows(found.where(lost | doubled), "conservation", F.col("book_slug"), message)


def front_floor(lines: DataFrame, pieces: DataFrame, floors: DataFrame) -> DataFrame:
    """Books of floors (book_slug, minimum) of whose verse before the body fewer lines are a poem's first."""
    front = lines.where((F.col("idx") < F.col("start")) & is_verse(X.stripped(F.col("text")))).select("book_slug", X.skeleton(X.stripped(F.col("text"))).alias("__k")).where("__k <> ''")
    first = pieces.where(F.col("kind").isin(*VERSE)).select("book_slug", opening(F.col("body")).alias("__k")).where("__k <> ''").distinct()
    matched = front.join(first, ["book_slug", "__k"], "left_semi").groupBy("book_slug").agg(F.count("*").alias("matched"))
    found = floors.join(matched, "book_slug", "left").withColumn("matched", F.coalesce("matched", F.lit(0))).where("matched < minimum")
    return _rows(found, "front matter", F.col("book_slug"), F.format_string("%d lines match, at least %d should", "matched", "minimum"))


def index_matches(lines: DataFrame, pieces: DataFrame) -> DataFrame:
    """(book_slug, collection, matched, total): poems whose first line is in the book's index, which is its lines before the
    body and its essays, each by its letters; a first line may go over the ends of lines there."""
    front = lines.where(F.col("idx") < F.col("start")).select("book_slug", F.lit(0).alias("__part"), F.col("idx").alias("__at"), F.lit(0).alias("__n"), X.skeleton(X.stripped(F.col("text"))).alias("__k"))
    essays = pieces.where("kind = 'reviews'").select("book_slug", F.lit(1).alias("__part"), F.col("ord").alias("__at"), F.posexplode(F.split("body", "\n")).alias("__n", "__line"))
    both = front.unionByName(essays.withColumn("__k", X.skeleton(F.col("__line"))).drop("__line")).where("__k <> ''")
    # An index is a part of one book, which the assembler holds in one task too.
    hay = both.groupBy("book_slug").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__part", "__at", "__n", "__k"))), lambda x: x["__k"]), " ").alias("__hay"))
    poems = pieces.where(F.col("kind").isin(*VERSE)).select("book_slug", "collection", F.coalesce(X.skeleton(F.get(X.stripped_lines(F.col("body")), F.lit(0))), F.lit("")).alias("__k"))
    found = poems.join(hay, "book_slug", "left").withColumn("__hit", (F.col("__k") != "") & F.coalesce(F.col("__hay").contains(F.col("__k")), F.lit(False)))
    return found.groupBy("book_slug", "collection").agg(F.count(F.when(F.col("__hit"), 1)).alias("matched"), F.count("*").alias("total"))


def index_floors(lines: DataFrame, pieces: DataFrame, floors: DataFrame) -> DataFrame:
    """Collections of floors (book_slug, collection, minimum) of which fewer poems are in the index."""
    found = floors.join(index_matches(lines, pieces), ["book_slug", "collection"], "left").fillna(0, ["matched", "total"]).where("matched < minimum")
    return _rows(found, "index", F.concat_ws("/", "book_slug", "collection"), F.format_string("%d of %d poems match, at least %d should", "matched", "total", "minimum"))


def ground_truth(texts: DataFrame, known: DataFrame, ident: str, text: str, key: str) -> DataFrame:
    """(key, matched, total, whole): of each text of known (key, body), how many of its lines are in some text, by letters."""
    lines = known.select(key, F.posexplode(F.split("body", "\n")).alias("__n", "__line")).withColumn("__k", X.skeleton(F.col("__line"))).where("__k <> ''")
    hits = contained(texts.select(ident, X.skeleton(F.col(text)).alias("__t")), lines.select(key, "__n", "__k"), "__t", "__k", [ident], [key, "__n"])
    found = lines.join(hits.select(key, "__n").distinct().withColumn("__hit", F.lit(1)), [key, "__n"], "left")
    return found.groupBy(key).agg(F.count("__hit").alias("matched"), F.count("*").alias("total"), (F.count("__hit") == F.count("*")).alias("whole"))


def holders(pieces: DataFrame, known: DataFrame) -> DataFrame:
    """Poems of known (slug, body) that not just one piece holds, that don't open their piece, or whose piece is longer by
    more than LONGER lines. A piece holds a poem if it has one of its lines, by letters."""
    poems = pieces.where(F.col("kind").isin(*VERSE)).withColumn("__id", F.struct("book_slug", "ord"))
    lines = known.select("slug", F.explode(F.split("body", "\n")).alias("__line")).withColumn("__k", X.skeleton(F.col("__line"))).where("__k <> ''").select("slug", "__k")
    hits = contained(poems.select("__id", X.skeleton(F.col("body")).alias("__t")), lines, "__t", "__k", ["__id"], ["slug"]).distinct()
    counts = known.select("slug").distinct().join(hits.groupBy("slug").agg(F.count("*").alias("n"), F.min("__id").alias("__id")), "slug", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    own = F.filter(F.transform(F.split("body", "\n"), lambda s: X.skeleton(s)), lambda s: s != "")
    one = counts.join(poems.select("__id", F.size(own).alias("__size"), F.coalesce(F.get(own, F.lit(0)), F.lit("")).alias("__first")), "__id", "left")
    theirs = lines.groupBy("slug").agg(F.collect_list("__k").alias("__lines"))
    found = one.join(theirs, "slug", "left")
    opens = F.exists("__lines", lambda s: F.startswith(F.col("__first"), s) | F.startswith(s, F.col("__first")))
    message = (
        F.when(F.col("n") != 1, F.format_string("held by %d pieces", "n")).when(~opens, F.lit("doesn't open its piece")).when(F.col("__size") > F.size("__lines") + LONGER, F.format_string("its piece has %d lines, it has %d", F.col("__size"), F.size("__lines")))
    )
    return _rows(found.withColumn("__m", message).where("__m is not null"), "holder", F.col("slug"), F.col("__m"))


def unmapped(paragraphs: DataFrame) -> DataFrame:
    """(book_slug, codes): codes that the code page doesn't have, ascending, as hexadecimal text. No row for a book of none."""
    odd = paragraphs.select("book_slug", F.explode(F.array_except("codes", F.array(*map(F.lit, CODES)))).alias("c")).where("c is not null")
    return odd.groupBy("book_slug").agg(F.array_join(F.transform(F.sort_array(F.collect_set("c")), lambda c: F.format_string("0x%02x", c)), ", ").alias("codes"))


def completeness(paragraphs: DataFrame) -> DataFrame:
    return _rows(unmapped(paragraphs), "completeness", F.col("book_slug"), F.concat(F.lit("unmapped codes: "), "codes"))


def roundtrip(paragraphs: DataFrame) -> DataFrame:
    """Paragraphs whose text, encoded again, isn't the codes that the code page has of them."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            odd = []
            for n, (raw, codes) in enumerate(zip(b.column("raw"), b.column("codes"))):
                if raw.is_valid and codes.is_valid and len(codes):
                    own = codes.values.fill_null(-1).to_numpy(zero_copy_only=False)
                    if sequential.encoded(raw.as_py()) != own[np.isin(own, _KNOWN)].astype(np.uint8).tobytes():
                        odd.append(n)
            yield b.select(["book_slug", "idx"]).take(pa.array(odd, pa.int64()))

    own = paragraphs.select("book_slug", "idx", "raw", "codes")
    found = own.mapInArrow(run, T.StructType(own.schema.fields[:2]))
    return _rows(found, "round trip", F.col("book_slug"), F.format_string("paragraph %d", F.col("idx") + 1))


def tally(pieces: DataFrame) -> DataFrame:
    """(kind, collection, n), a collection without a name as (none)."""
    return pieces.groupBy("kind", F.when(F.col("collection") == "", "(none)").otherwise(F.col("collection")).alias("collection")).agg(F.count("*").alias("n"))


APPROVAL = "## Approval"
_STAMP = r"(?m)^segmentation:\s*([0-9a-f]{16})\s*$"
_WORD = r"(?m)^approved:\s*(true|false)\s*$"


def _approval(report: Column) -> Column:
    """The report from its last approval heading on; null where it has none."""
    return F.when(report.contains(APPROVAL), F.substring_index(report, APPROVAL, -1))


def _last(text: Column, form: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(form), F.lit(1)), F.lit(-1))


def approved(report: Column, digest: Column) -> Column:
    """Whether the last approval in a report says true and names this digest. A null report is none."""
    last = _approval(report)
    return F.coalesce((_last(last, _WORD) == "true") & (_last(last, _STAMP) == digest), F.lit(False))


def restamped(report: Column, digest: Column) -> Column:
    """report with the last digest of its approval replaced and its last word on it set to false, all else as it was; null
    where one of them is missing."""
    last = _approval(report)
    head = F.substring(report, F.lit(1), F.length(report) - F.length(last))
    known = last.isNotNull() & last.rlike(_STAMP) & last.rlike(r"(?m)^approved:.*$")
    stamped = F.regexp_replace(last, F.lit(r"(?s)\A(.*\n|)segmentation:\s*[0-9a-f]{16}[ \t]*(?=\r?\n|\z)"), F.concat(F.lit("$1segmentation: "), digest))
    return F.when(known, F.concat(head, F.regexp_replace(stamped, r"(?s)\A(.*\n|)approved:[^\n]*", "$1approved: false")))


def report(pieces: DataFrame, found: DataFrame, digest: str) -> DataFrame:
    """(book_slug, report): the text that a person reads and approves, of pieces with a column digest and gate rows whose
    key begins with the book."""
    units = F.size(F.filter(F.split("body", "\n\n"), lambda s: X.stripped(s) != ""))
    measure = F.concat(units.cast("string"), F.when(F.col("kind").isin(*VERSE), " sher").otherwise(" para"))
    flags = F.when(F.size("flags") > 0, F.concat(F.lit("  ** "), F.array_join("flags", ", "))).otherwise("")
    section = F.when(F.col("section") != "", F.concat(F.lit("["), X.one_line(F.col("section")), F.lit("] "))).otherwise("")
    line = F.concat(F.lpad(F.col("ord").cast("string"), 4, " "), F.lit(". "), F.rpad("kind", 8, " "), F.lit(" "), section, F.substring(X.one_line(F.col("title")), 1, 50), F.lit("  ("), measure, F.lit(")"), flags)
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n")
    books = pieces.groupBy("book_slug", digest).agg(F.count("*").alias("n"), F.count(F.when(F.size("flags") > 0, 1)).alias("m"), lines.alias("lines"))
    told = found.select(F.split("key", "/")[0].alias("book_slug"), F.concat(F.lit("- "), "gate", F.lit(": "), X.one_line(F.col("message"))).alias("g"))
    told = told.groupBy("book_slug").agg(F.array_join(F.sort_array(F.collect_list("g")), "\n").alias("gates"))
    text = F.concat(
        F.format_string("# Review report - %s\n\n%d pieces detected, %d flagged.\n\n## Gate output\n\n", "book_slug", "n", "m"), F.coalesce("gates", F.lit("- all gates clean")),
        F.lit("\n\n## Pieces\n\n"), "lines", F.lit(f"\n\n{APPROVAL}\n\nsegmentation: "), digest, F.lit("\napproved: false\n"),
    )
    return books.join(told, "book_slug", "left").select("book_slug", text.alias("report"))


def book_records(pieces: DataFrame, slug_of) -> DataFrame:
    """(book_slug, collection, record): a record for each collection of a book's poems in their order, by its slug, with a
    number where slugs are equal; or one by the book's own slug where no poem has a collection. Collections whose slug
    is empty have none."""
    first = pieces.where(F.col("kind").isin(*VERSE)).groupBy("book_slug", "collection").agg(F.min("ord").alias("__ord"))
    named = F.max(F.col("collection") != "").over(Window.partitionBy("book_slug"))
    found = first.withColumn("__named", named).where("collection <> '' or not __named")
    base = F.when(F.col("collection") == "", F.col("book_slug")).otherwise(X.capped(slug_of(F.col("collection"))))
    found = found.withColumn("__base", base).where("__base <> ''")
    n = F.row_number().over(Window.partitionBy("book_slug", "__base").orderBy("__ord"))
    return found.select("book_slug", "collection", F.when(n == 1, F.col("__base")).otherwise(F.concat("__base", F.lit("-"), n.cast("string"))).alias("record"))


def publish_status(staged: DataFrame, archive: DataFrame, kinds: tuple[str, ...] = ("ghazals", "nazms", "reviews"), key: tuple[str, str] = ("kind", "slug")) -> DataFrame:
    """staged (kind, slug, body, flags, approved) with status, the first that holds: unapproved; flagged; unknown kind;
    missing source, where body is null; new; skipped or differs, where archive (kind, slug, body) has the key with the
    same letters or others. Only new ones are ever written."""
    old = archive.select(*[F.col(k) for k in key], X.skeleton(F.col("body")).alias("__old"), F.lit(True).alias("__there")).dropDuplicates(list(key))
    found = staged.join(old, list(key), "left")
    refused = F.arrays_overlap(F.col("flags"), F.array(*[F.lit(f) for f in UNPUBLISHABLE]))
    status = (
        F.when(~F.coalesce(F.col("approved"), F.lit(False)), "unapproved").when(F.coalesce(refused, F.lit(False)), "flagged").when(~F.col("kind").isin(*kinds), "unknown kind")
        .when(F.col("body").isNull(), "missing source").when(F.col("__there").isNull(), "new").when(F.col("__old").eqNullSafe(X.skeleton(F.col("body"))), "skipped").otherwise("differs")
    )
    return found.withColumn("status", status).drop("__old", "__there")


def strays(files: DataFrame, records: DataFrame) -> DataFrame:
    """files (name) that no record accounts for."""
    return checks.unresolved(files, records.select(F.concat("record", F.lit(".yaml")).alias("__name")), F.col("name") == F.col("__name"))
