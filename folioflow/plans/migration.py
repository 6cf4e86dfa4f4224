"""Queries of the migration: posts to pieces, their checks, files and redirects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.functions.urdu import slugified
from folioflow.operators import checks, migrate
from folioflow.plans.catalogue import _LINES, _READ, _TIDY, _query, _t
from folioflow.sources import sinks

#: Languages in addresses stand for categories.
_KINDS = {"fr": "videos", "de": "memoir", "en": "ghazals", "es": "reviews"}
_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.regexp_extract("url", r"://[^/]+/([a-z]{2})/", 1)
    host = F.regexp_extract("url", r"://([^./]+)\.", 1)
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return _t(spark, sf_dir, "pages").select(
        F.col("page_id").alias("post_id"), F.col("page_id").alias("seq"), title.alias("title"), F.col("html").alias("body"), F.array(lang, F.lit("Misc"), host).alias("categories"), F.lit("2024-01-01").alias("published")
    )


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = spark.createDataFrame([], "title string, reviewed_book string, reviewed_author string")
    dead = spark.createDataFrame([], "video_id string")
    return migrate.pieces(_posts(spark, sf_dir), "A. Author", _KINDS, {"de": "punjabi"}, {"urdu": "nastaliq", "punjabi": "shahmukhi"}, ("Misc",), {"site": "site.example"}, overrides, dead)


@_query("""
    with c as (select page_id, regexp_extract(url, '://[^/]+/([a-z]{2})/', 1) as lang, regexp_extract(url, '://([^./]+)\\.', 1) as host from pages)
    select page_id, case lang when 'fr' then 'videos' when 'de' then 'memoir' when 'en' then 'ghazals' when 'es' then 'reviews' else 'nazms' end as kind, case when lang = 'de' then 'punjabi' else 'urdu' end as language,
           case when lang = 'de' then 'shahmukhi' else 'nastaliq' end as script, array_to_string(list_filter([lang, host], lambda x: x not in ('fr', 'de', 'en', 'es')), '|') as tags from c
""")
def category_split(spark, sf_dir):
    rows = _posts(spark, sf_dir)
    split = migrate.category_split(F.col("categories"), _KINDS, {"de": "punjabi"}, {"urdu": "nastaliq", "punjabi": "shahmukhi"}, ("Misc",))
    found = rows.withColumns(split)
    return found.select(F.col("post_id").alias("page_id"), "kind", "language", "script", F.array_join("tags", "|").alias("tags"))


_NODES = "regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<p[^>]*>.*?</p>|<img[^>]*\\bsrc=\"[^\"]+\"[^>]*>')"
_PLAIN = _READ.format("regexp_replace(regexp_replace(regexp_replace(x, '(?is)^<p[^>]*>(.*)</p>$', '\\1'), '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g')")
_MARKDOWN = f"list_filter(list_transform({_NODES}, lambda x: array_to_string({_TIDY.format(_PLAIN)}, chr(10))), lambda t: t <> '')"


@_query(f"select page_id, array_to_string({_MARKDOWN}, chr(10) || chr(10)) as body from pages")
def page_markdown(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", migrate.markdown(migrate.without_embeds(F.col("html")), F.lit(False)).alias("body"))


@_query(f"""
    with m as (select page_id, {_MARKDOWN} as ps from pages),
    k as (select *, coalesce(list_max(list_transform(ps, lambda p, i: case when contains(p, chr(10)) then i else 0 end)), 0) as kept from m)
    select page_id, array_to_string(ps[1:kept], chr(10) || chr(10)) as verse, array_to_string(list_filter(ps[kept + 1:], lambda p: p <> 'A. Author' and not regexp_full_match(p, '[-–—_=۔\\s]{{3,}}')), '|') as notes from k
""")
def notes_parted(spark, sf_dir):
    """Paragraphs of one line at the end of a page, as the notes below a poem."""
    rows = _t(spark, sf_dir, "pages").select("page_id", migrate.markdown(F.col("html"), F.lit(False)).alias("body"))
    found = rows.withColumn("n", migrate.notes_parted(F.col("body"), "A. Author"))
    return found.select("page_id", F.col("n.body").alias("verse"), F.array_join("n.notes", "|").alias("notes"))


@_query(f"""
    select page_id, case when length(s) <= 80 then s when regexp_extract(left(s, 80), '^(.+)-[^-]*$', 1) = '' then trim(left(s, 80), '-') else trim(regexp_extract(left(s, 80), '^(.+)-[^-]*$', 1), '-') end as slug
    from (select page_id, trim(regexp_replace(lower(regexp_replace({_TITLE}, '[^A-Za-z0-9\\s]', ' ', 'g')), '\\s+', '-', 'g'), '-') as s from pages)
""")
def title_slugs(spark, sf_dir):
    """Slugs of page titles, cut at a hyphen; titles in Urdu are written in Latin letters."""
    return _posts(spark, sf_dir).select(F.col("post_id").alias("page_id"), X.capped(slugified(F.col("title"))).alias("slug"))


@_query("""
    select page_id, t as title, case when h then 'known' when regexp_full_match(t, '[^/]+/[^/]+') then regexp_extract(t, '^([^/]+)/', 1) end as reviewed_book,
           case when h then null when regexp_full_match(t, '[^/]+/[^/]+') then regexp_extract(t, '/([^/]+)$', 1) end as reviewed_author, cast(nullif(regexp_extract(t, '([0-9]+)', 1), '') as int) as part
    from (select page_id, regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '[?#].*$', '') as t, regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '[?#].*$', '') in (select lang || '/1' from documents) as h from pages)
""")
def title_fields(spark, sf_dir):
    """Paths of addresses as titles of reviews, book and author, some of them known otherwise, and as those of parts."""
    title = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]+/", ""), "[?#].*$", "")
    rows = _t(spark, sf_dir, "pages").select("page_id", title.alias("title"))
    known = _t(spark, sf_dir, "documents").select(F.concat("lang", F.lit("/1")).alias("title")).distinct()
    overrides = known.select("title", F.lit("known").alias("reviewed_book"), F.lit(None).cast("string").alias("reviewed_author"))
    return migrate.reviewed(rows, overrides).withColumn("part", migrate.part_number(F.col("title")).cast("int"))


@_query()
def migrated_pieces(spark, sf_dir):
    found = _pieces(spark, sf_dir)
    return found.select("post_id", "kind", "slug", "title", "language", "script", "body", "written_note", "part", "reviewed_book", "video_id")


@_query()
def migration_gates(spark, sf_dir):
    return migrate.gates(_pieces(spark, sf_dir))


@_query("""
    select min(doc_id) as doc_id, lang, string_agg(doc_id, ',' order by doc_id) as source_ids from documents group by lang, text
""")
def merged_duplicates(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", F.md5("text").alias("body"))
    found = migrate.merged(docs, ["lang", "body"], "doc_id", "doc_id")
    return found.select("doc_id", "lang", F.array_join(F.transform("source_ids", lambda x: x.cast("string")), ",").alias("source_ids"))


@_query("""
    with r as (select doc_id, '/' || lang || '/' || min(doc_id) over (partition by lang, text) as url, min(doc_id) over (partition by lang, text) as winner from documents)
    select event_id, case when r.doc_id is null then 200 else 301 end as status, coalesce(r.url, '/') as location from events left join r on r.doc_id = events.user_id and r.doc_id <> winner
""")
def redirect_lookup(spark, sf_dir):
    """Events as requests for a document by their user's number."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", F.md5("text").alias("body"))
    known = checks.keep_first(docs, ["lang", "body"], ["doc_id"], "doc_id").where("doc_id <> winner")
    known = known.select("doc_id", F.concat(F.lit("/"), "lang", F.lit("/"), F.col("winner").cast("string")).alias("url"))
    asked = _t(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("doc_id"))
    return migrate.looked_up(asked, known, "doc_id", F.lit("/")).select("event_id", "status", "location")


@_query(f"""
    select 'text/d' || doc_id || '.md' as path, '---' || chr(10) || 'title: ' || to_json(coalesce(({_LINES})[1], '')) || chr(10) || 'slug: "d' || doc_id || '"' || chr(10) || 'language: ' || to_json(lang) || chr(10)
           || 'script: "latin"' || chr(10) || 'tags: [' || to_json(source) || ']' || chr(10) || 'part: ' || n_chars || chr(10) || '---' || chr(10) || chr(10) || trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) || chr(10) as content from documents
""")
def markdown_files(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(
        F.lit("text").alias("kind"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("slug"), F.coalesce(F.get(X.lines(F.col("text")), F.lit(0)), F.lit("")).alias("title"), F.col("lang").alias("language"),
        F.lit("latin").alias("script"), F.array("source").alias("tags"), F.col("n_chars").alias("part"), F.col("text").alias("body"),
    )
    return sinks.markdown(rows)


@_query("""
    select 'containers/nations.yaml' as path, 'title: "Nations"' || chr(10) || 'slug: "nations"' || chr(10) || 'description: "All"' || chr(10) || 'contents:' || chr(10)
           || string_agg('  - "' || lower(n_name) || '"', chr(10) order by n_nationkey) || chr(10) as content from nation
""")
def container_file(spark, sf_dir):
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("part"), F.lower("n_name").alias("slug"))
    return sinks.container(rows, "Nations", "nations", "All")


@_query("""
    select 'postmap.json' as path, '{' || chr(10) || string_agg('  "' || n_nationkey || '": "/' || n_name || '"', ',' || chr(10) order by n_nationkey) || chr(10) || '}' as content from nation
""")
def redirect_file(spark, sf_dir):
    return sinks.redirect_map(_t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("post_id"), F.concat(F.lit("/"), "n_name").alias("url")))
