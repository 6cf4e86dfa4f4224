"""Queries of books: decoding, assembling, their checks, approval, publishing and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import assemble, checks, classify, gates, ordered, sequential
from folioflow.plans import catalogue
from folioflow.plans.catalogue import _LEXICON, _LINES, _WORDS, _query, _t
from folioflow.sources import sinks


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a file of the older format: a code for each character, a paragraph for each line."""

    def coded(line):
        import numpy as np

        letters = np.frombuffer(line.encode("utf-32-le"), "<u4")
        out = np.full((len(letters), 2), 4, np.uint8)
        out[:, 1] = np.where(letters == 32, 32, 129 + letters % 120)
        return out.tobytes()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                content = [None if t is None else b"\r\1\0\0\0".join(map(coded, t.decode("utf-8", "replace").split("\n"))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(content, pa.binary())], names=["book_slug", "content"])

    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("book_slug"), F.col("text").cast("binary").alias("text"))
    return docs.mapInArrow(run, "book_slug string, content binary")


@_query()
def decode_stream(spark, sf_dir):
    """Texts of coded files, digits turned round and composed."""
    return sequential.decode(_streams(spark, sf_dir)).select("book_slug", "idx", "text", "geometry", F.size("codes").alias("n_codes"))


@_query()
def decode_gates(spark, sf_dir):
    """Codes that the code page doesn't have, and paragraphs that don't come back as they were coded."""
    found = sequential.decode(_streams(spark, sf_dir))
    return gates.completeness(found).unionByName(gates.roundtrip(found))


@_query()
def excluded_codes(spark, sf_dir):
    return sequential.excluded(_streams(spark, sf_dir))


def _assembled(spark, sf_dir):
    lines = classify.with_sections(catalogue._classified(spark, sf_dir), ["doc_id"], "idx", catalogue._HEADINGS)
    return lines.withColumn("book_slug", F.col("doc_id").cast("string"))


@_query()
def assemble_pieces(spark, sf_dir):
    """The pieces of each document as a book."""
    found = assemble.pieces(assemble.assembled(_assembled(spark, sf_dir)))
    return found.select("book_slug", "ord", "kind", "title", "body", "written_note", "dedication", "reviewed_author", "flags", "collection", "section", "attributed", "precedes_first_heading")


@_query()
def unreached_lines(spark, sf_dir):
    found = assemble.assembled(_assembled(spark, sf_dir)).where("what <> 'piece'")
    return found.groupBy("what", "kind").agg(F.count("*").alias("n"))


@_query()
def assembly_gates(spark, sf_dir):
    """Verse lost or doubled, and books whose poems aren't as many as their contents say."""
    lines = _assembled(spark, sf_dir)
    pieces = assemble.pieces(assemble.assembled(lines))
    return gates.conservation(lines, pieces).unionByName(gates.contents_counts(lines, pieces))


@_query("""
    with h as (select *, min(case when role = 'assistant' then turn end) over p as first_header, min(case when role = 'user' then turn end) over p as first_heading,
               sum(case when role = 'system' then 1 else 0 end) over (partition by conv_id order by turn) as section_run from conversations window p as (partition by conv_id)),
    c as (select *, case when turn < first_header then '' when role = 'assistant' then 'a' else 'b' end as own, case when section_run > 0 then 's' || section_run else '' end as sec from h),
    q as (select *, own = '' and first_header is not null and turn < first_header as attributed from c),
    r as (select *, case when attributed then 'first' else own end as collection from q)
    select conv_id, turn, attributed, collection, coalesce(turn < first_heading, false) as precedes_first_heading,
           case when first_value(collection) over (partition by conv_id, section_run order by turn) <> collection then '' else sec end as section from r
""")
def attribution_windows(spark, sf_dir):
    """Turns as pieces: those before the first header get its name, and a section is kept within one collection."""
    whole, so_far = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("turn")
    rows = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("conv_id").alias("book_slug"), F.col("turn").alias("ord"), F.col("turn").alias("at"), F.col("turn").alias("last"))
    rows = rows.withColumns(
        {
            "first_header": F.min(F.when(F.col("role") == "assistant", F.col("turn"))).over(whole),
            "first_heading": F.min(F.when(F.col("role") == "user", F.col("turn"))).over(whole),
            "section_run": F.sum(F.when(F.col("role") == "system", 1).otherwise(0)).over(so_far),
            "flags": F.array().cast("array<string>"),
            "header_name": F.lit("first"),
        }
    )
    rows = rows.withColumns(
        {
            "collection": F.when(F.col("turn") < F.col("first_header"), "").when(F.col("role") == "assistant", "a").otherwise("b"),
            "section": F.when(F.col("section_run") > 0, F.concat(F.lit("s"), F.col("section_run").cast("string"))).otherwise(""),
        }
    )
    found = assemble.sections_kept(assemble.positioned(rows))
    return found.select("conv_id", "turn", "attributed", "collection", "precedes_first_heading", "section")


@_query("""
    with o as (select c_nationkey, 2 * c_custkey as place, c_custkey % 64 as code, 2 * c_custkey - 2 * row_number() over (partition by c_nationkey order by c_custkey) as run from customer)
    select c_nationkey, place, code from (select *, count(*) over (partition by c_nationkey, run) as size from o) where size >= 2 and code >= 32
""")
def isolated_runs(spark, sf_dir):
    """Customers as codes: those whose key has a neighbour in the same nation, without control codes."""
    rows = _t(spark, sf_dir, "customer").select("c_nationkey", (2 * F.col("c_custkey")).alias("place"), (F.col("c_custkey") % 64).alias("code"))
    return ordered.isolated_dropped(rows, ["c_nationkey"], "place", "code")


@_query("""
    with l as (select c_custkey, unnest(range(length(c_name))) as idx, unnest(string_split(c_name, '')) as letter from customer),
    d as (select *, regexp_matches(letter, '[0-9]') as digit from l),
    n as (select *, case when digit is not distinct from lag(digit) over (partition by c_custkey order by idx) then 0 else 1 end as new from d),
    r as (select *, sum(new) over (partition by c_custkey order by idx) as run from n)
    select c_custkey, letter, cast(case when digit then min(idx) over (partition by c_custkey, run) + max(idx) over (partition by c_custkey, run) - idx else idx end as int) as idx from r
""")
def digit_runs(spark, sf_dir):
    letters = F.filter(F.split("c_name", ""), lambda c: c != "")
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.posexplode(letters).alias("idx", "letter"))
    return ordered.digits_reversed(rows, ["c_custkey"])


@_query("""
    with g as (select *, sum(case when role = 'system' then 1 else 0 end) over (partition by conv_id order by turn) as stanza from conversations)
    select conv_id, turn, cast(case when role = 'system' then 0 when row_number() over (partition by conv_id, stanza, role = 'system' order by turn) % 2 = 1 then 63 else 1 end as int) as geometry from g
""")
def stanza_geometry(spark, sf_dir):
    """Turns as lines, of which those of the system begin a stanza."""
    rows = ordered.islands(_t(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], F.col("role") == "system", "stanza")
    place = F.row_number().over(Window.partitionBy("conv_id", "stanza", F.col("role") == "system").orderBy("turn"))
    return rows.select("conv_id", "turn", F.when(F.col("role") == "system", 0).when(place % 2 == 1, 63).otherwise(1).alias("geometry"))


@_query(f"""
    with {catalogue._PAIRED}
    select conv_id, count(distinct pair) as n_pairs, count(*) as n_lines,
           count(*) >= 2 and count(distinct pair) filter (not half) / count(distinct pair) >= 0.9 as in_couplets from h group by conv_id
""")
def couplet_share(spark, sf_dir):
    pairs = catalogue._paired(spark, sf_dir).groupBy("conv_id", "pair").agg(F.count("*").alias("k"), F.first("half").alias("half"))
    found = pairs.groupBy("conv_id").agg(F.count("*").alias("n_pairs"), F.sum("k").alias("n_lines"), F.count(F.when(~F.col("half"), 1)).alias("whole"))
    return found.select("conv_id", "n_pairs", "n_lines", ((F.col("n_lines") >= 2) & (F.col("whole") / F.col("n_pairs") >= assemble.COUPLETS)).alias("in_couplets"))


def _as_pieces(spark, sf_dir):
    """Documents as pieces: English ones are essays, others poems; a source is a book, a language a section."""
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("book_slug"), F.when(F.col("lang") == "en", "reviews").otherwise("ghazals").alias("kind"), F.col("text").alias("body"), F.col("lang").alias("section"), F.array().cast("array<string>").alias("flags"))


@_query(f"""
    with w as (select doc_id, unnest({_WORDS}) as word from documents), l as ({_LEXICON}),
    a as (select doc_id, count(*) as n, avg(case when l.word is null then 0.0 else 1.0 end) as known, avg(case when length(w.word) <= 2 then 1.0 else 0.0 end) as short from w left join l using (word) group by doc_id)
    select d.doc_id, case when n >= 12 and known < 0.4 then 'known words' when n >= 12 and short > 0.6 then 'short words' end as evidence from documents d left join a using (doc_id)
""")
def garbage_flags(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    found = gates.flag_garbage(_as_pieces(spark, sf_dir), catalogue._lexicon(docs, _t(spark, sf_dir, "labels")), ["doc_id"])
    return found.select("doc_id", "evidence")


_SKELETON = "trim(regexp_replace(regexp_replace({}, '[^\\p{{L}} \\t\\r\\n]', '', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"


@_query(f"""
    with h as (select distinct source, left(k, 24) as head from (select source, {_SKELETON.format("string_split(text, chr(10))[1]")} as k from documents where lang <> 'en') where length(k) >= 24),
    l as (select doc_id, source, left({_SKELETON.format("line")}, 24) as head from (select doc_id, source, unnest({_LINES}) as line from documents where lang = 'en')),
    s as (select doc_id, count(h.head) / count(*) > 0.5 as hit from l left join h on l.source = h.source and l.head = h.head group by doc_id)
    select d.doc_id, coalesce(hit, false) as flagged from documents d left join s using (doc_id)
""")
def index_flags(spark, sf_dir):
    found = gates.flag_indexes(_as_pieces(spark, sf_dir), ["book_slug"], ["book_slug", "doc_id"])
    return found.select("doc_id", F.array_contains("flags", gates.INDEX).alias("flagged"))


@_query("""
    with p as (select source, lang, count(*) as n, sum(count(*)) over (partition by source) as total from documents where lang <> 'en' group by 1, 2)
    select d.doc_id, case when n / total >= 0.35 then '' else d.lang end as section from documents d left join p on d.source = p.source and d.lang = p.lang
""")
def sections_cleared(spark, sf_dir):
    return gates.sections_cleared(_as_pieces(spark, sf_dir), ["book_slug"], 0.35).select("doc_id", "section")


@_query("select r_regionkey, r_name, cast(sum(n_nationkey + case when n_nationkey > 9 then 1 else 0 end) as int) as poems from region join nation on n_regionkey = r_regionkey group by 1, 2")
def printed_totals(spark, sf_dir):
    """Nations as the sections of a printed index."""
    rows = _t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_nationkey").cast("int").alias("ghazals"), (F.col("n_nationkey") > 9).alias("hamd"))).alias("sections"))
    rows = _t(spark, sf_dir, "region").join(rows, F.col("n_regionkey") == F.col("r_regionkey"))
    empty = F.array().cast("array<int>")
    return gates.printed_poems(rows.withColumns({"poem_pages": empty, "devotional_pages": empty})).select("r_regionkey", "r_name", "poems")


@_query("""
    with e as (select source, count(*) as expected from documents join (select distinct doc_id from labels) using (doc_id) group by 1), a as (select source, count(*) as actual from documents where lang <> 'en' group by 1)
    select 'declared count' as gate, e.source as "key", 'error' as severity, coalesce(actual, 0) || ' poems, ' || expected || ' declared' as message from e left join a using (source) where coalesce(actual, 0) <> expected
""")
def declared_counts_gate(spark, sf_dir):
    pieces = _as_pieces(spark, sf_dir).withColumn("collection", F.col("book_slug"))
    labelled = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return gates.declared_counts(pieces, labelled.groupBy(F.col("source").alias("collection")).agg(F.count("*").alias("expected")))


@_query(f"""
    with l as (select item_id, n, {_SKELETON.format("line")} as k from (select item_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as n from benchmark)),
    m as (select item_id, n, k, exists (select 1 from (select {_SKELETON.format("text")} as t from documents) d where contains(d.t, k)) as hit from l where k <> '')
    select item_id, count(*) filter (hit) as matched, count(*) as total, bool_and(hit) as whole from m group by item_id
""")
def ground_truth(spark, sf_dir):
    """How many lines of each benchmark passage are in the documents."""
    known = _t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("body"))
    return gates.ground_truth(_t(spark, sf_dir, "documents"), known, "doc_id", "text", "item_id")


def _reports(spark, sf_dir):
    """A report of each conversation: approved if it is long, with its digest if it begins with the system."""
    rows = _t(spark, sf_dir, "conversations")
    digest = checks.digest(rows, ["conv_id"], "turn", ["turn", "role", "text"])
    facts = rows.groupBy("conv_id").agg((F.count("*") > 5).alias("long"), (F.min_by("role", "turn") == "system").alias("own"))
    stamp = F.when(F.col("own"), F.col("digest")).otherwise("0123456789abcdef")
    word = F.when(F.col("long"), "true").otherwise("false")
    head = "# Review report\n\n## Approval\n\nsegmentation: ffffffffffffffff\napproved: true\n\n## Approval\n\nsegmentation: "
    return facts.join(digest, "conv_id").withColumn("report", F.concat(F.lit(head), stamp, F.lit("\napproved: "), word, F.lit("\nread by hand\n")))


@_query("select conv_id, count(*) > 5 and arg_min(role, turn) = 'system' as approved from conversations group by conv_id")
def approvals(spark, sf_dir):
    return _reports(spark, sf_dir).select("conv_id", gates.approved(F.col("report"), F.col("digest")).alias("approved"))


@_query(f"""
    with d as ({catalogue.SQL["segmentation_digest"]})
    select conv_id, '# Review report' || chr(10) || chr(10) || '## Approval' || chr(10) || chr(10) || 'segmentation: ffffffffffffffff' || chr(10) || 'approved: true' || chr(10) || chr(10) || '## Approval'
           || chr(10) || chr(10) || 'segmentation: ' || digest || chr(10) || 'approved: false' || chr(10) || 'read by hand' || chr(10) as report from d
""")
def restamped_reports(spark, sf_dir):
    return _reports(spark, sf_dir).select("conv_id", gates.restamped(F.col("report"), F.col("digest")).alias("report"))


@_query("""
    with l as (select doc_id, min(quality) as q, max(toxic) as t from labels group by 1)
    select doc_id, case when source = (select min(source) from documents) then 'unapproved' when q = 0 then 'flagged' when lang = 'es' then 'unknown kind' when n_chars < 40 then 'missing source'
           when q is null then 'new' when t = 1 then 'differs' else 'skipped' end as status from documents left join l using (doc_id)
""")
def insert_only_status(spark, sf_dir):
    """Documents as staged pieces. The archive has the labelled ones, toxic ones with another text."""
    labels = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    docs = _t(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    first = _t(spark, sf_dir, "documents").agg(F.min("source").alias("first"))
    kinds = F.create_map(*[F.lit(x) for x in ("en", "ghazals", "de", "nazms", "fr", "reviews", "es", "letters")])
    keyed = docs.withColumns({"kind": kinds[F.col("lang")], "slug": F.col("doc_id").cast("string")})
    flags = F.when(F.col("q") == 0, F.array(F.lit(gates.GARBAGE))).otherwise(F.array().cast("array<string>"))
    # One row that holds the smallest source.
    staged = keyed.crossJoin(F.broadcast(first)).select("doc_id", "kind", "slug", F.when(F.col("n_chars") >= 40, F.col("text")).alias("body"), flags.alias("flags"), (F.col("source") != F.col("first")).alias("approved"))
    archive = keyed.where("q is not null").select("kind", "slug", F.when(F.col("t") == 1, F.concat("text", F.lit(" z"))).otherwise(F.concat("text", F.lit(" !"))).alias("body"))
    return gates.publish_status(staged, archive).select("doc_id", "status")


@_query("""
    with f as (select p_type, regexp_replace(lower(p_name), '[^a-z0-9]+.*$', '', 'g') as base, p_name, min(p_partkey) as o from part group by p_type, p_name)
    select p_type as book_slug, p_name as collection, case when n = 1 then base else base || '-' || n end as record from (select *, row_number() over (partition by p_type, base order by o) as n from f)
""")
def book_records(spark, sf_dir):
    """Parts as poems, their types as books and names as collections, whose records are named by the first word."""
    rows = _t(spark, sf_dir, "part").select(F.col("p_type").alias("book_slug"), F.col("p_name").alias("collection"), F.col("p_partkey").alias("ord"), F.lit("ghazals").alias("kind"))
    return gates.book_records(rows, lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+.*$", ""))


@_query("select case when lang = 'en' then 'reviews' else 'ghazals' end as kind, case when source is null then '(none)' else source end as collection, count(*) as n from documents group by 1, 2")
def piece_tally(spark, sf_dir):
    return gates.tally(_as_pieces(spark, sf_dir).withColumn("collection", F.coalesce("book_slug", F.lit(""))))


@_query("select 'documents' as collection, count(*) as n from documents union all select 'pages', count(*) from pages union all select 'benchmark', count(*) from benchmark union all select 'labels', count(*) from labels")
def home_counts(spark, sf_dir):
    names = ("documents", "pages", "benchmark", "labels")
    counts = [_t(spark, sf_dir, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("collection"), "n") for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@_query("""
    select n_name, cast(row_number() over (order by n_name collate ur) as int) as rank, translate(cast(row_number() over (order by n_name collate ur) as varchar), '0123456789', '۰۱۲۳۴۵۶۷۸۹') as number, lower(n_name) as find, contains(lower(n_name), 'an') as shown from nation
""")
def title_listing(spark, sf_dir):
    """The listing of poems, with what its search compares and whether a search for an shows it. A small listing: one task."""
    rank = F.row_number().over(Window.orderBy(F.expr("n_name collate ur")))
    rows = _t(spark, sf_dir, "nation").select("n_name", rank.alias("rank"))
    find = F.lower(X.folded(F.col("n_name")))
    return rows.select("n_name", "rank", X.local_digits(F.col("rank")).alias("number"), find.alias("find"), find.contains("an").alias("shown"))


@_query("""
    with l as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_returnflag) as pos from lineitem),
    n as (select *, case when l_returnflag = lag(l_returnflag) over (partition by l_orderkey order by pos) then 0 else 1 end as new from l)
    select l_orderkey as o_orderkey, cast(pos as int) as pos, l_returnflag as section, cast(sum(new) over (partition by l_orderkey order by pos) as bigint) as run, p_name from n join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey
""")
def book_listing(spark, sf_dir):
    """The contents of each order as a book's: resolved references in their order, grouped by neighbouring sections."""
    lines, parts, orders = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"), _t(spark, sf_dir, "orders").select("o_orderkey")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))
    rows = lines.select("l_orderkey", "l_partkey", F.col("l_returnflag").alias("section"), pos.alias("pos"))
    rows = ordered.runs(rows, ["l_orderkey"], ["pos"], "section", "run")
    found = rows.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return found.select("o_orderkey", "pos", "section", "run", "p_name")


@_query("""
    select 'books/' || o_orderkey || '.yaml' as path, 'title: ' || to_json(o_orderpriority) || chr(10) || 'slug: "' || o_orderkey || '"' || chr(10) || 'year: ' || year(o_orderdate) || chr(10) || 'contents:' || chr(10)
           || string_agg('  - { section: ' || to_json(l_returnflag) || ', kind: ' || to_json(l_linestatus) || ', slug: "' || l_partkey || '" }', chr(10) order by l_linenumber, l_returnflag, l_linestatus, l_partkey::varchar) || chr(10) as content
    from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderpriority, o_orderdate
""")
def book_files(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    none = F.lit(None).cast("string")
    rows = rows.select(
        F.col("o_orderkey").cast("string").alias("book_slug"), F.col("o_orderpriority").alias("book_title"), none.alias("publisher"), F.year("o_orderdate").alias("year"), none.alias("collected_in"),
        F.col("l_linenumber").alias("ord"), F.col("l_returnflag").alias("section"), F.col("l_linestatus").alias("kind"), F.col("l_partkey").cast("string").alias("slug"),
    )
    return sinks.books(rows)
