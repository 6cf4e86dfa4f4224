"""Sinks: pieces as markdown, containers and books as YAML, the redirect map, staged pieces and insert-only tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.text import quoted

#: The fields after those that every piece has, in the order in which a file has them.
FIELDS = ("reviewed_book", "reviewed_author", "source", "url", "video_id", "recorded", "description", "written_note", "dedication", "published_in", "part", "source_book", "book_order")


def _field(name: str, kind: T.DataType) -> Column:
    """A line of front matter; null, which drops it, if there is nothing to say."""
    value = F.col(name)
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(value) > 0, F.concat(F.lit(f"{name}: ["), F.array_join(F.transform(value, quoted), ", "), F.lit("]")))
    if isinstance(kind, T.StringType):
        return F.when(value != "", F.concat(F.lit(f"{name}: "), quoted(value)))
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def front_matter(rows: DataFrame) -> Column:
    """The front matter of each row: title, slug, language, script; published, unless it is null; and what fields of tags
    and FIELDS rows have that aren't empty."""
    kinds = {f.name: f.dataType for f in rows.schema}
    always = [F.concat(F.lit(f"{c}: "), quoted(F.coalesce(F.col(c), F.lit("")))) for c in ("title", "slug", "language", "script")]
    published = [F.concat(F.lit("published: "), F.col("published").cast("string"))] if "published" in kinds else []
    return F.concat_ws("\n", *always, *published, *[_field(c, kinds[c]) for c in ("tags", *FIELDS) if c in kinds])


def markdown(rows: DataFrame) -> DataFrame:
    """(path, content): the file of each piece."""
    text = F.concat(F.lit("---\n"), front_matter(rows), F.lit("\n---\n\n"), F.trim(F.regexp_replace("body", r"\A\s+|\s+\z", "")), F.lit("\n"))
    return rows.select(F.concat("kind", F.lit("/"), "slug", F.lit(".md")).alias("path"), text.alias("content"))


def container(rows: DataFrame, title: str, slug: str, description: str, order: str = "part") -> DataFrame:
    """(path, content): the file of a container of pieces, in order. A container is one file: its slugs alone are gathered."""
    entries = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("slug").alias("s")))), lambda x: F.concat(F.lit("  - "), quoted(x["s"])))
    head = [F.concat(F.lit(f"{k}: "), quoted(F.lit(v))) for k, v in (("title", title), ("slug", slug), ("description", description))]
    text = F.concat(F.concat_ws("\n", *head, F.lit("contents:"), entries), F.lit("\n"))
    return rows.agg(text.alias("content")).select(F.lit(f"containers/{slug}.yaml").alias("path"), "content")


def books(rows: DataFrame) -> DataFrame:
    """(path, content): the file of each book of rows (book_slug, book_title, publisher, year, collected_in, ord, section,
    kind, slug): a row for each piece. A book's slugs alone are gathered."""
    section = F.when(F.col("section") != "", F.concat(F.lit(" section: "), quoted(F.col("section")), F.lit(","))).otherwise("")
    entry = F.concat(F.lit("  - {"), section, F.lit(" kind: "), quoted(F.col("kind")), F.lit(", slug: "), quoted(F.col("slug")), F.lit(" }"))
    keys = ("book_slug", "book_title", "publisher", "year", "collected_in")
    found = rows.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", entry.alias("e")))), lambda x: x["e"]).alias("es"))
    optional = [F.when(F.col(c) != "", F.concat(F.lit(f"{c}: "), quoted(F.col(c)))) for c in ("publisher", "collected_in")]
    year = F.concat(F.lit("year: "), F.col("year").cast("string"))
    head = [F.concat(F.lit("title: "), quoted(F.col("book_title"))), F.concat(F.lit("slug: "), quoted(F.col("book_slug"))), optional[0], year, optional[1]]
    text = F.concat(F.concat_ws("\n", *head, F.lit("contents:"), "es"), F.lit("\n"))
    return found.select(F.concat(F.lit("books/"), "book_slug", F.lit(".yaml")).alias("path"), text.alias("content"))


def redirect_map(known: DataFrame) -> DataFrame:
    """(path, content): (post_id, url) as one JSON object, by number."""
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("post_id", "url"))), lambda x: F.concat(F.lit('  "'), x["post_id"].cast("string"), F.lit('": '), quoted(x["url"])))
    text = F.when(F.count("*") == 0, "{}").otherwise(F.concat(F.lit("{\n"), F.array_join(pairs, ",\n"), F.lit("\n}")))
    return known.agg(text.alias("content")).select(F.lit("postmap.json").alias("path"), "content")


def write_files(files: DataFrame, root: str) -> None:
    """Writes files (path, content) below root, a folder that all machines share. Each is renamed when it is whole, so a task
    that runs twice does no harm; line ends stay as they are."""

    def write(rows) -> None:
        for r in rows:
            path = os.path.join(root, r.path)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            part = f"{path}.{os.getpid()}.part"
            with open(part, "w", encoding="utf-8", newline="") as f:
                f.write(r.content)
            os.replace(part, path)

    files.select("path", "content").foreachPartition(write)


def write_staged(pieces: DataFrame, path: str) -> None:
    """Writes pieces as Parquet by book: books that pieces has are replaced, others stay."""
    pieces.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("book_slug").parquet(path)


def write_insert_only(staged: DataFrame, path: str, key: list[str], status: str = "status") -> None:
    """Adds the rows of status new to the Parquet table at path, less those of a key that is there: a second run writes
    nothing. Of rows with an equal key one is written. What is there isn't touched."""
    spark = staged.sparkSession
    rows = staged.where(F.col(status) == "new").drop(status).dropDuplicates(key)
    if _exists(spark, path):
        there = spark.read.parquet(path).select(*[F.col(k).alias(f"__{k}") for k in key])
        same = F.lit(True)
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        rows = rows.join(there, same, "left_anti")
    rows.write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)
