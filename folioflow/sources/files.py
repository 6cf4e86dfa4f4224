"""Sources: exports, files with front matter, containers, staged pieces and redirect maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def posts(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, title, body, categories, published, post_name) of the published posts of XML exports, in one scan."""
    schema = (
        "title string, `content:encoded` string, `wp:post_id` bigint, `wp:post_type` string, `wp:status` string, `wp:post_date` string, `wp:post_name` string, "
        "category array<struct<_VALUE: string, _domain: string>>"
    )
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    # Its place in the file: Spark numbers the rows of a file's task in the order in which it reads them.
    items = items.withColumn("seq", F.monotonically_increasing_id())
    kept = items.where("`wp:post_type` = 'post' and `wp:status` = 'publish'")
    categories = F.transform(F.filter("category", lambda c: (c["_domain"] == "category") & (c["_VALUE"] != "")), lambda c: c["_VALUE"])
    return kept.select(
        F.col("`wp:post_id`").alias("post_id"),
        "title",
        F.col("`content:encoded`").alias("body"),
        F.coalesce(categories, F.array().cast("array<string>")).alias("categories"),
        F.substring("`wp:post_date`", 1, 10).alias("published"),
        F.col("`wp:post_name`").alias("post_name"),
        "seq",
    )


def attachments(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, url) of the attachments of XML exports."""
    items = spark.read.format("xml").option("rowTag", "item").schema("`wp:post_id` bigint, `wp:post_type` string, `wp:attachment_url` string").load(path)
    kept = items.where("`wp:post_type` = 'attachment' and `wp:attachment_url` <> ''")
    return kept.select(F.col("`wp:post_id`").alias("post_id"), F.col("`wp:attachment_url`").alias("url"))


def keep_first_image(urls: DataFrame, url: str, order: str) -> DataFrame:
    """The first of the rows whose file's name is equal but for a copy's number, with that name."""
    named = urls.withColumn("name", F.regexp_replace(F.substring_index(url, "/", -1), r"-\d+(\.[A-Za-z0-9]+)$", "$1"))
    first = F.row_number().over(Window.partitionBy("name").orderBy(order)) == 1
    return named.withColumn("__first", first).where("__first").drop("__first")


def listed(value: Column) -> Column:
    """The strings of a field that is a list in one line, such as ["a", "b"]; null of other fields."""
    return F.when(value.rlike(r"\A\[.*\]\z"), F.from_json(value, "array<string>"))


def unquoted(value: Column) -> Column:
    """A field without the quotes of a JSON string around it."""
    return F.when(value.rlike(r'\A".*"\z'), F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")[0]).otherwise(value)


def front_matter(spark: SparkSession, path: str) -> DataFrame:
    """(path, fields, body) of markdown files that begin with fields between lines of three hyphens. Fields are as written:
    listed and unquoted read them."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    form = r"(?s)\A---[ \t]*\r?\n(.*?)\r?\n---[ \t]*(?:\r?\n(.*))?\z"
    pairs = F.filter(F.split(F.regexp_extract("value", form, 1), "\r?\n"), lambda s: s.contains(":"))
    entries = F.transform(pairs, lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)), F.trim(F.regexp_replace(s, r"^[^:]*:\s*", ""))))
    return whole.select("path", F.map_from_entries(entries).alias("fields"), F.trim(F.when(F.col("value").rlike(form), F.regexp_extract("value", form, 2)).otherwise(F.col("value"))).alias("body"))


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, url) of a JSON object from ids to addresses."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string, string>")).alias("id", "url")).select(F.col("id").cast("bigint").alias("post_id"), "url")


def containers(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, slug, description, pos, section, kind, entry) of container and book files, a row for each entry of
    their contents, in order from 0: a string, or section, kind and slug."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")

    def of(name: str) -> Column:
        found = F.regexp_extract("value", rf'(?m)^{name}: "((?:[^"\\\\]|\\\\.)*)"', 1)
        return F.when(found != "", unquoted(F.concat(F.lit('"'), found, F.lit('"')))).alias(name)

    lines = F.regexp_extract_all("value", F.lit(r"(?m)^  - (.+)$"), F.lit(1))
    rows = whole.select("path", of("title"), of("slug"), of("description"), F.posexplode(lines).alias("pos", "e"))

    def part(name: str) -> Column:
        found = F.regexp_extract("e", rf'\b{name}: "((?:[^"\\\\]|\\\\.)*)"', 1)
        return F.when(found != "", found)

    entry = F.when(F.col("e").startswith("{"), part("slug")).otherwise(unquoted(F.trim("e")))
    return rows.select("path", "title", "slug", "description", "pos", part("section").alias("section"), part("kind").alias("kind"), entry.alias("entry"))


SEGMENT = (
    "kind string, title string, body string, order int, section string, precedes_first_heading boolean, collection string, written_note string, "
    "dedication string, reviewed_author string, reviewed_book string, flags array<string>"
)


def staged(spark: SparkSession, path: str) -> DataFrame:
    """(path, the columns of SEGMENT) of JSON files that are lists of pieces."""
    return spark.read.schema(SEGMENT).option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("path"), "*")
