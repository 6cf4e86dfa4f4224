"""Tables in the cluster's shared folder, fresh column names and connected components."""

from __future__ import annotations

import gc
import re
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset and the master is local (tests), a temporary one.

    A cluster without the setting is an error: its machines share no temporary folder.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{SETTING} must name a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage is cut, and a lost executor costs nothing.

    The table goes when the application ends. An empty df gives an empty table of the same schema.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(path)
    except BaseException:
        files.delete(hadoop, True)
        raise
    files.deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def dropped(table: DataFrame) -> None:
    """A table of written() that nothing reads any more goes now, not when the application ends."""
    spark = table.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def freed(spark: SparkSession) -> None:
    """Shuffle files that nothing refers to any more are deleted now, not when the driver next collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made of names that no column of df has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less the columns, in any case of letters, that a result of the same name replaces."""
    drop = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for each node of edges (a, b: of any type with an order), the smallest node of its connected component.

    Large-star and small-star steps (Kiveris et al., 2014) until nothing changes, each round written to the shared
    folder. Loops and repeated edges do no harm; edges with a null end are ignored; no edges give no rows.
    """
    pairs = edges.where("a is not null and b is not null and a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        last, pairs = pairs, written(small.where("a <> b").distinct(), "edges")
        dropped(last)
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def readable(text: Column) -> Column:
    """text with each run of bytes that is no UTF-8 as replacement characters: what Python and Java strings can hold. A
    valid text, of any length, and a null stay as they are. What isn't text is taken as its string."""
    return F.make_valid_utf8(text.cast("string"))


_WORD = re.compile(r"\w+")
_SIGNS = {i: 32 for i in range(128) if not (chr(i).isalnum() or chr(i) == "_")}
#: With more different signs than these, one pass of an expression is cheaper than one pass for each.
_MANY = 64


def split_words(text: str) -> list[str]:
    r"""All matches of \w+ in text, several times as fast: what is no letter becomes a space, and spaces split."""
    if text.isascii():
        return text.translate(_SIGNS).split()
    signs = [c for c in set(text) if not (c.isalnum() or c == "_" or c.isspace())]
    if len(signs) > _MANY:
        return _WORD.findall(text)
    for c in signs:
        text = text.replace(c, " ")
    return text.split()


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: tasks that share the worker share what they keep in it."""
    return sys.modules.setdefault("_folioflow_worker", types.ModuleType("_folioflow_worker")).__dict__
