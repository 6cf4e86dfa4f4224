"""Operators on ordered rows: each takes the columns that part the rows and those that order them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, part: list[str], order: list[str], starts: Column, to: str) -> DataFrame:
    """rows with their island's number from 1: a row for which starts holds begins one. Rows before the first have 0."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(to, F.sum(F.when(starts, 1).otherwise(0)).over(w))


def runs(rows: DataFrame, part: list[str], order: list[str], key: str, to: str) -> DataFrame:
    """rows with the number of their run of equal keys; the same key later is another run."""
    w = Window.partitionBy(*part).orderBy(*order)
    new = ~F.lag(key).over(w).eqNullSafe(F.col(key)) | (F.row_number().over(w) == 1)
    return islands(rows.withColumn("__new", new), part, order, F.col("__new"), to).drop("__new")


def carried(rows: DataFrame, part: list[str], order: list[str], value: Column, to: str) -> DataFrame:
    """rows with the last value so far that isn't null."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(to, F.last(value, ignorenulls=True).over(w))


def paired(rows: DataFrame, part: list[str], order: list[str], second: Column) -> DataFrame:
    """rows with pair and half: a row that isn't a second line starts anew, and rows pair up from there. half tells a
    row without a partner. Pairs are numbered within their part from 1."""
    found = islands(rows, part, order, ~second, "__island")
    inner = Window.partitionBy(*part, "__island").orderBy(*order)
    found = found.withColumn("__at", F.row_number().over(inner) - 1)
    found = islands(found, part, order, F.col("__at") % 2 == 0, "pair").withColumn("half", F.count("*").over(Window.partitionBy(*part, "pair")) == 1)
    return found.drop("__island", "__at")


def halves_merged(pairs: DataFrame, part: list[str], pair: str = "pair", half: str = "half") -> DataFrame:
    """One row for each pair with merged, its number after neighbouring halves were joined two by two from the left."""
    w = Window.partitionBy(*part).orderBy(pair)
    found = runs(pairs, part, [pair], half, "__run")
    inner = Window.partitionBy(*part, "__run").orderBy(pair)
    joins = F.col(half) & (F.row_number().over(inner) % 2 == 0)
    found = found.withColumn("__joins", joins)
    return found.withColumn("merged", F.sum(F.when(F.col("__joins"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__run", "__joins")


def bridged(rows: DataFrame, part: list[str], order: list[str], kind: str = "kind", inside: dict[str, int | None] | None = None) -> DataFrame:
    """rows with bridged: a run of unknown rows, or of one row of prose, between verse on both sides is verse too."""
    inside = {"unknown": None, "prose": 1} if inside is None else inside
    found = runs(rows, part, order, kind, "__run")
    sizes = found.groupBy(*part, "__run").agg(F.first(kind).alias("__kind"), F.count("*").alias("__size"))
    w = Window.partitionBy(*part).orderBy("__run")
    small = F.lit(False)
    for k, most in inside.items():
        small = small | ((F.col("__kind") == k) & (F.lit(True) if most is None else F.col("__size") <= most))
    between = (F.lag("__kind").over(w) == "verse") & (F.lead("__kind").over(w) == "verse")
    fixed = sizes.select(*part, "__run", F.when(between & small, "verse").otherwise(F.col("__kind")).alias("bridged"))
    return found.join(fixed, [*part, "__run"]).drop("__run")


def body_start(
    rows: DataFrame, part: list[str], order: str, fits: Column, second: Column, length: int = 4, separator: Column | None = None, prose: Column | None = None
) -> DataFrame:
    """(part, start): where length rows in a row fit and every other one is a second line; else the number of rows. The
    row after the last separator before them is the start if there is no prose in between."""
    w = Window.partitionBy(*part).orderBy(order)
    good = F.lit(True)
    for k in range(length):
        here = F.lead(fits, k).over(w) & (F.lead(second, k).over(w) == F.lit(k % 2 == 1))
        good = good & F.coalesce(here, F.lit(False))
    no = F.lit(False)
    found = rows.select(*part, order, good.alias("__good"), F.lead(order).over(w).alias("__after"), F.coalesce(separator, no).alias("__separator") if separator is not None else no.alias("__separator"), F.coalesce(prose, no).alias("__prose") if prose is not None else no.alias("__prose"))
    found = found.withColumn("__first", F.min(F.when(F.col("__good"), F.col(order))).over(Window.partitionBy(*part)))
    before = F.col(order) < F.col("__first")
    fenced = F.max(F.when(before & F.col("__separator"), F.col("__after")))
    essay = F.max(F.when(before & F.col("__prose"), F.col(order)))
    start = F.when(fenced > essay, fenced).otherwise(F.when(essay.isNull(), fenced))
    return found.groupBy(*part).agg(F.coalesce(start, F.min("__first"), F.count("*")).alias("start"))


def neighbours(rows: DataFrame, order: list[str], value: str, part: list[str] | None = None, circular: bool = False) -> DataFrame:
    """rows with previous and next. circular: the last comes before the first."""
    w = Window.partitionBy(*(part or [])).orderBy(*order)
    all_ = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    if circular:
        before, after = F.coalesce(before, F.last(value).over(all_)), F.coalesce(after, F.first(value).over(all_))
    return rows.withColumns({"previous": before, "next": after})


def isolated_dropped(codes: DataFrame, part: list[str], offset: str = "offset", code: str = "code", least: int = 2) -> DataFrame:
    """The rows in runs of at least so many neighbours, two bytes apart; then control codes go."""
    w = Window.partitionBy(*part).orderBy(offset)
    found = codes.withColumn("__run", F.col(offset) - 2 * F.row_number().over(w))
    found = found.withColumn("__size", F.count("*").over(Window.partitionBy(*part, "__run")))
    return found.where((F.col("__size") >= least) & (F.col(code) >= 0x20)).drop("__run", "__size")


def digits_reversed(letters: DataFrame, part: list[str], idx: str = "idx", letter: str = "letter") -> DataFrame:
    """letters with idx changed so that each maximal run of digits is in the reverse order."""
    found = letters.withColumn("__digit", F.col(letter).rlike("^[0-9۰-۹]$"))
    found = runs(found, part, [idx], "__digit", "__run")
    w = Window.partitionBy(*part, "__run")
    new = F.when(F.col("__digit"), F.min(idx).over(w) + F.max(idx).over(w) - F.col(idx)).otherwise(F.col(idx))
    return found.withColumn("__idx", new).drop(idx, "__digit", "__run").withColumnRenamed("__idx", idx)
