"""Which texts contain which passages, by an equality to join on instead of a nested loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of an anchor.
ANCHOR = 3
#: Different passages, and bytes of them, up to which they are sought in one pass over the texts.
MOST, MOST_BYTES = 100_000, 1 << 25


def _grams(words: Column, n: int) -> Column:
    """The hashes of each n words in a row."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, n)))


def _sought(docs: DataFrame, needles: DataFrame, text: str, needle: str, keep: list[str], names: list[str], passages: list[bytes]) -> DataFrame:
    by_anchor: dict[tuple, list[bytes]] = {}
    short = []
    for p in passages:
        inner = p.split(b" ")[1:-1]
        if len(inner) < ANCHOR:
            short.append(p)
        else:
            by_anchor.setdefault(max(zip(*[inner[k:] for k in range(ANCHOR)]), key=lambda t: sum(map(len, t))), []).append(p)

    def run(batches):
        import pyarrow as pa

        anchors = frozenset(by_anchor)
        for b in batches:
            rows, hits = [], []
            for n, value in enumerate(b.column(0)):
                whole = value.as_py()
                words = whole.split(b" ")
                met = anchors.intersection(zip(*[words[k:] for k in range(ANCHOR)]))
                found = [p for a in met for p in by_anchor[a] if p in whole]
                found += [p for p in short if p in whole]
                rows += [n] * len(found)
                hits += found
            taken = b.select(range(1, b.num_columns)).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(hits, pa.binary())], names=[*ids, "__needle"])

    ids = [f"__d{k}" for k in range(len(keep))]
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("binary").alias("__text"), *[F.col(c).alias(i) for c, i in zip(keep, ids)])
    found = rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField("__needle", T.BinaryType())]))
    named = needles.where(F.col(needle).isNotNull()).select(*names, F.col(needle).cast("binary").alias("__needle"))
    return found.join(named, "__needle").select(*[F.col(i).alias(c) for i, c in zip(ids, keep)], *names)


def contained(docs: DataFrame, needles: DataFrame, text: str, needle: str, keep: list[str], names: list[str], most: int = MOST) -> DataFrame:
    """(keep, names) of each row of docs and of needles whose passage is in the text, as contains has it.

    A passage that occurs in a text brings its inner words, all but the first and the last that spaces part, along as
    whole words. So three words in the middle of it, the longest ones, are its anchor: texts are joined by the hashes of
    their word triples, and what meets is compared in full. Passages of fewer than five words have no anchor; they alone are
    sought in every text. Null texts and passages match nothing; an empty passage is in every text; columns may share
    names. Repeated rows match each.

    Where there are at most so many different passages, tasks hold them and no word is moved; else it is a join of all
    triples. Both find the same.
    """
    passages = needles.where(F.col(needle).isNotNull()).select(F.col(needle).cast("binary").alias("n")).distinct()
    if passages.agg(F.coalesce(F.sum(F.length("n")), F.lit(0))).first()[0] <= MOST_BYTES:
        found = passages.limit(most + 1).collect()
        if len(found) <= most:
            return _sought(docs, needles, text, needle, keep, names, [bytes(r.n) for r in found])
    inner = F.split(F.col(needle), " ")
    triples = _grams(F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0))), ANCHOR)
    sizes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(inner) - 2 - ANCHOR + 1, F.lit(1))), lambda i: F.length(F.array_join(F.slice(inner, i + 1, ANCHOR), " ")))
    many = needles.where(F.col(needle).isNotNull()).select(*names, F.col(needle).alias("__needle"), triples.alias("__t"), sizes.alias("__s"))
    best = F.get("__t", (F.array_position("__s", F.array_max("__s")) - 1).cast("int"))
    many = many.select(*names, "__needle", best.alias("__key"))
    anchored, short = many.where("__key is not null"), many.where("__key is null").drop("__key")
    rows = docs.where(F.col(text).isNotNull()).select(*[F.col(c).alias(f"__d{k}") for k, c in enumerate(keep)], F.col(text).alias("__text"))
    columns = [F.col(f"__d{k}").alias(c) for k, c in enumerate(keep)] + [F.col(c) for c in names]
    ids = [f"__d{k}" for k in range(len(keep))]
    keys = rows.select(*[F.col(c).alias(f"_{c}") for c in ids], F.explode(F.array_distinct(_grams(F.split("__text", " "), ANCHOR))).alias("__key"))
    # The texts themselves aren't moved before it is known which of them meet an anchor.
    met = keys.join(anchored.select("__key").distinct(), "__key", "left_semi").distinct()
    same = F.lit(True)
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    long = rows.join(met, same).join(anchored, "__key").where(F.col("__text").contains(F.col("__needle"))).select(*columns)
    return long.unionByName(rows.join(short, F.col("__text").contains(F.col("__needle"))).select(*columns))
