"""Exact deduplication by Grace hashing (operator 1).

Records are partitioned by bits of a hash of their content. Buckets whose distinct contents would not fit the memory
given to a table are partitioned again by further bits, and so on; the sizes that decide this come from a table of
fingerprints, so each record is moved once, straight to its last bucket (Spark's shuffle files are the spill files).
A bucket is then deduplicated by an open-addressing table that compares complete contents. Contents so frequent that
their copies alone would overload a task are first deduplicated in salted parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.shared import fresh, without, written

#: Bytes of distinct contents that one table may hold.
BUCKET_BYTES = 64 << 20
#: Bytes of copies of a single content from which it is deduplicated in salted parts first.
HOT_BYTES = 32 << 20
#: Bits of the hash by which a bucket that is too large is partitioned again.
FANOUT_BITS = 4
#: At most so many contents are treated as hot: the hottest bytes threshold rises with the input to hold this.
MAX_HOT = 1_000_000
#: At most so many buckets of a level are named as to be split; where more are too large, all of the level are split.
MAX_SPLIT = 1000
#: Partitions of the shuffle at most: buckets come one after the other in a partition, so their number needs no bound.
MAX_PARTITIONS = 20_000


class OpenTable:
    """Open addressing with linear probing; an entry is equal only if the complete content is."""

    def __init__(self) -> None:
        self.slots = [-1] * 64
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def add(self, content: bytes) -> tuple[int, bool]:
        """The content's entry and whether it is new."""
        h = hash(content)
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, False
            at = (at + 1) & mask
        entry = self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _bucket_runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield int(ids[lo]), batch.slice(lo, hi - lo)


def _deduplicate(key: int, counts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, column 0, then by id. key, counts: positions of the content and of the counts so far."""
    table, kept, sums, where, bucket = OpenTable(), [], [], [], None

    def flush() -> Iterator[pa.RecordBatch]:
        if kept:
            done = pa.Table.from_batches(kept)
            done = done.set_column(counts, done.schema.field(counts).name, pa.array(sums, pa.int64()))
            yield from done.drop_columns([done.schema.names[0]]).to_batches(max_chunksize=2000)

    for batch in batches:
        for at, run in _bucket_runs(batch):
            if at != bucket:
                yield from flush()
                table, kept, sums, where, bucket = OpenTable(), [], [], [], at
            new = []
            for i, (content, n) in enumerate(zip(_bytes(run.column(key)), run.column(counts).to_pylist())):
                if content is not None:
                    entry, first = table.add(content)
                    if not first:
                        sums[where[entry]] += n
                        continue
                    where.append(len(sums))
                sums.append(n)
                new.append(i)
            if new:
                kept.append(run.take(pa.array(new)))
    yield from flush()


def _bytes(column: pa.Array) -> list[bytes | None]:
    return (column.cast(pa.binary()) if pa.types.is_string(column.type) else column).to_pylist()


def _leaf(h: Column, bits: int, split: list[list[int] | None]) -> Column:
    """The bucket of a hash: its first bits, and more of them where the bucket so far is among those to split."""
    out = F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("bigint")
    depth = F.lit(bits)
    for level, prefixes in enumerate(split):
        wide = bits + FANOUT_BITS * (level + 1)
        deeper = depth == wide - FANOUT_BITS
        if prefixes is not None:
            deeper &= out.isin(prefixes)
        depth = F.when(deeper, F.lit(wide)).otherwise(depth)
        out = F.when(deeper, F.shiftrightunsigned(h, 64 - wide)).otherwise(out)
    return F.xxhash64(out, depth)


def _oversize(sizes: DataFrame, bits: int, bucket_bytes: int) -> list[list[int] | None]:
    """By level, the buckets of several contents that are larger than bucket_bytes, or None for all buckets of the level;
    each level looks into those of the last."""
    levels, within = [], sizes
    while bits + FANOUT_BITS <= 63:
        prefix = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("bigint")
        large = within.groupBy(prefix.alias("p")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        large = large.where((F.col("bytes") > bucket_bytes) & (F.col("n") > 1)).select("p")
        found = [r.p for r in large.limit(MAX_SPLIT + 1).collect()]
        if not found:
            break
        levels.append(found if len(found) <= MAX_SPLIT else None)
        if levels[-1]:
            within = within.where(prefix.isin(found))
        bits += FANOUT_BITS
    return levels


def exact_dedup(
    docs: DataFrame,
    content: str = "text",
    id_col: str = "doc_id",
    bucket_bytes: int = BUCKET_BYTES,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """The rows of docs less all but one of those with equal content, and n_copies, how many rows it stands for.

    Of equal contents the row of the smallest id stays (a null id comes last; among equal ids any one row). Contents
    are compared byte by byte, whole, also where they are no UTF-8. A row whose content is null equals no other and stays with n_copies 1; empty
    contents are equal to one another. Very long contents are treated like others: a single one larger than
    bucket_bytes has its bucket to itself. An empty table gives an empty table. Other columns are carried along; a
    column named n_copies, in any case of letters, is replaced.
    """
    docs = without(docs, "n_copies")
    names = docs.columns
    bucket, hash_, counts = fresh(docs, "bucket", "h", "n_copies")
    text = F.col(f"`{content}`")
    h = F.xxhash64(text)
    sizes = written(
        docs.where(text.isNotNull()).groupBy(h.alias("h")).agg(F.max(F.octet_length(text)).cast("bigint").alias("bytes"), F.count("*").alias("n")),
        "fingerprints",
    )
    total = sizes.agg(F.sum("bytes").alias("distinct"), F.sum(F.col("bytes") * F.col("n")).alias("all")).first()
    distinct, everything = total["distinct"] or 0, total["all"] or 0
    bits = max(0, math.ceil(math.log2(max(1, 4 * distinct / bucket_bytes))))
    split = _oversize(sizes, bits, bucket_bytes)
    hot_from = max(hot_bytes, everything // MAX_HOT)
    hot = sizes.where((F.col("bytes") * F.col("n") > hot_from) & (F.col("n") > 1)).select(F.col("h").alias(hash_))
    partitions = max(docs.sparkSession.sparkContext.defaultParallelism, min(MAX_PARTITIONS, math.ceil(everything / (bucket_bytes / 2))))

    def once(rows: DataFrame, salt: Column) -> DataFrame:
        """rows have the counts so far. Nulls, which need no table, are spread by id."""
        at = F.when(text.isNull(), F.xxhash64(F.col(f"`{id_col}`"))).otherwise(_leaf(F.xxhash64(text), bits, split))
        keyed = rows.select(F.xxhash64(at, salt).alias(bucket), *[F.col(f"`{c}`") for c in rows.columns])
        moved = keyed.repartition(partitions, bucket).sortWithinPartitions(F.col(bucket), F.col(f"`{id_col}`").asc_nulls_last())
        key, n = 1 + names.index(content), 1 + rows.columns.index(counts)
        return moved.mapInArrow(lambda batches: _deduplicate(key, n, batches), rows.schema)

    rows = docs.withColumn(counts, F.lit(1).cast("bigint"))
    none = F.lit(0).cast("bigint")
    if not hot.limit(1).count():
        return once(rows, none)
    # At most MAX_HOT hashes of 8 bytes, so 8 MB, whatever the input's size.
    marked = rows.withColumn(hash_, h)
    many = marked.join(F.broadcast(hot), hash_, "left_semi").drop(hash_)
    others = marked.join(F.broadcast(hot), hash_, "left_anti").drop(hash_)
    salt = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(max(2, partitions)))
    return once(others, none).unionByName(once(once(many, salt), none))
