"""Near-duplicate removal by SimHash with covering locality-sensitive hashing (operator 2).

A document's fingerprint has 128 bits: the signs of the sums of its words' hashes, each weighted by the square root of
the word's count. The bits are in two or three parts. For each part the masks of Pagh's covering families (2016) are
built for its radius r: bit i gets a vector m(i) of r + 1 bits, and mask v, for each of the 2^(r+1) - 1 vectors v but 0,
holds the bits with <m(i), v> = 1. At most r differing bits span no more than r dimensions, so some v is orthogonal to
all of them, and both fingerprints agree on that mask. With radii r, pairs that differ in fewer bits than the sum of all
r + 1 differ within its radius in one part: such a pair is never missed. That sum is ACCEPT + 1 in each of RADII, so
every pair that counts as near meets, and which radii are taken changes the cost alone: three parts have 253 masks of
some 21 bits each, two have 1534 of 32, of which buckets stay small with any number of documents. Masks are gone
through in waves, whose shuffle files are freed: the disk holds one wave's.

Within each bucket (mask and masked bits) the graph of near pairs is searched breadth first, each fingerprint visited
once, which gives the edges of a spanning forest: its components are those of all near pairs, however large the bucket.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.shared import components, dropped, freed, fresh, readable, split_words, without, written

#: Differing bits of each part of the fingerprint up to which a common bucket is guaranteed, for up to so many different
#: fingerprints, then for any number.
RADII = (1 << 24, (5, 5, 6)), (None, (8, 9))
#: Differing bits of the whole fingerprint up to which a pair in a common bucket is near.
ACCEPT = 18
#: Bytes of fingerprints that a shard of buckets should hold.
SHARD_BYTES = 24 << 20
#: Entries of a bucket up to which all its pairs are compared at once.
_SMALL = 12
#: Masks of a wave.
WAVE = 128

#: A token without word boundaries, as in Chinese or encoded data, is taken in pieces of so many characters.
_LONG = 24
_PIECE = 6
#: Distinct words of a text whose hashes are summed at a time.
_CHUNK = 1 << 16
#: The bits of each byte, the highest first, and where each byte's counts begin.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)
_AT = 256 * np.arange(16)


def words(text: str) -> list[str]:
    found = split_words(text.lower())
    if not found or max(map(len, found)) <= _LONG:
        return found
    return [p for w in found for p in ([w] if len(w) <= _LONG else [w[i : i + _PIECE] for i in range(0, len(w), _PIECE)])]


def fingerprint(text: str) -> tuple[int, int] | None:
    """The two halves as signed 64-bit integers; None where there is no word. Weights are whole numbers: no rounding.

    Weights are summed by the value of each byte of the hashes, from which follow the sums for each bit.
    """
    counts = Counter(words(text))
    if not counts:
        return None
    weights = np.rint(16 * np.sqrt(np.fromiter(counts.values(), np.float64, len(counts))))
    sums, found = np.zeros(4096), iter(counts)
    for lo in range(0, len(weights), _CHUNK):
        part = weights[lo : lo + _CHUNK]
        rows = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, islice(found, _CHUNK))), np.uint8).reshape(-1, 16)
        sums += np.bincount((rows + _AT).ravel(), np.repeat(part, 16), 4096)
    on = 2 * (sums.reshape(16, 256) @ _BITS).ravel() > weights.sum()
    return tuple(np.packbits(on).view(">i8").tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t) if t else None for t in batch.column(1).to_pylist()]
        a = pa.array([f and f[0] for f in found], pa.int64())
        b = pa.array([f and f[1] for f in found], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), a, b], names=["id", "a", "b"])


def masks(radius: int, n_bits: int = 64, first: int = 0, seed: int = 2016) -> np.ndarray:
    """The masks of one covering family on n_bits of the 128 bits, from bit first on: rows of two whole numbers. The
    vectors of the bits differ as far as there are enough."""
    rng = np.random.default_rng(seed)
    some = np.concatenate([rng.permutation(np.arange(1, 2 ** (radius + 1))) for _ in range(n_bits)])[:n_bits]
    odd = np.array([[bin(v & m).count("1") & 1 for m in some.tolist()] for v in range(1, 2 ** (radius + 1))], np.uint64)
    at = np.arange(first, first + n_bits)
    halves = [(odd[:, at // 64 == h] << (at[at // 64 == h] % 64).astype(np.uint64)).sum(axis=1, dtype=np.uint64) for h in (0, 1)]
    return np.stack(halves, axis=1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _families(radii: tuple[int, ...]) -> np.ndarray:
    """The masks of all parts, one after the other."""
    cuts = [128 * k // len(radii) for k in range(len(radii) + 1)]
    return np.concatenate([masks(r, hi - lo, lo) for r, lo, hi in zip(radii, cuts, cuts[1:])])


def radii(nodes: int) -> tuple[int, ...]:
    return next(r for most, r in RADII if most is None or nodes <= most)


def _hashed(table: np.ndarray, a: np.ndarray, b: np.ndarray, family: np.ndarray) -> np.ndarray:
    """One number for each bucket. Buckets that share it by chance are searched as one, which adds no wrong pair."""
    part = _mix(a & family[table, 0]) + (b & family[table, 1])
    return _mix(part ^ _mix(table.astype(np.uint64) + np.uint64(1)))


def _spread(shards: int, radius: tuple[int, ...], wave: range, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once for each mask of the wave, as binaries by shard: tables, first halves, second halves."""
    family = _families(radius)
    tables = np.arange(wave.start, wave.stop, dtype=np.uint16)
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            a = part.column(0).to_numpy().view(np.uint64)
            b = part.column(1).to_numpy().view(np.uint64)
            t = np.repeat(tables, len(a))
            a, b = np.tile(a, len(tables)), np.tile(b, len(tables))
            shard = (_hashed(t, a, b, family) >> np.uint64(20)) % np.uint64(shards)
            order = np.argsort(shard.astype(np.uint32), kind="stable")
            shard, t, a, b = shard[order], t[order], a[order], b[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]]).tolist()
            blobs = [t[i:j].tobytes() + a[i:j].tobytes() + b[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]
            ids = pa.array(shard[cuts[:-1]].astype(np.int64))
            yield pa.RecordBatch.from_arrays([ids, pa.array(blobs, pa.binary())], names=["shard", "blob"])


def _forest(a: np.ndarray, b: np.ndarray, accept: int) -> list[tuple[int, int]]:
    """Positions of the edges of a spanning forest of the graph of near pairs."""
    edges, rest = [], np.arange(len(a))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(a[rest] ^ a[at]) + np.bitwise_count(b[rest] ^ b[at]) <= accept
            found = rest[near].tolist()
            edges += [(at, x) for x in found]
            queue += found
            rest = rest[~near]
    return edges


def _near(radius: tuple[int, ...], accept: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard. The edges of each shard's buckets, each once."""
    family = _families(radius)

    def search(blobs: list[bytes]) -> pa.RecordBatch:
        ns = [len(x) // 18 for x in blobs]
        t = np.concatenate([np.frombuffer(x, np.uint16, n) for x, n in zip(blobs, ns)])
        a = np.concatenate([np.frombuffer(x, np.uint64, n, 2 * n) for x, n in zip(blobs, ns)])
        b = np.concatenate([np.frombuffer(x, np.uint64, n, 10 * n) for x, n in zip(blobs, ns)])
        z = _hashed(t, a, b, family)
        order = np.argsort(z)
        z, a, b = z[order], a[order], b[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(z)) + 1, [len(z)]])
        sizes = np.diff(cuts)
        left, right = [], []
        # Small buckets all at once: each entry with those after it.
        place = np.arange(len(z)) - np.repeat(cuts[:-1], sizes)
        after = np.where(np.repeat(sizes, sizes) <= _SMALL, np.repeat(sizes, sizes) - place - 1, 0)
        for step in range(1, _SMALL):
            lo = np.flatnonzero(after >= step)
            near = np.bitwise_count(a[lo] ^ a[lo + step]) + np.bitwise_count(b[lo] ^ b[lo + step]) <= accept
            left.append(lo[near])
            right.append(lo[near] + step)
        for at, size in zip(cuts[:-1][sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
            if edges := _forest(a[at : at + size], b[at : at + size], accept):
                pairs = at + np.array(edges)
                left.append(pairs[:, 0])
                right.append(pairs[:, 1])
        left, right = np.concatenate(left), np.concatenate(right)
        ends = np.unique(np.stack([a[left], b[left], a[right], b[right]], axis=1).view(np.int64), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in ends.T], names=["a1", "b1", "a2", "b2"])

    shard, blobs = None, []
    for batch in batches:
        for at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != shard and blobs:
                yield search(blobs)
                blobs = []
            shard = at
            blobs.append(blob)
    if blobs:
        yield search(blobs)


def _edges(nodes: DataFrame, shards: int, radius: tuple[int, ...], accept: int, wave: range) -> DataFrame:
    """The near pairs that meet in the masks of a wave, each pair once."""
    spread = nodes.select("a", "b").mapInArrow(lambda x: _spread(shards, radius, wave, x), "shard bigint, blob binary")
    return (
        spread.repartition(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(lambda x: _near(radius, accept, x), "a1 bigint, b1 bigint, a2 bigint, b2 bigint")
        .distinct()
    )


def near_groups(docs: DataFrame, text: str = "text", id_col: str = "doc_id", radius: tuple[int, ...] | None = None, accept: int = ACCEPT) -> DataFrame:
    """(id, root, n) for each document with words: the smallest id of its near-duplicate group, and the group's size.

    Groups are the connected components of near pairs. Rows whose id or text is null or without words are left out. Ids
    may have any type that has an order; the smallest is by that order. radius: the radii of the parts; by default those
    of RADII for the number of different fingerprints. Repeated rows of
    an id count as one document for each text.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), readable(F.col(f"`{text}`")).alias("t")).where("id is not null")
    ids = source.schema["id"].dataType.simpleString()
    prints = written(source.mapInArrow(_fingerprints, f"id {ids}, a bigint, b bigint").where("a is not null"), "simhash")
    nodes = prints.groupBy("a", "b").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    nodes = written(nodes, "nodes")
    count = nodes.count()
    radius = radius or radii(count)
    n_masks = len(_families(radius))
    n_waves = math.ceil(n_masks / WAVE)
    cuts = [n_masks * k // n_waves for k in range(n_waves + 1)]
    found = []
    for wave in map(range, cuts, cuts[1:]):
        shards = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(18 * count * len(wave) / SHARD_BYTES))
        found.append(written(_edges(nodes, shards, radius, accept, wave), "near"))
        freed(docs.sparkSession)
    edges = written(reduce(DataFrame.union, found).distinct(), "near")
    for part in found:
        dropped(part)
    rep = nodes.select("a", "b", "rep")
    ends = edges.join(rep.select(F.col("a").alias("a1"), F.col("b").alias("b1"), F.col("rep").alias("x")), ["a1", "b1"])
    ends = ends.join(rep.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("rep").alias("y")), ["a2", "b2"])
    # An id whose rows hold several texts has several nodes; they are one document, and so one node here.
    roots = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    grouped = nodes.join(roots, nodes.rep == roots.node, "left").select("a", "b", F.coalesce("root", "rep").alias("root"), "copies")
    sizes = grouped.groupBy("root").agg(F.sum("copies").alias("n"))
    return prints.join(grouped.join(sizes, "root").select("a", "b", "root", "n"), ["a", "b"]).select("id", "root", "n")


def near_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", radius: tuple[int, ...] | None = None, accept: int = ACCEPT) -> DataFrame:
    """The rows of docs less all but one document of each near-duplicate group, and n_near, the size of its group.

    The document of the smallest id stays. Bytes that are no UTF-8 count as replacement characters, which are no letters.
    In a text with a word of more than 24 characters such words, as of Chinese or encoded data, count by pieces of 6.
    Documents without any word, with a null text or a null id are near to none and
    stay with n_near 1. Rows that repeat an id with the same or another text stand for one document: they stay or go
    together, and go if any of its texts is near to a document of a smaller id. An empty table gives an empty table;
    other columns are carried along; a column named n_near, in any case of letters, is replaced.
    """
    docs = without(docs, "n_near")
    node, goes, near = fresh(docs, "id", "goes", "n_near")
    groups = near_groups(docs, text, id_col, radius, accept)
    fate = groups.groupBy("id").agg(F.max(F.col("root") < F.col("id")).alias(goes), F.max("n").alias(near)).where(f"`{goes}` or `{near}` > 1")
    fate = written(fate.withColumnRenamed("id", node), "fates")
    # Merged at every size: a broadcast would be bounded by nothing but Spark's limit.
    joined = docs.join(fate.hint("merge"), F.col(f"`{id_col}`") == fate[node], "left")
    kept = joined.where(~F.coalesce(F.col(goes), F.lit(False)))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(near), F.lit(1).cast("bigint")).alias(near))
