"""LM scoring by deleted interpolation (operator 7).

A word's probability mixes the maximum-likelihood estimates of n-grams of all orders, down to the uniform one. The
counts are those of the whole corpus less the document's own, so every document is held out of what scores it. The
mixture weights belong to buckets of how frequent the context is, and are learned by expectation-maximisation on these
held-out counts of all documents.

Documents are taken in batches. A batch sends each of its distinct n-grams once, as 64-bit hashes, to the shard that the
hash names; the shard adds up all batches' counts and returns to each the totals of what it sent, in the order sent. So
what is counted and what is looked up travel together. Estimates are kept in eighths of an octave: that makes the
held-out counts a histogram of bounded size, on which the driver runs the iterations: an estimate is no less than one
in the number of words, so of N words there are log2(N) buckets and 8 log2(N) values of each estimate at most, which
makes 13 million codes at order 2 for N = 2^45.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.llm.shared import dropped, readable, split_words, written

#: The longest n-grams.
ORDER = 2
#: Characters in a batch.
BATCH_CHARS = 2_000_000
#: Bytes of n-grams that a shard should hold.
SHARD_BYTES = 16 << 20
#: Steps in an octave to which estimates are rounded.
STEPS = 8
ITERATIONS = 40

_EDGE = np.array([0x5BD1E995, 0x27D4EB2F], np.uint64)  # begin and end of a document
_SCALE = 1 << 10
#: Context counts have buckets by their octave, and one for none.
_BUCKETS = 64


class _Numbers(dict):
    """Words to numbers, in the order in which they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, compressed: high planes of small numbers vanish."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def _unsqueezed(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def words(text: str | None) -> list[str]:
    return split_words(text.lower()) if text else []


def _tokenised(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each batch: ids, numbers of words, distinct words' hashes and where in them each word is."""
    part, at = TaskContext.get().partitionId(), 0
    names = ["batch", "ids", "lens", "vocabulary", "tokens"]

    def row() -> pa.RecordBatch:
        tokens = np.concatenate(flat)
        vocabulary = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, numbers)), ">u8").astype(np.uint64)
        # Frequent words get small numbers.
        order = np.argsort(-np.bincount(tokens, minlength=len(vocabulary)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        values = [[(part << 32) | at], [ids], [lens], [vocabulary[order].tobytes()], [_squeezed(rank[tokens])]]
        kinds = [pa.int64(), pa.list_(kind), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    ids, lens, flat, chars, numbers = [], [], [], 0, _Numbers()
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = words(t)
            ids.append(i)
            lens.append(len(found))
            flat.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
            chars += len(t or "") + 50
            if chars >= BATCH_CHARS:
                yield row()
                at += 1
                ids, lens, flat, chars, numbers = [], [], [], 0, _Numbers()
    if ids:
        yield row()


class _Grams:
    """The n-grams of a batch. x: the words of the documents that have any, each between two edges; doc: whose they are.

    keys[o]: the key of the o-gram that ends at each place; those at the first o - 1 places of a document are unusable.
    The two lowest bits of a key tell its order.
    """

    def __init__(self, lens: np.ndarray, vocabulary: bytes, tokens: bytes, order: int) -> None:
        self.docs = np.flatnonzero(lens)
        n = lens[self.docs]
        size = int(n.sum() + 2 * len(n))
        self.doc = np.repeat(np.arange(len(n)), n + 2)
        starts = np.cumsum(n + 2) - (n + 2)
        x = np.zeros(size, np.uint64)
        inner = np.ones(size, bool)
        inner[starts] = inner[starts + n + 1] = False
        x[inner] = np.frombuffer(vocabulary, np.uint64)[_unsqueezed(tokens, np.uint32)]
        x[starts], x[starts + n + 1] = _EDGE[0], _EDGE[1]
        self.place = np.arange(size) - np.repeat(starts, n + 2)
        self.words = n + 1  # words to predict, with the end
        self.keys, raw = [None], np.zeros(size, np.uint64)
        for o in range(1, order + 1):
            before = np.concatenate([[np.uint64(0)], raw[:-1]]) if o > 1 else np.zeros(size, np.uint64)
            raw = _mix(before * np.uint64(3) + x) if o > 1 else _mix(x)
            self.keys.append((raw & ~np.uint64(3)) | np.uint64(o))

    def usable(self, o: int) -> np.ndarray:
        return self.place >= o - 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([k[self.usable(o)] for o, k in enumerate(self.keys) if o] or [np.zeros(0, np.uint64)])
        return np.unique(every, return_counts=True)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _packed(counts: np.ndarray) -> bytes:
    """A byte for each count; those of 255 and more follow in eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.uint64).tobytes()


def _unpacked(blob: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(blob, np.uint8, n).astype(np.uint64)
    out[out == 255] = np.frombuffer(blob, np.uint64, -1, n) if len(blob) > n else []
    return out


def _sent(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys, as the steps from one to the next, and their counts."""
    steps = _squeezed(np.diff(keys, prepend=np.uint64(0)))
    return np.uint32(len(steps)).tobytes() + steps + _packed(counts)


def _received(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, np.uint32, 1)[0])
    keys = np.cumsum(_unsqueezed(blob[4 : 4 + n], np.uint64), dtype=np.uint64)
    return keys, _unpacked(blob[4 + n :], len(keys))


def _counts(order: int, shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b, lens, vocabulary, tokens in zip(*(batch.column(i).to_pylist() for i in range(4))):
            keys, counts = _Grams(np.array(lens, np.int64), vocabulary, tokens, order).distinct()
            cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1)).tolist()
            rows = [(s, lo, hi) for s, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
            blobs = [_sent(keys[lo:hi], counts[lo:hi]) for _, lo, hi in rows]
            columns = [pa.array([s for s, *_ in rows], pa.int32()), pa.array([b] * len(rows), pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "batch", "blob"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard. For each, the totals; and in a row of batch -1 the number of distinct words."""

    def add(shard: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        each = [_received(x) for _, x in rows]
        ns = [len(k) for k, _ in each]
        keys, counts = (np.concatenate(x) for x in zip(*each))
        distinct, at = np.unique(keys, return_inverse=True)
        sums = np.bincount(at, counts.astype(np.float64)).astype(np.uint64)[at]
        cuts = np.cumsum([0, *ns]).tolist()
        blobs = [_packed(sums[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]
        known = int(((distinct & np.uint64(3)) == 1).sum())
        n = len(rows)
        columns = [pa.array([b for b, _ in rows] + [-1], pa.int64()), pa.array([shard] * (n + 1), pa.int32()), pa.array([*blobs, None], pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, pa.array([0] * n + [known], pa.int64())], names=["batch", "shard", "blob", "known"])

    last, rows = None, []
    for batch in batches:
        for shard, b, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if shard != last and rows:
                yield add(last, rows)
                rows = []
            last = shard
            rows.append((b, blob))
    if rows:
        yield add(last, rows)


def quantised(p: np.ndarray) -> np.ndarray:
    """Probabilities as whole numbers: 0 for 0, else 1 and so many steps below 1."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.minimum(np.rint(-STEPS * np.log2(np.where(p > 0, p, 1))), _SCALE - 2), 0).astype(np.int64)


def restored(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, np.exp2((1 - q) / STEPS), 0.0)


def bucket(contexts: np.ndarray) -> np.ndarray:
    """The octave of a context's count, from 1; 0 for none."""
    return np.where(contexts > 0, 1 + np.floor(np.log2(np.maximum(contexts, 1))), 0).astype(np.int64)


def codes(estimates: list[np.ndarray], contexts: np.ndarray) -> np.ndarray:
    """One number of the context's bucket and the estimates, from the longest n-gram's to the word's own."""
    out = bucket(contexts)
    for p in estimates:
        out = out * _SCALE + quantised(p)
    return out


def _events(kind: pa.DataType, order: int, shards: int, n_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by batch and shard; the batch's words are under shard -1. The codes of each document's words."""

    def one(words_row: tuple, blobs: list[tuple[int, bytes]]) -> pa.RecordBatch:
        ids, lens, vocabulary, tokens = words_row
        lens = np.array(lens, np.int64)
        grams = _Grams(lens, vocabulary, tokens, order)
        keys, _ = grams.distinct()
        totals = np.zeros(len(keys), np.uint64)
        cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1)).tolist()
        for shard, blob in blobs:
            lo, hi = cuts[shard], cuts[shard + 1]
            totals[lo:hi] = _unpacked(blob, hi - lo)
        kept = []
        for o in range(1, order + 1):
            usable = grams.usable(o)
            at = np.searchsorted(keys, grams.keys[o][usable])
            _, inverse, own = np.unique(grams.doc[usable] * np.int64(len(keys) + 1) + at, return_inverse=True, return_counts=True)
            counts = np.zeros(len(usable))
            counts[usable] = totals[at].astype(np.float64) - own[inverse]
            kept.append(counts)
        predicted = grams.usable(2)
        others = (n_words - grams.words)[grams.doc]
        estimates, top = [], np.zeros(len(others))
        for o in range(order, 0, -1):
            context = np.concatenate([[0.0], kept[o - 2][:-1]]) if o > 1 else others.astype(np.float64)
            context = np.where(grams.usable(o), context, 0.0)
            if o == order:
                top = context if o > 1 else np.zeros(len(others))
            estimates.append(np.where(context > 0, kept[o - 1] / np.maximum(context, 1), 0.0)[predicted])
        found = codes(estimates, top[predicted])
        doc = grams.doc[predicted]
        rows = np.lexsort((found, doc))
        found, doc = found[rows], doc[rows]
        new = np.concatenate([[True], (np.diff(found) != 0) | (np.diff(doc) != 0)]) if len(found) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        times = np.diff(np.concatenate([first, [len(found)]]))
        bounds = np.searchsorted(doc[first], np.arange(len(grams.docs) + 1)).tolist()
        out: list = [(None, None)] * len(ids)
        for d, lo, hi in zip(grams.docs.tolist(), bounds, bounds[1:]):
            out[d] = found[first[lo:hi]].tobytes(), times[lo:hi].astype(np.uint32).tobytes()
        columns = [pa.array(ids, kind), pa.array(lens, pa.int32()), pa.array([c for c, _ in out], pa.binary()), pa.array([n for _, n in out], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "codes", "times"])

    last, row, blobs = None, None, []
    for batch in batches:
        for b, shard, ids, lens, vocabulary, tokens, blob in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if b != last and row:
                yield one(row, blobs)
                row, blobs = None, []
            last = b
            if shard < 0:
                row = ids, lens, vocabulary, tokens
            else:
                blobs.append((shard, blob))
    if row:
        yield one(row, blobs)


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, times = np.zeros(0, np.int64), np.zeros(0)
    for batch in batches:
        more = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist() if x]
        n = [np.frombuffer(x, np.uint32).astype(np.float64) for x in batch.column(1).to_pylist() if x]
        found, at = np.unique(np.concatenate([found, *more]), return_inverse=True)
        times = np.bincount(at, np.concatenate([times, *n]), len(found))
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times.astype(np.int64))], names=["code", "n"])


def components(code: np.ndarray, order: int, uniform: float) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, estimates of the mixture by column, the uniform one last)."""
    parts = []
    for _ in range(order):
        code, q = np.divmod(code, _SCALE)
        parts.append(restored(q))
    return code, np.stack([*reversed(parts), np.full(len(code), uniform)], axis=1)


def fit(code: np.ndarray, times: np.ndarray, order: int, uniform: float, iterations: int = ITERATIONS) -> np.ndarray:
    """Mixture weights by bucket, by expectation-maximisation on the held-out counts. Buckets that never occur mix evenly."""
    buckets, p = components(code, order, uniform)
    weights = np.full((_BUCKETS, order + 1), 1 / (order + 1))
    for _ in range(iterations):
        share = weights[buckets] * p
        share *= (times / share.sum(axis=1))[:, None]
        sums = np.stack([np.bincount(buckets, share[:, k], _BUCKETS) for k in range(order + 1)], axis=1).astype(np.float64)
        # The uniform estimate keeps a little weight: no word is impossible.
        sums[:, -1] += 1e-6
        weights = np.where(np.bincount(buckets, times, _BUCKETS)[:, None] > 0, sums / np.maximum(sums.sum(axis=1), 1e-300)[:, None], weights)
    return weights


def _scores(order: int, uniform: float, weights: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        logs = []
        for found, times in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if found is None:
                logs.append(None)
                continue
            buckets, p = components(np.frombuffer(found, np.int64), order, uniform)
            logs.append(float((np.frombuffer(times, np.uint32) * np.log2((weights[buckets] * p).sum(axis=1))).sum()))
        perplexity = [x if x is None else 2 ** (-x / (n + 1)) for x, n in zip(logs, batch.column(1).to_pylist())]
        columns = [batch.column(0), batch.column(1), pa.array(logs, pa.float64()), pa.array(perplexity, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[0], "n_words", "log2_prob", "perplexity"])


def score(docs: DataFrame, text: str = "text", id_col: str = "doc_id", order: int = ORDER) -> DataFrame:
    """(id_col, n_words, log2_prob, perplexity) for each row of docs.

    log2_prob is that of the words and the end of the document; perplexity is per word, the end included. A null text, or
    one without words, has null scores, and adds to no count. Bytes that are no UTF-8 count as replacement characters, which
    are no letters. Ids of any type are carried, null ones too. Repeated rows are documents of their
    own: each is scored with the counts of the others. Texts are counted and scored whole; other columns aren't carried.
    An empty table gives no rows.
    """
    if order not in (1, 2, 3):
        raise ValueError("order must be 1, 2 or 3")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), readable(F.col(f"`{text}`")).alias("t"))
    kind = source.schema["id"].dataType
    ids = kind.simpleString()
    staged = written(source.mapInArrow(lambda x: _tokenised(to_arrow_type(kind), x), f"batch bigint, ids array<{ids}>, lens array<int>, vocabulary binary, tokens binary"), "words")
    size = staged.select(F.sum(F.expr("aggregate(lens, 0L, (n, x) -> n + x)")), F.sum(F.expr("aggregate(lens, 0L, (n, x) -> n + if(x > 0, x + 1, 0))"))).first()
    tokens, n_words = int(size[0] or 0), int(size[1] or 0)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    shards = max(cores, math.ceil(9 * tokens * order / SHARD_BYTES))
    sent = staged.select("batch", "lens", "vocabulary", "tokens").mapInArrow(lambda x: _counts(order, shards, x), "shard int, batch bigint, blob binary")
    totals = sent.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_totals, "batch bigint, shard int, blob binary, known bigint")
    totals = written(totals, "totals")
    uniform = 1 / (1 + (totals.agg(F.sum("known")).first()[0] or 0))
    back = staged.select("batch", F.lit(-1).alias("shard"), "ids", "lens", "vocabulary", "tokens", F.lit(None).cast("binary").alias("blob")).unionByName(
        totals.where("batch >= 0").drop("known"), allowMissingColumns=True
    )
    tasks = max(cores, math.ceil(8 * tokens / SHARD_BYTES))
    events = back.repartition(tasks, "batch").sortWithinPartitions("batch", "shard")
    events = events.mapInArrow(lambda x: _events(to_arrow_type(kind), order, shards, n_words, x), f"id {ids}, n_words int, codes binary, times binary")
    events = written(events, "events")
    dropped(totals)
    dropped(staged)
    counted = events.select("codes", "times").mapInArrow(_histogram, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = counted["code"].to_numpy(), counted["n"].to_numpy()
    by_code = np.argsort(code)
    weights = fit(code[by_code], n[by_code].astype(np.float64), order, uniform)
    schema = f"`{id_col}` {ids}, n_words int, log2_prob double, perplexity double"
    named = events.withColumnRenamed("id", id_col)
    return named.mapInArrow(lambda x: _scores(order, uniform, weights, x), schema)
