"""Best-fit packing (operator 6): pattern packing by non-negative least squares.

Documents longer than a sequence are cut into whole sequences and a rest. Lengths are counted in a histogram of UNITS
bins. Patterns are all multisets of at most MAX_PARTS bins that fill a sequence exactly; non-negative least squares fit
how often each is repeated to the histogram, and the repeats are rounded down. What the patterns leave is packed by
best fit, longest first, on the counts: each step adds one length to many equal sequences. So the plan's size depends on
UNITS alone. Spark then gives each document its rank among those of its bin, and the plan maps ranges of ranks to
ranges of sequences.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.shared import readable, written

#: Characters in a sequence.
CAPACITY = 8192
#: Bins of the histogram; lengths are rounded up to multiples of CAPACITY / UNITS.
UNITS = 64
#: Documents in a pattern at most.
MAX_PARTS = 4
#: Pieces of one bin that a task ranks, about, at most.
RANK_ROWS = 4_000
#: Characters of such pieces, about.
RANK_CHARS = 8_000_000


def patterns(units: int = UNITS, parts: int = MAX_PARTS) -> list[tuple[int, ...]]:
    """All multisets of at most so many bins of 1 to units that add up to units, each from large to small."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], rest: int) -> None:
        if not rest:
            out.append(head)
        elif len(head) < parts:
            for x in range(min(rest, head[-1] if head else units), 0, -1):
                if x * (parts - len(head)) >= rest:
                    extend((*head, x), rest - x)

    extend((), units)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active sets of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = tolerance * max(1.0, np.abs(a.T @ b).max(initial=0))
    for _ in range(3 * n):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= scale:
            break
        active[best] = True
        while True:
            s = np.zeros(n)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            bad = active & (s <= 0)
            if not bad.any():
                break
            step = (x[bad] / np.maximum(x[bad] - s[bad], 1e-300)).min()
            x += step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
        x = s
    return x


def plan(histogram: dict[int, int], units: int = UNITS, parts: int = MAX_PARTS) -> list[tuple[tuple[int, ...], int]]:
    """(bins of a sequence, how many such sequences), which take each bin exactly as often as the histogram has it."""
    left = np.array([histogram.get(b, 0) for b in range(1, units + 1)], np.int64)
    out: Counter = Counter()
    if left.sum():
        known = patterns(units, parts)
        a = np.zeros((units, len(known)))
        for j, pattern in enumerate(known):
            for b in pattern:
                a[b - 1, j] += 1
        # Long documents leave the largest holes: they weigh more.
        weight = np.sqrt(np.arange(1, units + 1) / units)
        x = nnls(a * weight[:, None], left / left.sum() * weight) * left.sum()
        for j in np.argsort(-x, kind="stable").tolist():
            need = Counter(known[j])
            n = min(int(x[j] + 1e-6), *(int(left[b - 1]) // k for b, k in need.items()))
            if n > 0:
                out[known[j]] += n
                for b, k in need.items():
                    left[b - 1] -= n * k
    open_: list[Counter] = [Counter() for _ in range(units + 1)]  # by what is still free
    for b in range(units, 0, -1):
        n = int(left[b - 1])
        while n:
            free = next((f for f in range(b, units + 1) if open_[f]), None)
            if free is None:
                # The k-fold sequence of one length, then its rest.
                k = units // b
                if full := n // k:
                    open_[units - k * b][(b,) * k] += full
                if rest := n % k:
                    open_[units - rest * b][(b,) * rest] += 1
                break
            pattern, count = open_[free].popitem()
            take = min(n, count)
            if count > take:
                open_[free][pattern] = count - take
            open_[free - b][(*pattern, b)] += take
            n -= take
    for group in open_:
        out.update(group)
    return sorted(out.items())


def _ranges(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(bin, first rank, end, first sequence, place): ranks of a bin that fill a place in successive sequences."""
    at: Counter = Counter()
    out, sequence = [], 0
    for pattern, n in planned:
        for place, b in enumerate(pattern):
            out.append((b, at[b], at[b] + n, sequence, place))
            at[b] += n
        sequence += n
    return out


def _locator(ranges: list[tuple[int, int, int, int, int]]):
    """(bin, rank) to (sequence, place), as a function of Spark columns."""
    ranges = sorted(ranges)
    starts = np.array([(b << 48) | lo for b, lo, *_ in ranges], np.int64)
    shift = np.array([s - lo for _, lo, _, s, _ in ranges], np.int64)
    place = np.array([p for *_, p in ranges], np.int32)

    @F.pandas_udf("sequence bigint, place int")
    def locate(bins, ranks):
        import pandas as pd

        at = np.searchsorted(starts, (bins.to_numpy(np.int64) << 48) | ranks.to_numpy(np.int64), "right") - 1
        return pd.DataFrame({"sequence": ranks.to_numpy(np.int64) + shift[at], "place": place[at]})

    return locate


def pack(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, units: int = UNITS, parts: int = MAX_PARTS
) -> DataFrame:
    """(sequence_id, n_chars, doc_ids, starts, texts): the sequences, and what each holds, in order.

    texts has the pieces of text, doc_ids their documents and starts where in the document each begins, in characters.
    Every character of every document is in one piece. Pieces of a sequence have capacity characters at most in all.
    Bytes that are no UTF-8 become replacement characters. Null and empty texts are in no sequence; null ids are carried; repeated rows are packed each; other columns aren't
    carried. An empty table gives no sequences. Equal input gives equal sequences.
    """
    if capacity % units:
        raise ValueError("capacity must be a multiple of units")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), readable(F.col(f"`{text}`")).alias("text")).where(F.length("text") > 0)
    unit = capacity // units
    whole = F.expr(f"sequence(0L, (length(text) - 1L) div {capacity})")
    length = F.least(F.length("text") - F.col("start"), F.lit(capacity))
    bin_ = F.ceil(length / unit).cast("int")
    # Only lengths are read and counted here.
    lengths = source.select(F.length("text").alias("n"))
    full = F.expr(f"(n - 1) div {capacity}")
    counted = lengths.groupBy(full.cast("bigint").alias("full"), F.ceil((F.col("n") - full * capacity) / unit).cast("int").alias("bin")).agg(F.count("*").alias("k"))
    counted = counted.groupBy("bin").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("full")).alias("full")).collect()
    histogram = Counter({r["bin"]: r["k"] for r in counted})
    histogram[units] += sum(r["full"] for r in counted)
    ranges = _ranges(plan(histogram, units, parts))
    # As many shares for each bin as its pieces need by number, and by characters if they are long ones.
    shares = {b: max(1, math.ceil(n / RANK_ROWS), math.ceil(n * b * unit / RANK_CHARS)) for b, n in histogram.items()}

    # A long text is cut in four bytes a character, where a place is found at once. Java would take a mark of the byte
    # order at the beginning of a piece as no text: a space goes before it.
    wide = F.when(F.length("text") > capacity, F.encode("text", "UTF-32"))
    rows = source.select("doc_id", "text", wide.alias("wide"), F.explode(whole).alias("k"))
    rows = rows.select("doc_id", (F.col("k") * capacity).cast("int").alias("start"), "text", "wide")
    cut = F.expr(f"substring(decode(concat(X'00000020', substring(wide, 4 * start + 1, 4 * {capacity})), 'UTF-32'), 2, {capacity})")
    rows = rows.select("doc_id", "start", bin_.alias("bin"), F.when(F.col("wide").isNull(), F.col("text")).otherwise(cut).alias("text"))
    of_bin = F.element_at(F.array(*[F.lit(shares.get(b, 1)) for b in range(1, units + 1)]), F.col("bin"))
    # Bins are ranked in shares, so that no task ranks all of a bin; each share starts where those before it end.
    rows = rows.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", "text"), of_bin).cast("int"))
    if max(shares.values()) == 1:
        rows = rows.withColumn("first", F.lit(0).cast("bigint"))
    else:
        # Counted in a scan of its own: cheaper than to write the pieces.
        sizes = rows.groupBy("bin", "share").agg(F.count("*").alias("size"))
        first = sizes.withColumn("first", F.sum("size").over(Window.partitionBy("bin").orderBy("share")) - F.col("size")).drop("size")
        # units x shares rows; below Spark's own limit it is broadcast, else joined on the keys that the window needs too.
        rows = rows.join(written(first, "shares"), ["bin", "share"])
    order = Window.partitionBy("bin", "share").orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start", F.xxhash64("text"))
    ranked = rows.withColumn("rank", F.row_number().over(order) - 1 + F.col("first"))
    placed = ranked.select("doc_id", "start", "text", _locator(ranges)("bin", "rank").alias("at"))
    placed = placed.select("doc_id", "start", "text", F.col("at.sequence").alias("sequence_id"), F.col("at.place").alias("place"))
    packed = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("place", "doc_id", "start", "text"))).alias("p"))
    chars = F.aggregate("p", F.lit(0), lambda n, x: n + F.length(x["text"]))
    return packed.select(
        "sequence_id",
        chars.alias("n_chars"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.start").alias("starts"),
        F.col("p.text").alias("texts"),
    )
