"""Quality classifier: ordinal cumulative-link regression on graded ratings (operator 3).

P(grade <= k) = sigmoid(theta[k] - z), where z is a sum of weights that all grades share and theta is ordered. The
weights belong to hashed features of the whole text: each distinct word, and marks for how much of the text is
capitals, symbols, repeated words, repeated word triples or repeated lines. The model is fitted on the driver, on at
most MAX_ROWS labelled documents; scoring reads each document once, in Arrow batches.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.shared import fresh, readable, split_words, without

#: Labelled documents that the model is fitted on at most: those whose ids have the smallest hashes.
MAX_ROWS = 15_000
#: Grades are 0 to GRADES - 1.
GRADES = 3
#: A document is selected if its probability of at least this grade ...
MIN_GRADE = 2
#: ... is at least this.
MIN_TAIL = 0.5
#: Hashed weights.
BUCKETS = 1 << 18
#: A feature needs so many of the fitted documents to get a weight.
MIN_DOCS = 3
#: A feature's score against the thresholds alone needs so many standard deviations.
MIN_SCORE = 3.5
#: Weight of a document of a rare grade at most.
RARE = 3.0
#: Passes of gradient descent, and the L2 penalty on the weights.
STEPS = 150
RIDGE = 2e-4

SCHEMA = "expected_grade double, p_tail double"


def features(text: str) -> set[str]:
    tokens = text.split()
    found = split_words(text.lower())
    out = set(found)
    n = len(tokens)
    if not n:
        return {"<empty>"}
    lines = text.split("\n")
    shares = {
        "upper": sum(map(str.isupper, tokens)) / n,
        "symbols": 1 - sum(map(len, found)) / sum(map(len, tokens)),
        "again": sum(map(operator.eq, tokens, tokens[1:])) / n,
        "triples": 1 - len(set(zip(found, found[1:], found[2:]))) / max(1, len(found) - 2),
        "lines": 1 - len(set(lines)) / len(lines),
    }
    for name, share in shares.items():
        out.update(f"<{name}>{step}" for step in (2, 5, 10, 20, 30, 50, 70, 90) if 100 * share >= step)
    return out


def slots(text: str | None) -> np.ndarray:
    """The places of a text's features in the weights, ascending, each once."""
    digests = b"".join(map(xxhash.xxh3_64_digest, features(text or "")))
    return np.unique((np.frombuffer(digests, ">u8") % BUCKETS).astype(np.int64))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [slots(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["grade", "slots"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """(weights, theta) by Adam on the mean log likelihood. theta is kept ordered: its gaps are exponentials.

    Each grade is counted once more than it occurs, so that theta is defined whatever grades there are; no rows give
    weights 0.
    """
    weights = np.zeros(BUCKETS)
    counts = np.bincount(grades, minlength=GRADES) + 1.0
    below = np.cumsum(counts)[:-1] / counts.sum()
    theta = np.log(below / (1 - below))
    if not len(rows):
        return weights, theta
    flat = np.concatenate(rows)
    used, flat = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # Rare grades weigh more, up to so many times as much as the commonest.
    weight = np.minimum(counts.max() / counts, RARE)[grades]
    # Screening: the scores of single features against the model of thresholds alone.
    edges = _sigmoid(np.concatenate([[-np.inf], theta, [np.inf]]))
    residual = weight * (1 - edges[grades] - edges[grades + 1])
    residual -= residual.mean()
    docs = np.bincount(flat)
    enough = (docs >= MIN_DOCS) & (np.abs(np.bincount(flat, residual[row])) >= MIN_SCORE * np.sqrt(docs * residual.var()))
    pick = enough[flat]
    row, flat = row[pick], (np.cumsum(enough) - 1)[flat[pick]]
    used = used[enough]
    w = np.zeros(len(used))
    raw = np.concatenate([theta[:1], np.log(np.diff(theta))])
    m, v = np.zeros(len(w) + len(raw)), np.zeros(len(w) + len(raw))
    for step in range(1, steps + 1):
        _, gw, graw = likelihood(w, raw, row, flat, grades, weight, ridge)
        g = np.concatenate([gw, graw])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w, raw = w - move[: len(w)], raw - move[len(w) :]
    weights[used] = w
    return weights, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def likelihood(
    w: np.ndarray, raw: np.ndarray, row: np.ndarray, flat: np.ndarray, grades: np.ndarray, weight: np.ndarray, ridge: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean weighted negative log likelihood with its penalty, and its gradients by w and raw.

    row and flat: which document has which weight. theta is the sum of raw[0] and the exponentials of raw's others.
    """
    n = len(grades)
    theta = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
    z = np.bincount(row, w[flat], n)
    edges = np.concatenate([[-np.inf], theta, [np.inf]])
    hi, lo = _sigmoid(edges[grades + 1] - z), _sigmoid(edges[grades] - z)
    p = np.maximum(hi - lo, 1e-12)
    dhi, dlo = weight * hi * (1 - hi) / p, weight * lo * (1 - lo) / p
    gw = np.bincount(flat, (dhi - dlo)[row], len(w)) / n + ridge * w
    gt = np.array([(-dhi[grades == k]).sum() + dlo[grades == k + 1].sum() for k in range(GRADES - 1)]) / n
    graw = np.concatenate([[gt.sum()], [gt[k:].sum() * np.exp(raw[k]) for k in range(1, len(raw))]])
    return float(-(weight * np.log(p)).sum() / n + ridge / 2 * (w * w).sum()), gw, graw


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The model of labelled documents. Grade 0: quality 0; 1: quality 1 but toxic; 2: quality 1 and not toxic.

    An id labelled several times counts with its lowest quality and highest toxicity. Labels with a null are left out, a
    null text counts as empty. max_rows bounds the ids whose documents are read, and so what reaches the driver.
    """
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    grade = F.when(F.col("q") <= 0, 0).when(F.col("t") > 0, 1).otherwise(2)
    some = known.select(F.col("doc_id").alias("id"), grade.alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    joined = docs.select(F.col("doc_id").alias("id"), readable(F.col("text")).alias("text")).join(F.broadcast(some), "id").select("id", "text", "grade")
    found = joined.select("text", "grade").mapInArrow(_featured, "grade int, slots array<int>").toArrow()
    grades, lists = found["grade"].to_numpy(), found["slots"].combine_chunks()
    values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    rows = [values[lo:hi] for lo, hi in zip(ends, ends[1:])]
    # In an order of its own: sums of floats must not depend on how tasks end.
    order = sorted(range(len(rows)), key=lambda i: (grades[i], rows[i].tobytes()))
    return fit_rows([rows[i] for i in order], grades[order].astype(np.int64))


def predict(texts: list[str | None], weights: np.ndarray, theta: np.ndarray, min_grade: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, the expected grade and the probability of at least min_grade."""
    z = np.array([weights[slots(t)].sum() for t in texts])
    tail = 1 - _sigmoid(theta[None, :] - z[:, None])
    return tail.sum(axis=1), tail[:, min_grade - 1] if min_grade else np.ones(len(z))


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_grade: int = MIN_GRADE, text: str = "text") -> DataFrame:
    """The rows of docs with expected_grade and p_tail, the probability of at least min_grade.

    A null text is scored like an empty one; bytes that are no UTF-8 as replacement characters. Repeated rows get equal
    scores. Columns named expected_grade or p_tail, in any case of letters, are replaced. Texts are scored whole.
    """
    docs = without(docs, "expected_grade", "p_tail")
    # Broadcast: BUCKETS weights, whatever the size of the input.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCHEMA)
    def score(texts):
        import pandas as pd

        expected, tail = predict(texts.tolist(), *shared.value, min_grade)
        return pd.DataFrame({"expected_grade": expected, "p_tail": tail})

    (box,) = fresh(docs, "score")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    made = docs.select(*columns, score(readable(F.col(f"`{text}`"))).alias(box))
    return made.select(*columns, F.col(f"{box}.expected_grade"), F.col(f"{box}.p_tail"))


def select(
    docs: DataFrame, labels: DataFrame, min_grade: int = MIN_GRADE, min_tail: float = MIN_TAIL, max_rows: int = MAX_ROWS
) -> DataFrame:
    """The scored rows of docs whose p_tail is at least min_tail. An empty table gives an empty table."""
    return scored(docs, fit(docs, labels, max_rows), min_grade).where(F.col("p_tail") >= min_tail)
