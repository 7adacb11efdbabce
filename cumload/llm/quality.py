"""Quality classifier: naive Bayes features under a linear support vector machine (operator 8).

A text's n-gram indicators are scaled by the log-count ratios of the classes;
a linear hinge-loss model over them is fitted by dual coordinate descent.
N-grams are byte trigrams, and runs of one to five repeats in the stream that
marks each word as equal to the word before it or not.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed byte trigrams, then one indicator for each length of a run of repeated words.
TRIGRAM_BITS, RUNS = 18, 5
SIZE = (1 << TRIGRAM_BITS) + RUNS


def indicators(data: bytes, table: np.ndarray) -> np.ndarray:
    """Sorted indices of the n-grams that a UTF-8 text holds. ``table``: SIZE zeros, left as they were."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(b) >= 3:
        grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        table[(grams * np.uint32(2654435761)) >> np.uint32(32 - TRIGRAM_BITS)] = 1
    words = data.split()
    same = list(map(operator.eq, words, words[1:]))
    if True in same:
        longest = max(sum(1 for _ in run) for equal, run in groupby(same) if equal)
        table[(1 << TRIGRAM_BITS) : (1 << TRIGRAM_BITS) + min(longest, RUNS)] = 1
    found = np.flatnonzero(table)
    table[found] = 0
    return found


@dataclass
class Model:
    """Weights of indicators (ratio times hinge weight), the ratios, an intercept, and the slope and shift of the score."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        length = float(np.sqrt((self.ratios[found] ** 2).sum()))
        return float(self.weights[found].sum()) / (length or 1.0) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def log_count_ratios(rows: Sequence[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of (share of an n-gram in class 1) / (share in class 0)."""
    counts = np.full((2, SIZE), smoothing)
    for found, label in zip(rows, positive, strict=True):
        counts[int(label), found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0]).astype(np.float32)


def fit(rows: Sequence[np.ndarray], positive: np.ndarray, *, cost: float = 10.0, passes: int = 12, seed: int = 3) -> Model:
    """Dual coordinate descent (Hsieh et al., 2008) for the hinge loss, on unit-length scaled indicators and a constant."""
    ratios = log_count_ratios(rows, positive)
    values = [ratios[f] / (float(np.sqrt((ratios[f] ** 2).sum())) or 1.0) for f in rows]
    y = np.where(positive, 1.0, -1.0)
    share = max(positive.mean(), 1e-9), max(1 - positive.mean(), 1e-9)
    limit = np.where(positive, cost * 0.5 / share[0], cost * 0.5 / share[1])
    square = np.array([float((v * v).sum()) + 1.0 for v in values])
    alpha, w, bias, rng = np.zeros(len(rows)), np.zeros(SIZE, dtype=np.float32), 0.0, np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            f, v = rows[i], values[i]
            slope = y[i] * (float(w[f] @ v) + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), limit[i])
            if step := (new - alpha[i]) * y[i]:
                w[f] += np.float32(step) * v
                bias += step
                alpha[i] = new
    return Model(w * ratios, ratios, bias)


def calibrated(model: Model, margins: np.ndarray, positive: np.ndarray, steps: int = 200) -> Model:
    """Give the model the logistic slope and shift that fit rows it was not fitted on (both classes weigh alike)."""
    if len(margins) == 0 or positive.all() or not positive.any():
        return model
    weight = np.where(positive, 0.5 / positive.mean(), 0.5 / (1 - positive.mean())) / len(margins)
    a, b = 4.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        error, curve = weight * (p - positive), weight * p * (1 - p) + 1e-9
        g = np.array([(error * margins).sum() + 1e-3 * a, error.sum() + 1e-3 * b])
        h = np.array([[(curve * margins**2).sum() + 1e-3, (curve * margins).sum()], [(curve * margins).sum(), curve.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
    return Model(model.weights, model.ratios, model.bias, max(a, 0.1), b)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, sample_per_class: int = 3000, label: str = "quality", seed: int = 3) -> Model:
    """Fit on a bounded sample: the ``sample_per_class`` labelled documents of each class that hash lowest.

    ``labels`` (doc_id, quality) must leave out what is held out. Null labels
    and null ids are not used; of several labels of a document the lowest
    counts. With one class or none the model knows no n-gram, and every score
    is that of the class (0.5 without labels).
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"))
    order = [F.xxhash64("doc_id", F.lit(seed)), "doc_id"]
    picked = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(*order).limit(sample_per_class).collect()]
    if not picked:
        return Model(np.zeros(SIZE, dtype=np.float32), np.zeros(SIZE, dtype=np.float32), 0.0)
    sample = docs.sparkSession.createDataFrame([(r.doc_id, int(r.y)) for r in picked], "_id long, y int")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SIZE, dtype=np.uint8)
        for batch in batches:
            found = [indicators(x.as_py() or b"", table).astype("<u4").tobytes() for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "y", "found"])

    # the sample is bounded by its parameter: 16 bytes a row, 2 * sample_per_class rows
    texts = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")
    rows = sorted({(r.doc_id, r.y, bytes(r.found)) for r in texts.mapInArrow(read, "doc_id long, y int, found binary").collect()})
    features, y = [np.frombuffer(f, dtype="<u4").astype(np.int64) for *_, f in rows], np.array([y == 1 for _, y, _ in rows])
    if not len(y) or y.all() or not y.any():
        return Model(np.zeros(SIZE, dtype=np.float32), np.zeros(SIZE, dtype=np.float32), 0.0 if not len(y) else 2.0 if y.all() else -2.0)
    apart = np.random.default_rng(seed).random(len(y)) < 0.2
    first = fit([f for f, a in zip(features, apart, strict=True) if not a], y[~apart], seed=seed) if y[~apart].any() and not y[~apart].all() else fit(features, y, seed=seed)
    return calibrated(first, np.array([first.margin(f) for f, a in zip(features, apart, strict=True) if a]), y[apart].astype(float))


def rating(docs: DataFrame, model: Model) -> Column:
    """Column of scores (0 to 1) of the texts: one pass, no shuffle. A null text is empty. The broadcast model has a fixed size (about 2 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def rated(texts: pa.Array) -> pa.Array:
        table, m = np.zeros(SIZE, dtype=np.uint8), shared.value
        return pa.array(m.scores(np.array([m.margin(indicators(t.as_py() or b"", table)) for t in texts.cast(pa.binary())], dtype=float)))

    return rated(F.col("text"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, ``score`` and ``predicted`` (1 from 0.5 on) of every row of ``docs`` (doc_id, text; other columns are ignored).

    Defined cases: null and empty texts are scored as texts without n-grams;
    long texts are read whole; rows alike are scored alike and each returned;
    an empty table gives no rows.
    """
    return docs.select("doc_id", rating(docs, model).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, with their own columns whatever the names."""
    return docs.where(rating(docs, model) >= 0.5)
