"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

Each document becomes a vector of transformed statistics. Per class the training rows give a mean
and a covariance, shrunk twice - towards the pooled covariance (``POOL``) and towards its average
variance (``RIDGE``). A score is the logistic of the difference of the two log densities (plus the
log prior odds); Mahalanobis distances use the Cholesky factors, computed once after the fit and
sent to the tasks (d x d numbers).

Scale: one pass over the texts makes the narrow feature table; the moments are sums, combined per
task before the shuffle, over ALL labelled rows that are not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, held_out, prepare, slices

FEATURES = ("log_words", "word_length", "vocabulary", "symbols", "upper", "digits", "spaces",
            "repeats", "entropy", "words_per_line", "repeated_lines", "stops")
POOL = 0.05
RIDGE = 0.02
THRESHOLD = 0.3

_CLASS = np.zeros((256, 5), bool)
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-?()"], 0] = True
_CLASS[ord("A"):ord("Z") + 1, 1] = True
_CLASS[ord("0"):ord("9") + 1, 2] = True
_CLASS[[9, 10, 11, 12, 13, 32], 3] = True
_CLASS[[ord("."), ord(",")], 4] = True


def statistics(text: bytes) -> list[float]:
    """The feature vector of one text (UTF-8); the empty text gives zeros."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts @ _CLASS / n
    p = counts[counts > 0] / n
    lines = [x for x in text.split(b"\n") if x.strip()]
    w = len(words)
    return [math.log1p(w), math.log(sum(map(len, words)) / w),
            math.log1p(len(set(words))) / math.log1p(w), math.sqrt(share[0]), math.sqrt(share[1]), math.sqrt(share[2]),
            math.sqrt(share[3]), math.sqrt(sum(map(eq, words, words[1:])) / w), float(-(p * np.log(p)).sum()),
            math.log(w / len(lines)), math.sqrt(1 - len(set(lines)) / len(lines)), math.sqrt(share[4])]


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [statistics(t) for t in byte_texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)`` for every row; null text counts as empty."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _featured, "doc_id long, x array<double>")


@dataclass
class Model:
    """Class means, inverse Cholesky factors and log normalisers; ``None`` where nothing was learnt."""

    mean: np.ndarray | None
    factor: np.ndarray | None
    offset: np.ndarray | None
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.prior)
        density = [o - 0.5 * np.square((x - m) @ f.T).sum(axis=1) for m, f, o in zip(self.mean, self.factor, self.offset)]
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(FEATURES)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        y = batch.column("label").to_numpy(zero_copy_only=False)
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[y == k]
            sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    label, place = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[label, place])],
                                     ["label", "place", "value"])


def fit(table: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from ``features()`` rows whose id is labelled 0 or 1 and not held out.

    Several labels of one id count once, the largest. Without labels every score is 0.5; with one
    class only, every score is that class."""
    side = (labels.filter(F.col(label).isin(0, 1) & ~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label")))
    rows = (table.join(side, "doc_id").select("label", "x").mapInArrow(_moments, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")).collect())
    d = len(FEATURES)
    sums = np.zeros((2, 1 + d + d * d))
    for r in rows:  # two classes x (1 + d + d * d) numbers
        sums[r["label"], r["place"]] = r["value"]
    n = sums[:, 0]
    if n.min() == 0:
        return Model(None, None, None, 0.5 if n.max() == 0 else float(n[1] > 0))
    mean = sums[:, 1:1 + d] / n[:, None]
    scatter = sums[:, 1 + d:].reshape(2, d, d) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    pooled = scatter.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    unit = 1 / np.outer(scale, scale)
    factors, offsets = [], []
    for k in (0, 1):
        cov = (1 - POOL) * scatter[k] / n[k] + POOL * pooled
        cov = (1 - RIDGE) * cov * unit + RIDGE * np.eye(d)
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol) / scale[None, :])
        offsets.append(math.log(n[k] / n.sum()) - float(np.log(np.diag(chol)).sum()))
    return Model(mean, np.array(factors), np.array(offsets), 0.5)


def score(table: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``features()``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], ["doc_id", "score"])

    got = table.mapInArrow(run, "doc_id long, score double")
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Quality scores of every row of ``docs``; null and empty texts are scored as the zero vector,
    rows that repeat an id are scored each. A text is read whole, in memory about ten times its size. Empty table: empty result."""
    table = checkpoint(features(docs))
    return score(table, fit(table, labels, label), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows the classifier rejects; all columns kept, nothing shuffled."""
    model = fit(checkpoint(features(docs)), labels, label)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = np.array([statistics(t) for t in byte_texts(batch)])
            yield batch.filter(pa.array(model.scores(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
