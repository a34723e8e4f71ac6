"""Quality rules: plain counts of a text, and the log-likelihood ratio of its hashed n-grams.

Words and pairs of neighbouring words are hashed into ``2 ** BITS`` buckets each. Two multinomials over the
buckets are counted: the trusted target (documents labelled good) and the raw corpus (every document), both
with ``SMOOTH`` added to each bucket. A document's ratio is the mean over its n-grams of log target minus
log raw, so it does not grow with the length. The threshold is fixed by the trusted documents themselves:
one part in four of them (``crc32(id) % 5 = 1``) is kept out of the target, and what lies more than
``SPREAD`` standard deviations below the mean of their ratios is rejected. Rows with ``crc32(id) % 5 = 0`` are
left out of both, so that labels of held-out documents are never learnt.

Scale: counts are summed in every task before the shuffle - at most ``4 * 2 ** BITS`` numbers a task, and as many
reach the driver whatever the corpus. Texts meet the trusted ids by a sort-merge semi-join at every size: the ids
grow with the corpus, and one shuffle of the texts is the price. The threshold is a sum over the narrow table of ratios. The sums do not depend on how
rows are dealt but for rounding, which the ratios and the threshold are rounded beyond.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, prepare, slices

BITS = 14
SMOOTH = 1.0
SPREAD = 4.0
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SCORED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, ratio double")


def buckets(words: list[bytes], bits: int = BITS) -> np.ndarray:
    """Bucket of every word, then (from ``2 ** bits`` on) of every pair of neighbouring words."""
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    pairs = ((h[:-1] * _A + h[1:]) * _B >> shift) + np.uint64(1 << bits)
    return np.concatenate([h * _A >> shift, pairs]).astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:]))
    seen = Counter(grams)
    if len(seen) == len(grams):
        return 0
    total = end = 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int, bool]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of a text (UTF-8)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, repeated = len(words), repeated_words(words)
    return (n, len(b"".join(words).decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated, n < MIN_WORDS or 100 * repeated > 50 * n)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def bucket_counts(docs: DataFrame, bits: int = BITS) -> np.ndarray:
    """How often each bucket occurs in all texts of ``docs``."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 << bits, np.int64)
        for batch in slices(batches, "text"):
            for text in byte_texts(batch):
                total += np.bincount(buckets(text.split(), bits), minlength=2 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(2 << bits)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # at most two tables of 2 ** bits rows
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log target minus log raw probability of every bucket; words and pairs together are one multinomial."""
    if not target.sum():
        return np.zeros(len(raw))
    t, r = target + smooth, raw + smooth
    return np.log(t / t.sum()) - np.log(r / r.sum())


def scored(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """The counts and the mean log ratio of every row; a text without words has ratio 0."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SCORED.split(", ")]
        types = [pa.int64()] * 6 + [pa.bool_(), pa.float64()]
        for batch in slices(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
                words = text.split()
                ratio = round(float(weights[buckets(words, bits)].mean()), 9) if words else 0.0
                out.append((doc_id, *counts(text, words), ratio))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return _rows(docs).mapInArrow(run, _SCORED)


def quality_rules(docs: DataFrame, labels: DataFrame, spread: float = SPREAD) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, the ``ratio``, the ``threshold`` of the corpus, and
    ``kept`` - false where the base rules fail or the ratio lies below the threshold.

    ``labels``: ``doc_id, quality`` (1: trusted; null ids and other values are ignored; labels of one id that
    differ make it untrusted). A null text counts as empty: no words, ``base_failed``. A null id is judged like
    any other. Without trusted documents all ratios are 0 and every document that passes the base rules is
    kept; with none in the calibrating part the threshold is null, and the same holds. Repeated rows are
    judged each, an empty table gives an empty result. A text is worked on whole, in memory about ten times its size."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    trusted = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
               .where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
               .where("quality = 1").select("doc_id", fold.alias("fold")).where("fold > 0"))
    raw = bucket_counts(docs)
    target = bucket_counts(_rows(docs).join(trusted.where("fold > 1").hint("merge"), "doc_id", "left_semi"))
    rows = checkpoint(scored(docs, log_ratios(target, raw)))
    ours = rows.where("not base_failed").join(trusted.where("fold = 1"), "doc_id", "left_semi")
    level = ours.agg(F.round(F.avg("ratio") - spread * F.stddev_pop("ratio"), 6)).first()[0]
    threshold = F.lit(level).cast("double")
    good = F.coalesce(F.col("ratio") >= threshold, F.lit(True))
    return rows.withColumn("threshold", threshold).withColumn("kept", ~F.col("base_failed") & good)
