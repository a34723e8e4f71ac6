"""Document fingerprints by SpotSigs.

A spot signature starts at a common word (an anchor, a function word of one of the languages) and
chains the ``CHAIN`` content words that follow it; content words are all that are not anchors, lower-
cased, without the ASCII punctuation around them. A document's signatures form a set of 64-bit hashes;
likeness is the Jaccard similarity of two sets. A text with too few anchors for any signature has one
signature of all its words, a text without words has none.

``fingerprint`` is the size of the set and a digest of its sorted hashes: equal sets have equal
fingerprints.

``near_pairs`` joins near duplicates: sets are partitioned by length so that two sets similar enough lie
in one partition or in neighbours; inside, candidates share one of their rarest signatures (a set of n
and one as similar as ``threshold`` share one among the n - ceil(threshold * n) + 1 rarest of each), and
a pair is compared only if its lengths allow the threshold.

Scale of the query: a document needs the text after it by doc_id. Ids are split into ranges by quantiles;
every range is one sorted task, and the first document of a range is sent to the range before as well,
so each text is shuffled once and no task holds more than its range.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, prepare, slices, tasks

CHAIN = 2
THRESHOLD = 0.8
#: Function words of English, Spanish, German and French.
ANCHORS = frozenset(w.encode() for w in (
    "a an and are as at be by can for from has have he in is it not of on or that the there this to was were will with "
    "al como con de del el en es la las lo los no para por que se su un una y "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au aux avec ce dans des du elle est et il je le les ne pas pour qui sur un une").split())
_EDGES = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def signatures(text: bytes, chain: int = CHAIN) -> np.ndarray:
    """The sorted distinct signature hashes of a text (UTF-8)."""
    words = [w.strip(_EDGES) for w in text.lower().split()]
    words = [w for w in words if w]
    if not words:
        return np.zeros(0, np.uint64)
    content = [w for w in words if w not in ANCHORS]
    digest, found, seen = xxhash.xxh3_64_intdigest, set(), 0
    if len(content) >= chain:
        last = len(content) - chain
        for w in words:
            if w not in ANCHORS:
                seen += 1
            elif seen <= last:
                found.add(digest(b" ".join([w, *content[seen:seen + chain]])))
    if not found:
        found.add(digest(b" ".join(words)))
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sorted sets; 0 without a comparison if the lengths rule ``least`` out. Two empty
    sets are alike."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def fingerprint(sigs: np.ndarray) -> str:
    return f"{len(sigs):x}-{hashlib.blake2b(sigs.astype('<u8').tobytes(), digest_size=16).hexdigest()}"


def spot_sets(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``doc_id, fingerprint, n_signatures, signatures`` of every row; null text is empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [signatures(t, chain) for t in byte_texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(s) for s in sets]), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "fingerprint", "n_signatures", "signatures"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string, n_signatures long, signatures array<long>")


def near_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)``: members give each row its class (rows of equal fingerprint; ``class_id`` is the
    smallest doc_id), pairs are the class representatives ``a < b`` with ``likeness >= threshold``.

    Rows without signatures form one class and have no pairs. Empty table: two empty results."""
    members = checkpoint(sets.groupBy("fingerprint").agg(F.min("doc_id").alias("class_id"), F.first("signatures").alias("signatures")))
    links = sets.select("doc_id", "fingerprint").join(members.select("fingerprint", "class_id"), "fingerprint").select("doc_id", "class_id")
    full = members.filter(F.size("signatures") > 0).select("class_id", "signatures", F.size("signatures").alias("n"))
    # partition p holds lengths from (1/threshold)^p: similar sets lie in one partition or the next
    slot = F.floor(F.log("n") / F.lit(math.log(1 / threshold))).cast("int")
    full = full.withColumn("part", slot)
    df = full.select(F.explode("signatures").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    each = full.select("class_id", "n", "part", F.explode("signatures").alias("sig")).join(df, "sig")
    rare = F.row_number().over(Window.partitionBy("class_id").orderBy("df", "sig"))
    keep = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    prefix = each.withColumn("place", rare).filter((F.col("place") <= keep) & (F.col("df") > 1)).select("class_id", "n", "part", "sig")
    a = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("part").alias("pa"), "sig")
    b = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), F.explode(F.array("part", F.col("part") - 1)).alias("pa"),
                      F.col("part").alias("pb"), "sig")
    met = a.join(b, ["pa", "sig"]).filter(((F.col("pb") > F.col("pa")) | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b")))
    met = met.filter((F.col("nb") >= F.col("na") * threshold - 1e-9) & (F.col("na") >= F.col("nb") * threshold - 1e-9))
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, right = (full.select(F.col("class_id").alias(x), F.col("signatures").alias(f"s{x}")) for x in "ab")
    common = F.size(F.array_intersect("sa", "sb"))
    got = met.join(left, "a").join(right, "b").withColumn("likeness", common / (F.size("sa") + F.size("sb") - common))
    return links, got.filter(F.col("likeness") >= threshold - 1e-12).select("a", "b", "likeness")


def _ranges(rows: DataFrame, n: int) -> list[int]:
    """At most n - 1 ids that cut the ids into ranges of about equal size."""
    cuts = rows.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"] if n > 1 else None
    return sorted(set(cuts or []))


def edit_likeness(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text has the last ``n_chars // 2`` code points replaced by the first as many of the next
    document (all of it if shorter). Rows follow each other by doc_id, rows of one id by text; null
    ids come first; after the last row comes the first. A single row is its own next document.
    Null text is empty. Empty table: empty result."""
    spark = docs.sparkSession
    prepare(spark)
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"))
    cuts = _ranges(ids, 4 * tasks(spark))

    def first_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[int, int] = {}
            for i in batch.column("doc_id").to_pylist():
                r = bisect.bisect_left(cuts, i)
                least[r] = min(i, least.get(r, i))
            yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())], ["part", "i"])

    # one row for each range, of which there are four for each task
    firsts = {r["part"]: r["i"] for r in ids.mapInArrow(first_ids, "part int, i long").groupBy("part").agg(F.min("i").alias("i")).collect()}
    used = sorted(firsts)  # the ranges that hold rows; their first ids, one for each range
    before = {firsts[r]: used[k - 1] for k, r in enumerate(used)}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = batch.column("order_id").to_pylist()
            own = [bisect.bisect_left(cuts, i) for i in order]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32()), pa.array([False] * len(own))], names)
            guests = [k for k, i in enumerate(order) if i in before]
            if guests:
                part = batch.take(pa.array(guests))
                to = [before[order[k]] for k in guests]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(to, pa.int32()), pa.array([True] * len(to))], names)

    names = ["doc_id", "order_id", "text", "part", "guest"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("order_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.mapInArrow(deal, "doc_id long, order_id long, text string, part int, guest boolean")
    dealt = dealt.repartition(tasks(spark), "part").sortWithinPartitions("part", "guest", "order_id", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = None  # (part, doc_id, text, signatures): the row that waits for the next one
        for batch in slices(batches, "text"):
            for part, doc, text, guest in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest"))):
                if held is not None and held[0] == part:
                    sigs = signatures(text.encode(), chain)
                    out.append(_compare(held, text, sigs, chain))
                    held = None if guest else (part, doc, text, sigs)
                elif not guest:
                    held = (part, doc, text, signatures(text.encode(), chain))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_TYPES)], _NAMES)
                out = []

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double")


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(held: tuple, after: str, after_sigs: np.ndarray, chain: int) -> tuple:
    _, doc, text, sigs = held
    half = len(text) // 2
    edited = (text[:len(text) - half] + after[:half]).encode()
    edited_sigs = signatures(edited, chain)
    return (doc, len(text), hashlib.sha256(edited).hexdigest(), fingerprint(sigs), fingerprint(edited_sigs),
            jaccard(sigs, edited_sigs), jaccard(sigs, after_sigs))
