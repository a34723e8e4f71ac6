"""Substring dedup on a compacted, sparse de Bruijn graph.

A word that lies in a window of ``WINDOW`` consecutive words is removed if the same words also start
somewhere in a document with a smaller doc_id.

1. Documents with the same word sequence are one path of the graph; its smallest doc_id represents it
   and the others are covered whole (if they have a window).
2. Token k-mers are the graph's edges. Of each document those are kept whose hash is the least among
   ``STRIDE`` consecutive ones; ``K + STRIDE - 1 = WINDOW``, so every window keeps one, chosen by the
   window's own words: two equal windows share a kept edge. Edges that two documents have are repeated.
3. Compaction: an edge that is always followed by the same next edge at the same distance, which always
   follows it, is joined to it. Joins over the distinct repeated edges find these links and connected
   components turn them into unbranched paths. Each run of one path in a document is one span.
4. Verification: the windows around the spans are hashed and grouped; the smallest (document, place) of
   a hash is its source. Windows that run beside their source's are long repeated spans with source
   coordinates; each is checked by comparing a 128-bit digest of its words with the digest of the words
   at its source. A coordinate that many spans have is digested once. Documents with spans are numbered in the order of their ids, so that a document and a
   place are one number.

Scale: one full pass over the texts; later passes read only documents with spans. No pairs of documents
are formed - every occurrence meets one aggregate row of its key, hot keys are combined before the
shuffle and split by the adaptive skew join. Small tables are broadcast after a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, prepare, slices, small_side, tasks
from mvtax.llm.components import connected_components

WINDOW = 50
K = 20
STRIDE = WINDOW - K + 1
#: Low bits of a window's reference that hold its place; the unit is above.
PLACE = 30
#: Coordinates that one row of a document lists, about; a document with more has several rows.
LISTED = 2000
NO_WORDS = hashlib.sha256(b"").hexdigest()
#: A row without an id comes after all ids.
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class WordSequence:
    """Rolling hashes of a list of words."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE_INVERSE, np.uint64)])
        up = np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), _BASE, np.uint64)])[:n]
        self.sums = np.r_[np.uint64(0), np.cumsum(codes * up, dtype=np.uint64)]

    def hashes(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``size`` words from each place (all places if ``at`` is not given)."""
        if at is None:
            at = np.arange(max(0, len(self.sums) - size))
        h = (self.sums[at + size] - self.sums[at]) * self.down[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def _slide(x: np.ndarray, size: int, ufunc) -> np.ndarray:
    """ufunc over every run of ``size`` consecutive values."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = ufunc(x[:-step], x[step:])
        done += step
    return x


def kept_edges(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the kept k-mers of one document with a window at least; ties are all kept."""
    h = WordSequence(words).hashes(K)
    least = _slide(h, STRIDE, np.minimum)
    pad = np.zeros(STRIDE - 1, np.uint64)
    at = np.flatnonzero(_slide(np.r_[pad, least, pad], STRIDE, np.maximum) == h)
    return h[at], at


def read(docs: DataFrame) -> DataFrame:
    """``doc_id, order_id, n_words, sequence`` (SHA-256 of the joined words) and the kept edges, per row."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, sequence, edges, places = [], [], [], []
            for text in byte_texts(batch):
                words = text.split()
                n_words.append(len(words))
                sequence.append(hashlib.sha256(b" ".join(words)).digest())
                edge, at = kept_edges(words) if len(words) >= WINDOW else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                edges.append(edge.view(np.int64))
                places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("order_id"), pa.array(n_words, pa.int64()), pa.array(sequence, pa.binary()),
                 pa.array(edges, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", "order_id", "n_words", "sequence", "edges", "places"])

    return _rows(docs).mapInArrow(run, "doc_id long, order_id long, n_words long, sequence binary, edges array<long>, places array<int>")


def _rows(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(_LAST)).alias("order_id"), F.col("text").cast("string").alias("text"))


def repeated_edges(units: DataFrame) -> DataFrame:
    """``edge, rep_id, variant, place`` of every kept edge that two documents have.

    ``units``: one row a distinct sequence (``rep_id``, ``variant``, ``edges``, ``places``)."""
    each = units.select("rep_id", "variant", F.explode(F.arrays_zip("edges", "places")).alias("e"))
    each = each.select("rep_id", "variant", F.col("e.edges").alias("edge"), F.col("e.places").alias("place"))
    shared = each.groupBy("edge").agg(F.min("rep_id").alias("lo"), F.max("rep_id").alias("hi")).filter("lo < hi").select("edge")
    shared = checkpoint(shared)
    return each.join(small_side(shared, shared.count()), "edge")


def compacted_paths(found: DataFrame) -> DataFrame:
    """``edge, path``: the unbranched paths of the graph of repeated edges (``found`` of repeated_edges)."""
    along = W.partitionBy("rep_id", "variant").orderBy("place")
    steps = found.select("edge", F.lead("edge").over(along).alias("next"), (F.lead("place").over(along) - F.col("place")).alias("gap"))
    steps = checkpoint(steps.filter(F.col("next").isNotNull() & (F.col("gap") <= STRIDE)).distinct())
    only_out = steps.groupBy("edge").agg(F.count(F.lit(1)).alias("n"), F.first("next").alias("next")).filter("n = 1").select("edge", "next")
    only_in = steps.groupBy("next").agg(F.count(F.lit(1)).alias("n"), F.first("edge").alias("edge")).filter("n = 1").select("edge", "next")
    links = only_out.join(only_in, ["edge", "next"])
    roots = connected_components(links.select(F.col("edge").alias("a"), F.col("next").alias("b")))
    return roots.select(F.col("node").alias("edge"), F.col("root").alias("path"))


def path_spans(found: DataFrame, paths: DataFrame) -> DataFrame:
    """``rep_id, variant, path, first, last``: places of the first and last edge of each run of one path."""
    own = found.join(paths, "edge", "left").withColumn("path", F.coalesce("path", "edge"))
    along = W.partitionBy("rep_id", "variant").orderBy("place")
    new = (F.col("path") == F.lag("path").over(along)) & (F.col("place") - F.lag("place").over(along) <= STRIDE)
    run = F.sum(F.when(F.coalesce(new, F.lit(False)), 0).otherwise(1)).over(along.rowsBetween(W.unboundedPreceding, 0))
    return (own.withColumn("run", run).groupBy("rep_id", "variant", "path", "run")
            .agg(F.min("place").alias("first"), F.max("place").alias("last")).drop("run"))


def _with_texts(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The texts of the rows whose id is in ``wanted`` (``rep_id``, ``sequence``, ...), one row a match by id;
    the reader compares the sequence."""
    rows = _rows(docs).select("order_id", "text")
    return rows.join(small_side(wanted, n), rows["order_id"] == wanted["rep_id"])


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (``rep_id``, ``sequence``, ...) with ``unit``: 0, 1, ... in the order of ``rep_id`` - ranks inside
    range partitions, plus the rows of the partitions before (one count for each partition)."""
    parts = tasks(rows.sparkSession)
    placed = checkpoint(rows.repartitionByRange(parts, "rep_id", "sequence").withColumn("part", F.spark_partition_id()))
    count = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = count.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy("rep_id", "sequence")) - 1
    return checkpoint(placed.withColumn("rank", rank).join(small_side(before, parts), "part")
                      .withColumn("unit", (F.col("before") + F.col("rank")).cast("long")).drop("part", "rank", "before"))


def _matching(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[list[bytes], dict]]:
    """Words and the other columns of the rows whose words are the wanted sequence."""
    for batch in slices(batches, "text", 1 << 19):
        rows = batch.select(["sequence", *columns])
        for i, text in enumerate(byte_texts(batch)):
            m = rows.slice(i, 1).to_pylist()[0]  # the lists of one row at a time
            words = text.split()
            if hashlib.sha256(b" ".join(words)).digest() == m["sequence"]:
                yield words, m


def windows(texts: DataFrame) -> DataFrame:
    """``hash, ref`` of every window around the spans; ``ref`` is the unit and, in its low bits, the place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, m in _matching(batches, "unit", "spans"):
            inside = np.zeros(len(words) - WINDOW + 2, np.int64)
            first = np.array([s["first"] for s in m["spans"]]) - (WINDOW - K)
            last = np.array([s["last"] for s in m["spans"]]) + 1
            np.add.at(inside, np.clip(first, 0, len(inside) - 1), 1)
            np.add.at(inside, np.clip(last, 0, len(inside) - 1), -1)
            at = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
            h = WordSequence(words).hashes(WINDOW, at)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(at + (m["unit"] << PLACE))], ["hash", "ref"])

    return texts.select("text", "sequence", "unit", "spans").mapInArrow(run, "hash long, ref long")


def _cover(start: np.ndarray, stop: np.ndarray) -> list[int]:
    """The fewest of these intervals (both ends ascending) that cover what all of them cover: a passage that
    repeats a short line has a span for each repetition, and the words of most lie in their neighbours."""
    keep, reach, i = [], -1, 0
    while i < len(start):
        if start[i] <= reach:
            i = int(np.searchsorted(start, reach, "right")) - 1
        if stop[i] > reach:
            keep.append(i)
            reach = int(stop[i])
        i += 1
    return keep


def source_spans(found: DataFrame) -> DataFrame:
    """Long repeated spans with source coordinates: ``unit, start, stop, src_unit, src_start, same`` (words), from
    the windows whose words start earlier in the order of units; as few spans as cover them all. A span's windows
    run beside their source's;
    ``same``: the span is one word repeated and all its windows have one source."""
    source = found.groupBy("hash").agg(F.min("ref").alias("src"), F.max("ref").alias("hi"))
    source = source.filter(F.shiftright("hi", PLACE) > F.shiftright("src", PLACE)).select("hash", "src")
    hits = found.join(source, "hash").filter(F.shiftright("ref", PLACE) > F.shiftright("src", PLACE)).select("ref", "src")
    mine = hits.groupBy(F.shiftright("ref", PLACE).alias("unit")).agg(F.collect_list(F.struct("ref", "src")).alias("hits"))  # one document's windows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = (1 << PLACE) - 1
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.column("hits").slice(i, 1).flatten()
                ref, src = np.asarray(row.field(0)), np.asarray(row.field(1))
                order = np.argsort(ref, kind="stable")
                ref, src = ref[order], src[order]
                step = np.diff(src)  # the source moves along, or stays
                step = np.where((np.diff(ref) == 1) & ((step == 0) | (step == 1)), step, -1)
                new = (step < 0) | np.r_[False, (step[1:] != step[:-1]) & (step[:-1] >= 0)]
                cut = np.flatnonzero(np.r_[True, new])
                end = np.r_[cut[1:], len(ref)] - 1
                same = (end > cut) & (src[end] == src[cut])
                pick = _cover(ref[cut] & low, (ref[end] & low) + WINDOW)
                cut, end, same = cut[pick], end[pick], same[pick]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ref[cut] >> PLACE), pa.array(ref[cut] & low), pa.array((ref[end] & low) + WINDOW),
                     pa.array(src[cut] >> PLACE), pa.array(src[cut] & low), pa.array(same)],
                    ["unit", "start", "stop", "src_unit", "src_start", "same"])

    return mine.mapInArrow(run, "unit long, start long, stop long, src_unit long, src_start long, same boolean")


def _gathered(rows: DataFrame, units: DataFrame, key: list[str], name: str, *columns: str, part: str | None = None) -> tuple[DataFrame, int]:
    """One row a document (and value of ``part``): its entries in the list ``name``, and its id and sequence; with
    the count of entries."""
    rows = rows.groupBy(*key, *([part] if part else [])).agg(F.collect_list(F.struct(*columns)).alias(name))
    got = checkpoint(rows.join(units.select(*{*key, "rep_id", "sequence"}), key))
    return got, got.agg(F.coalesce(F.sum(F.size(name)), F.lit(0))).first()[0]


def verified(docs: DataFrame, near: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans whose words equal the words at their source: of a ``same`` span one window is compared and its
    own words must be one word; the documents must have different ids."""
    spans = (spans.withColumn("n", F.when(F.col("same"), F.lit(WINDOW)).otherwise(F.col("stop") - F.col("start")).cast("long"))
             .withColumn("one", F.when(F.col("same"), F.col("stop")).otherwise(F.lit(-1)).cast("long")))
    both = spans.select("unit", F.col("start").alias("at"), "n", "one").unionByName(
        spans.select(F.col("src_unit").alias("unit"), F.col("src_start").alias("at"), "n", F.lit(-1).cast("long").alias("one")))
    each = checkpoint(both.distinct())
    many = checkpoint(each.groupBy("unit").agg(F.count(F.lit(1)).alias("entries")).filter(F.col("entries") > LISTED))
    parts = F.coalesce(F.ceil(F.col("entries") / LISTED), F.lit(1))
    each = each.join(small_side(many, many.count()), "unit", "left").withColumn("part", F.pmod(F.xxhash64("at", "n", "one"), parts))
    wanted, rows = _gathered(each, near, ["unit"], "spans", "at", "n", "one", part="part")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, m in _matching(batches, "unit", "rep_id", "spans"):
            digest = []
            for s in m["spans"]:
                one = s["one"] < 0 or len(set(words[s["at"]:s["one"]])) == 1
                digest.append(xxhash.xxh3_128_digest(b" ".join(words[s["at"]:s["at"] + s["n"]])) if one else b"")
            own = [pa.array([s[c] for s in m["spans"]], pa.int64()) for c in ("at", "n", "one")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m["unit"]] * len(digest), pa.int64()), *own, pa.array(digest, pa.binary()), pa.array([m["rep_id"]] * len(digest), pa.int64())],
                ["unit", "at", "n", "one", "digest", "rep_id"])

    got = _with_texts(docs, wanted, rows).select("text", "sequence", "unit", "rep_id", "spans").mapInArrow(
        run, "unit long, at long, n long, one long, digest binary, rep_id long")
    got = checkpoint(got.dropDuplicates(["unit", "at", "n", "one"]))  # an id may have a text twice
    count = got.count()
    own = got.select("unit", F.col("at").alias("start"), "n", "one", F.col("digest").alias("a"), F.col("rep_id").alias("s"))
    src = got.filter("one < 0").select(F.col("unit").alias("src_unit"), F.col("at").alias("src_start"), "n", F.col("digest").alias("b"), F.col("rep_id").alias("r"))
    both = spans.join(small_side(own, count), ["unit", "start", "n", "one"]).join(small_side(src, count), ["src_unit", "src_start", "n"])
    return both.filter("a = b and r < s").select("unit", "start", "stop", "src_unit", "src_start", "same")


def removed(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``rep_id, sequence, n_removed, kept_sha256, kept`` of the documents that lose words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, m in _matching(batches, "rep_id", "spans"):
            cover = np.zeros(len(words) + 1, np.int64)
            for s in m["spans"]:
                cover[s["start"]] += 1
                cover[s["stop"]] -= 1
            keep = np.cumsum(cover)[:-1] == 0
            kept = b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([m["rep_id"]], pa.int64()), pa.array([m["sequence"]], pa.binary()), pa.array([int((~keep).sum())], pa.int64()),
                 pa.array([hashlib.sha256(kept).hexdigest()]), pa.array([kept.decode("utf-8", "replace")])],
                ["rep_id", "sequence", "n_removed", "kept_sha256", "kept"])

    return _with_texts(docs, wanted, n).select("text", "rep_id", "sequence", "spans").mapInArrow(
        run, "rep_id long, sequence binary, n_removed long, kept_sha256 string, kept string")


def find_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, near, spans)``: every row with its representative, the numbered documents that share edges, and
    the verified spans to remove with their source coordinates."""
    rows = checkpoint(read(docs))
    first = rows.groupBy("sequence").agg(F.min("order_id").alias("rep_id"))
    rows = rows.join(first, "sequence")
    by_id = W.partitionBy("rep_id").orderBy("sequence")  # the texts one id has, nearly always one
    units = (rows.filter((F.col("n_words") >= WINDOW) & (F.col("order_id") == F.col("rep_id"))).dropDuplicates(["sequence"])
             .withColumn("variant", (F.row_number().over(by_id) - 1).cast("long")).select("rep_id", "variant", "sequence", "edges", "places"))
    units = checkpoint(units)
    found = checkpoint(repeated_edges(units))
    spans = path_spans(found, compacted_paths(found))
    near, n = _gathered(spans, units, ["rep_id", "variant"], "spans", "first", "last")
    near = numbered(near)
    texts = _with_texts(docs, near, n)
    long = checkpoint(source_spans(windows(texts)))
    return rows.select("doc_id", "order_id", "n_words", "sequence", "rep_id"), near, verified(docs, near, long)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``.

    Null and empty texts have no words. Rows of equal id are one document to the rule: a window is only
    removed for a smaller id. Rows without an id come after all ids. Empty table: empty result."""
    rows, near, spans = find_spans(docs)
    wanted, n = _gathered(spans, near, ["unit"], "spans", "start", "stop")
    cut = removed(docs, wanted, n).drop("kept").dropDuplicates(["rep_id", "sequence"])
    cut = checkpoint(cut)
    whole = F.col("order_id") > F.col("rep_id")
    whole = whole & (F.col("n_words") >= WINDOW)
    out = rows.join(small_side(cut, cut.count()), ["rep_id", "sequence"], "left")
    return out.select("doc_id", "n_words",
                      F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(whole, F.lit(NO_WORDS)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sequence")))).alias("kept_sha256"))
