"""Exact dedup with a cuckoo-filter index of live digests.

An index is a DataFrame with one row per shard (``shard``, ``state``). A shard holds a cuckoo
filter: buckets of four slots, each slot a 16-bit fingerprint and the place of its stored key.
A fingerprint hit is verified against the content key stored in that bucket - the SHA-256 digest
of the whole text together with its byte length - so the filter's false positives never become
duplicates. When an insertion finds no room, the bucket array doubles and is refilled from the
stored keys. Live digests are inserted and deleted batch by batch: an entry counts its live rows
and goes when the count reaches zero.

Scale: digests (40 bytes a row) are combined per Arrow batch before they are dealt to
``rows / SHARD_ROWS`` shards, so a text that a third of all rows share reaches its shard once per
batch, not once per row; texts themselves are never shuffled.
"""

from __future__ import annotations

import io
import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import checkpoint, prepare, small_side

SHARD_ROWS = 2048
SLOTS = 4
MAX_KICKS = 200

INDEX_SCHEMA = "shard long, state binary"
_KEY = 40  # 32 bytes of SHA-256 and 8 of the text's length


class CuckooIndex:
    """One shard: a cuckoo filter over stored content keys. ``value[key]`` is ``[largest id, live rows]``."""

    def __init__(self, n_buckets: int = 16):
        self.keys: list[bytes | None] = []
        self.values: list[list] = []
        self.free: list[int] = []
        self.resizes = 0
        self._clear(n_buckets)

    def _clear(self, n_buckets: int) -> None:
        self.mask = n_buckets - 1
        self.buckets: list[list[tuple[int, int]]] = [[] for _ in range(n_buckets)]

    def _places(self, key: bytes) -> tuple[int, int, int]:
        fp = 1 + int.from_bytes(key[:2], "big") % 65535
        first = int.from_bytes(key[2:10], "big") & self.mask
        return fp, first, self._other(first, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x5BD1E995)) & self.mask

    def find(self, key: bytes) -> int:
        """Place of ``key`` among the stored keys, -1 if it is not live."""
        fp, first, second = self._places(key)
        for bucket in (first, second):
            for slot_fp, row in self.buckets[bucket]:
                if slot_fp == fp and self.keys[row] == key:
                    return row
        return -1

    def insert(self, key: bytes, doc_id, rows: int) -> None:
        row = self.find(key)
        if row >= 0:
            value = self.values[row]
            if doc_id is not None and (value[0] is None or doc_id > value[0]):
                value[0] = doc_id
            value[1] += rows
            return
        if self.free:
            row = self.free.pop()
            self.keys[row], self.values[row] = key, [doc_id, rows]
        else:
            row = len(self.keys)
            self.keys.append(key)
            self.values.append([doc_id, rows])
        if not self._place(key, row):
            self._resize()

    def delete(self, key: bytes, rows: int) -> bool:
        """Take ``rows`` live rows off an entry; the entry leaves the filter with its last row."""
        row = self.find(key)
        if row < 0:
            return False
        self.values[row][1] -= rows
        if self.values[row][1] <= 0:
            fp, first, second = self._places(key)
            for bucket in (first, second):
                if (fp, row) in self.buckets[bucket]:
                    self.buckets[bucket].remove((fp, row))
                    break
            self.keys[row] = None
            self.free.append(row)
        return True

    def _place(self, key: bytes, row: int) -> bool:
        fp, first, second = self._places(key)
        for bucket in (first, second):
            if len(self.buckets[bucket]) < SLOTS:
                self.buckets[bucket].append((fp, row))
                return True
        rng = random.Random(fp)
        bucket, item = first, (fp, row)
        for _ in range(MAX_KICKS):
            slot = rng.randrange(SLOTS)
            item, self.buckets[bucket][slot] = self.buckets[bucket][slot], item
            bucket = self._other(bucket, item[0])
            if len(self.buckets[bucket]) < SLOTS:
                self.buckets[bucket].append(item)
                return True
        return False

    def _resize(self) -> None:
        """Double the buckets and refill them from the stored keys."""
        size = 2 * (self.mask + 1)
        while True:
            self.resizes += 1
            self._clear(size)
            if all(self._place(key, row) for row, key in enumerate(self.keys) if key is not None):
                return
            size *= 2

    def live(self) -> Iterator[tuple[bytes, int | None, int]]:
        for key, (doc_id, rows) in zip(self.keys, self.values):
            if key is not None:
                yield key, doc_id, rows

    def dump(self) -> bytes:
        """Filter and stored keys as arrays."""
        slots = np.full((self.mask + 1, SLOTS, 2), -1, np.int32)
        for b, items in enumerate(self.buckets):
            for s, item in enumerate(items):
                slots[b, s] = item
        out = io.BytesIO()
        ids = [v[0] for v in self.values]
        np.savez(out, slots=slots, resizes=self.resizes,
                 keys=np.frombuffer(b"".join(k or bytes(_KEY) for k in self.keys), np.uint8),
                 dead=np.array(self.free, np.int64), null=np.array([i is None for i in ids], bool),
                 ids=np.array([i or 0 for i in ids], np.int64), rows=np.array([v[1] for v in self.values], np.int64))
        return out.getvalue()

    @classmethod
    def load(cls, state: bytes) -> CuckooIndex:
        with np.load(io.BytesIO(state)) as z:
            new = cls(len(z["slots"]))
            new.resizes = int(z["resizes"])
            raw = z["keys"].tobytes()
            new.keys = [raw[i:i + _KEY] for i in range(0, len(raw), _KEY)]
            new.free = z["dead"].tolist()
            for row in new.free:
                new.keys[row] = None
            new.values = [[None if null else i, n] for i, n, null in zip(z["ids"].tolist(), z["rows"].tolist(), z["null"].tolist())]
            new.buckets = [[(f, r) for f, r in b if f >= 0] for b in z["slots"].tolist()]
        return new


def content_keys(docs: DataFrame) -> DataFrame:
    """``(doc_id, key)`` per row: SHA-256 and byte length of the whole text, null counting as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.concat(F.unhex(F.sha2(text.cast("binary"), 256)), F.unhex(F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"))


def n_shards(rows: int) -> int:
    return max(64, -(-rows // SHARD_ROWS))


def _combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest and Arrow batch."""
    for batch in batches:
        t = pa.Table.from_batches([batch]).group_by(["key", "shard"]).aggregate([("doc_id", "max"), ("key", "count")])
        t = t.select(["shard", "key", "doc_id_max", "key_count"]).rename_columns(["shard", "key", "doc_id", "n"])
        yield from t.combine_chunks().to_batches()


def _operations(keyed: DataFrame, shards: int) -> DataFrame:
    prepare(keyed.sparkSession)
    shard = F.pmod(F.conv(F.hex(F.substring("key", 11, 7)), 16, 10).cast("long"), F.lit(shards))
    return keyed.withColumn("shard", shard).mapInArrow(_combined, "shard long, key binary, doc_id long, n long")


_INDEX = pa.schema([("shard", pa.int64()), ("state", pa.binary())])


def _apply(state: bytes | None, ops: pa.Table, delete: bool) -> pa.Table:
    """The index of a shard after its operations. Arrow, not pandas: ids beyond 2 ** 53 beside a null stay exact."""
    index = CuckooIndex.load(state) if state is not None else CuckooIndex()
    for key, doc_id, n in zip(*[ops.column(c).to_pylist() for c in ("key", "doc_id", "n")]):
        if delete:
            index.delete(key, n)
        else:
            index.insert(key, doc_id, n)
    return pa.table([[ops.column("shard")[0].as_py()], [index.dump()]], schema=_INDEX)


def build_index(keyed: DataFrame, shards: int) -> DataFrame:
    """Index of ``keyed`` (``content_keys``) with a fixed number of shards."""
    ops = _operations(keyed, shards)
    return ops.groupBy("shard").applyInArrow(lambda ops: _apply(None, ops, False), INDEX_SCHEMA)


def update_index(index: DataFrame, keyed: DataFrame, shards: int, delete: bool = False) -> DataFrame:
    """Insert a further batch of rows, or delete the live rows of a batch (``delete=True``)."""
    ops = _operations(keyed, shards)

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _apply(None, right, delete)
        return left if not right.num_rows else _apply(left.column("state")[0].as_py(), right, delete)

    return index.groupBy("shard").cogroup(ops.groupBy("shard")).applyInArrow(merge, INDEX_SCHEMA)


def _live(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for state in batch.column("state").to_pylist():
            rows = list(CuckooIndex.load(state).live())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64()))],
                ["key", "keep_id", "group_size"])


def live_entries(index: DataFrame) -> DataFrame:
    """``(key, keep_id, group_size)`` of every live digest."""
    prepare(index.sparkSession)
    return index.mapInArrow(_live, "key binary, keep_id long, group_size long")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts form a group (null text: empty); the largest doc_id stays. Rows that repeat the
    kept doc_id with the same text are all ``kept``. Null ids lose against any id; a group of null
    ids only has a null ``keep_id`` and its rows are kept. Empty table: empty result.
    """
    keyed = checkpoint(content_keys(docs))
    index = build_index(keyed, n_shards(keyed.count()))
    return (keyed.join(live_entries(index), "key", "left")
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex(F.substring("key", 1, 32))).alias("text_sha256")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies, all columns kept; of repeated rows of one kept id one stays."""
    names = docs.columns
    got = checkpoint(exact_dedup(docs))
    gone = got.filter("not kept").select(F.col("doc_id").alias("_llm_id"), F.col("text_sha256").alias("_llm_key")).distinct()
    marked = docs.withColumn("_llm_sha", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))

    def same(side: DataFrame):
        return F.col("doc_id").cast("long").eqNullSafe(side["_llm_id"]) & (F.col("_llm_sha") == side["_llm_key"])

    gone = small_side(gone, gone.count())
    out = marked.join(gone, same(gone), "left_anti")
    again = (got.filter("kept").groupBy(F.col("doc_id").alias("_llm_id"), F.col("text_sha256").alias("_llm_key"))
             .agg(F.count(F.lit(1)).alias("_llm_n")).filter("_llm_n > 1"))
    n = again.count()
    if n:
        again = small_side(again, n)
        one = out.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "_llm_sha"])
        out = out.join(again, same(again), "left_anti").unionByName(one)
    return out.select(names)
