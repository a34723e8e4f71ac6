"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprints: 64 bits over the XXH64 hashes of a text's word shingles, repeats included.

Search. The 64 bits are dealt to partitions, correlated bits together; partition i gets a threshold
T_i with sum(T_i + 1) = distance + 1. Two fingerprints within the distance then differ in at most T_i
bits in some partition i (T_i = -1: the partition is not probed). Every fingerprint goes to the bucket
of its own bits of each partition, and as a probe to the buckets within T_i bits of it; fingerprints
that meet are verified on all 64 bits. Number of partitions and thresholds minimise the estimated
probes plus candidates, by dynamic programming over the partitions; the estimates come from bit and
bit-pair counts over ALL distinct fingerprints. The plan changes with the data, the links never do.

Links inside a bucket are reported as a spanning forest of its components, so a dense bucket yields
fewer links than rows. A bucket's rows are compared with the rows not reached yet: in a dense one
nearly all are reached at once. Buckets over ``BUCKET_ROWS`` are cut into blocks that meet pairwise.

Scale: equal fingerprints are one row from the start (combined before the shuffle), probes are 17
bytes, texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, prepare, slices, small_side, tasks
from mvtax.llm.components import connected_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
BUCKET_ROWS = 8192
TASK_ROWS = 400_000
#: A probe is a shuffled row, a candidate pair one comparison of two numbers.
PROBE_COST = 20
_BLOCK = 1 << 17


def shingle_hashes(text: bytes, k: int = SHINGLE) -> list[int]:
    """XXH64 of every k-word shingle of a text, A-Z lower-cased; fewer words make one shingle."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return []
    joined = b" ".join(words)
    if n <= k:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip((end - size)[:n - k + 1].tolist(), end[k - 1:].tolist())]


def _bits(values: np.ndarray) -> np.ndarray:
    """(n, 64) bits of unsigned 64-bit values, bit j in column j."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def simhash(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list: a bit is set if over half of the hashes set it; an empty list gives 0."""
    out = np.zeros(len(hashes), np.uint64)
    group: list[int] = []
    rows: list[int] = []

    def flush() -> None:
        if rows:
            starts = np.cumsum([0] + [len(hashes[r]) for r in rows[:-1]])
            counts = np.add.reduceat(_bits(np.array(group, np.uint64)), starts, axis=0, dtype=np.int64)
            out[rows] = _pack(2 * counts > np.array([len(hashes[r]) for r in rows])[:, None])
            group.clear()
            rows.clear()

    for r, h in enumerate(hashes):
        if len(h) > _BLOCK:  # a very long text is counted block by block
            counts = sum(_bits(np.array(h[i:i + _BLOCK], np.uint64)).sum(axis=0, dtype=np.int64) for i in range(0, len(h), _BLOCK))
            out[r] = _pack((2 * counts > len(h))[None, :])[0]
        elif h:
            if len(group) + len(h) > _BLOCK:
                flush()
            group.extend(h)
            rows.append(r)
    flush()
    return out


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for every row, ``fp`` as a signed 64-bit number; null text is empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            fps = simhash([shingle_hashes(t, k) for t in byte_texts(batch)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


@dataclass(frozen=True)
class Plan:
    """Bit groups and their thresholds."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Count of fingerprints, share of each bit, correlation of each pair of bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, pairs = 0, np.zeros((BITS, BITS))
        for batch in batches:
            x = _bits(batch.column("fp").to_numpy().view(np.uint64)).astype(np.float32)
            n, pairs = n + len(x), pairs + x.T @ x
        flat = np.append(pairs.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["place", "value"])

    rows = fps.select("fp").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:  # 64 x 64 + 1 numbers
        flat[r["place"]] = r["value"]
    n = int(flat[-1])
    both = flat[:-1].reshape(BITS, BITS) / max(1, n)
    p = np.diag(both)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return n, p, np.clip((both - np.outer(p, p)) / np.outer(sd, sd), -1, 1)


def group_bits(corr: np.ndarray, m: int) -> tuple[tuple[int, ...], ...]:
    """The bits in m groups of nearly equal size; a group grows by the bit most correlated with it."""
    near, left, parts = np.abs(corr), list(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        seed = max(left, key=lambda b: (near[b, left].sum(), -b))
        part = [seed]
        while len(part) < size:
            rest = [b for b in left if b not in part]
            part.append(max(rest, key=lambda b: (near[b, part].sum(), -b)))
        left = [b for b in left if b not in part]
        parts.append(tuple(sorted(part)))
    return tuple(parts)


def candidate_costs(n: int, p: np.ndarray, corr: np.ndarray, part: tuple[int, ...], distance: int) -> list[float]:
    """Estimated probes plus candidate pairs of one group for each threshold -1, 0, ... distance."""
    w = len(part)
    ix = np.ix_(part, part)
    effective = max(1, round(w * w / float(np.square(corr[ix]).sum() + 1e-9)))  # correlated bits tell less
    effective = min(w, effective)
    differ = float(np.mean([2 * p[b] * (1 - p[b]) for b in part]))
    costs, within = [0.0], 0.0
    for t in range(distance + 1):
        within += comb(effective, t) * differ**t * (1 - differ) ** (effective - t) if t <= effective else 0.0
        probes = n * sum(comb(w, i) for i in range(t + 1))
        costs.append(PROBE_COST * probes + n * (n - 1) / 2 * min(1.0, within))
    return costs


def plan_search(n: int, p: np.ndarray, corr: np.ndarray, distance: int = DISTANCE) -> Plan:
    """The cheapest plan over the numbers of groups and all thresholds with sum(T_i + 1) = distance + 1.

    At most ``distance`` groups (the plain pigeonhole has one more, all with threshold 0), so that keys are
    long enough to tell many fingerprints apart and thresholds differ where the groups do."""
    best: tuple[float, Plan] | None = None
    for m in range(2, max(3, distance + 1)):
        parts = group_bits(corr, m)
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for part in parts:
            costs, grown = candidate_costs(n, p, corr, part, distance), {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, min(distance - used, len(part)) + 1):
                    if used + t + 1 <= distance + 1:
                        new = (cost + costs[t + 1], (*chosen, t))
                        if used + t + 1 not in grown or new < grown[used + t + 1]:
                            grown[used + t + 1] = new
            table = grown
        cost, chosen = table[distance + 1]
        if best is None or cost < best[0]:
            best = (cost, Plan(parts, chosen))
    return best[1]


def _masks(width: int, threshold: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for t in range(1, threshold + 1) for c in combinations(range(width), t)], np.int64)


def probes(fps: DataFrame, plan: Plan, own_only: bool = False) -> DataFrame:
    """``(key, fp, own)``: the buckets each fingerprint goes to; ``own`` marks the bucket of its own bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                fp = batch.column("fp").slice(at, 2048).to_numpy()
                bits = _bits(fp.view(np.uint64))
                for i, (part, t) in enumerate(zip(plan.parts, plan.thresholds)):
                    if t < 0:
                        continue
                    own = np.int64(i) << 56 | bits[:, part].astype(np.int64) @ (np.int64(1) << np.arange(len(part), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(fp), pa.array(np.ones(len(fp), bool))], ["key", "fp", "own"])
                    if t and not own_only:
                        masks = _masks(len(part), t)
                        key = (own[:, None] ^ masks[None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key), pa.array(np.repeat(fp, len(masks))), pa.array(np.zeros(len(key), bool))], ["key", "fp", "own"])

    return fps.select("fp").mapInArrow(run, "key long, fp long, own boolean")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of the edges (a, b) to the least node of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _reach(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of one bucket: from each row all rows not reached yet and within the distance are reached."""
    left, a, b = np.arange(len(fp)), [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = np.bitwise_count(fp[left] ^ fp[x]) <= distance
            if hit.any():
                new, left = left[hit], left[~hit]
                a.append(np.full(len(new), fp[x]))
                b.append(fp[new])
                todo.extend(new.tolist())
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def bucket_links(key: np.ndarray, fp: np.ndarray, own: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (a forest of them) between the fingerprints that meet in buckets."""
    order = np.lexsort((fp, ~own, key))
    key, fp, own = key[order], fp[order], own[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    size = np.diff(np.r_[start, len(key)])
    owners = np.add.reduceat(own, start) if len(key) else size
    wide = (owners * size > 16384) & (owners > 0)
    found_a, found_b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for s, n in zip(start[wide].tolist(), size[wide].tolist()):
        a, b = _reach(np.unique(fp[s:s + n]), distance)
        found_a.append(a)
        found_b.append(b)
    use = ~wide & (owners > 0) & (size > 1)
    first, n, k = start[use], size[use], owners[use]
    row = np.repeat(first, k) + (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))  # the owners
    later = np.repeat(first + n, k) - row - 1  # rows after the owner in its bucket
    chunk = np.cumsum(later) // (1 << 20)
    for c in np.unique(chunk):
        r, m = row[chunk == c], later[chunk == c]
        x = np.repeat(r, m)
        y = x + 1 + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        ok = (np.bitwise_count(fp[x] ^ fp[y]) <= distance) & (fp[x] != fp[y])
        a, b = _forest(fp[x[ok]], fp[y[ok]])
        found_a.append(a)
        found_b.append(b)
    return _forest(np.concatenate(found_a), np.concatenate(found_b))


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(a, b)``: links between the distinct fingerprints ``fps`` (column ``fp``) whose components are those
    of all pairs within ``distance`` bits."""
    spark = fps.sparkSession
    n, share, corr = bit_statistics(fps)
    plan = plan_search(n, share, corr, distance)
    rows = probes(fps, plan)
    hot = checkpoint(probes(fps, plan, own_only=True).groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > bucket_rows)
                     .select(F.col("key").alias("k"), F.ceil(F.col("rows") / bucket_rows).alias("blocks")))
    n_hot = hot.count()
    if n_hot:
        rows = rows.join(small_side(hot, n_hot), rows["key"] == F.col("k"), "left")
        block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
        meet = F.xxhash64("key", F.least(block, "other"), F.greatest(block, "other"))
        rows = rows.select(F.when(F.col("blocks").isNull(), F.col("key")).otherwise(meet).alias("key"), "fp", "own")
    per_row = sum(sum(comb(len(part), i) for i in range(t + 1)) for part, t in zip(plan.parts, plan.thresholds) if t >= 0)
    parts = max(tasks(spark), -(-n * per_row // TASK_ROWS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column("key").to_numpy(), b.column("fp").to_numpy().view(np.uint64), b.column("own").to_numpy(zero_copy_only=False)) for b in batches]
        if got:
            a, b = bucket_links(*(np.concatenate(c) for c in zip(*got)), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return rows.repartition(parts, "key").mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Components are those of the links of ``distance`` or fewer differing bits between all fingerprints;
    ``component_id`` is the smallest doc_id in it (null only if all its ids are null). Texts without a
    word (null, empty, white space) have fingerprint zero and link like any other. Rows that repeat an
    id get a row each. A text is read whole; its shingle hashes take about fifteen times its size. Empty table: empty result."""
    rows = checkpoint(fingerprints(docs, k))
    distinct = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    root = connected_components(fingerprint_links(distinct, distance)).withColumnRenamed("node", "fp")
    linked = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = linked.join(least, "root").select("fp", "component_id")
    return rows.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, k: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group, the smallest doc_id; all columns kept. An id that has rows
    in several groups stays if it is the smallest of one of them."""
    got = checkpoint(near_groups(docs, k, distance))
    gone = got.groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")).filter("not stays")
    gone = checkpoint(gone.select(F.col("doc_id").alias("_llm_id")))
    gone = small_side(gone, gone.count())
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(gone["_llm_id"]), "left_anti").select(docs.columns)
