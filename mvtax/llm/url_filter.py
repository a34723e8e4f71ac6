"""URL rules answered by Bloom filter cascades: exact membership, no join when urls are judged.

A rule is a key ``host + path`` (``example.com/en/``). It fits a url whose host is the rule's or a
subdomain and whose path starts with the rule's path, so a url has a bounded list of keys that could
be listed: every suffix of its host with as many labels, and every path prefix of as many characters, as some rule has.
All those keys over the corpus are the universe. A cascade over it: level 0 is a Bloom filter of the
listed keys, level 1 of the universe's false positives in level 0, level 2 of the listed keys that
pass level 1, and so on until nothing is left. A key's first failing level tells whether it is
listed - exactly, for every key of the universe.

There is one cascade for each verdict. The longest listed key of a url is its rule; a url without
one is not listed, and an unlisted url is allowed (``DEFAULT``).

Scale: the universe is a distinct of keys; a level's filter is the bit-wise or of positions, combined
before the shuffle, ``BITS`` bits for each key it encodes. Filters come through the driver and are sent to the
tasks, so keys are cut into hash shards whose filters - of the listed keys, and of the false positives expected in
the universe - stay within ``FILTER_BYTES``. Shards are built and asked one after the other; a url carries the longest
rule found so far.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import checkpoint, prepare

BITS = 10
HASHES = 7
MAX_LEVELS = 64
FILTER_BYTES = 16 << 20
FALSE_SHARE = 0.01  # of the universe in a level of ``BITS`` bits a key, rounded up
DEFAULT = "allow"
VERDICTS = ("allow", "block")

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """``(host, path)``; both empty for null or without ``://``."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


def url_keys(host: str, path: str, lengths: list[int], labels: list[int]) -> list[str]:
    """The keys a rule fitting this url can have, longest first (ties: longer host first): host suffixes of as many
    labels, and path prefixes of as many characters, as some rule has. A url of any length has few of them."""
    if not host:
        return []
    dots = [i for i, c in enumerate(host) if c == "."]
    hosts = [host[dots[-n] + 1:] if n <= len(dots) else host for n in labels if n <= len(dots) + 1]
    paths = [path[:n] for n in lengths if n <= len(path)]
    return [h + p for h, p in sorted(((h, p) for h in hosts for p in paths), key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))]


def shard_of(key: str, shards: int) -> int:
    return crc32(key.encode()) % shards


def positions(key: str, bits: int, level: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key.encode(), level)
    a, b = h & (2**64 - 1), h >> 64 | 1
    return [(a + i * b) % 2**64 % bits for i in range(HASHES)]


class Cascade:
    """The levels of one list, as bit arrays."""

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels = levels

    def listed(self, key: str) -> bool:
        for level, (bits, words) in enumerate(self.levels):
            for p in positions(key, bits, level):
                if not int(words[p >> 6]) >> (p & 63) & 1:
                    return level % 2 == 1
        return len(self.levels) % 2 == 1

    def passes(self, key: str, level: int) -> bool:
        bits, words = self.levels[level]
        return all(int(words[p >> 6]) >> (p & 63) & 1 for p in positions(key, bits, level))


def _bloom(keys: DataFrame, n: int, level: int) -> tuple[int, np.ndarray]:
    """Bloom filter of ``keys`` (column ``key``): set bits are or-ed by Spark, words come back."""
    bits = max(64, -(-n * BITS // 64) * 64)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([x for k in batch.column("key").to_pylist() for x in positions(k, bits, level)], np.int64)
            one = np.left_shift(np.uint64(1), (p & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p >> 6), pa.array(one)], ["word", "bits"])

    rows = keys.mapInArrow(place, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros(bits // 64, np.int64)
    got = rows.toArrow()  # at most bits / 64 rows, checked by build()
    words[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return bits, words.view(np.uint64)


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the distinct ``listed`` keys over ``universe`` (both: column ``key``)."""
    inside = checkpoint(universe.join(listed, "key", "left_semi"))
    outside = checkpoint(universe.join(listed, "key", "left_anti"))
    todo, other = inside, outside
    cascade = Cascade([])
    while n := todo.count():
        if n * BITS / 8 > 2 * FILTER_BYTES:
            raise RuntimeError(f"a level of {n} keys in one shard")  # shards are cut for half of this
        if len(cascade.levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        level = len(cascade.levels)
        cascade.levels.append(_bloom(todo, n, level))

        def still(batches: Iterable[pa.RecordBatch], cascade=cascade, level=level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([cascade.passes(k, level) for k in batch.column("key").to_pylist()], pa.bool_()))

        todo, other = checkpoint(other.mapInArrow(still, "key string")), todo
    return cascade


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules``: ``host, path, verdict`` (allow or block). Null urls and urls without ``://`` have an
    empty host and path, no rule and the default verdict. A key listed with both verdicts is blocked;
    repeated rules count once; rules with a null are ignored. Empty tables: no rows, or no rules. Of a very long url
    only the suffixes and prefixes that some rule could equal are looked at."""
    spark = pages.sparkSession
    prepare(spark)
    rules = (rules.select("host", "path", "verdict").dropna().filter(F.col("verdict").isin(*VERDICTS))
             .withColumn("key", F.concat("host", "path")).groupBy("host", "path", "key").agg(F.max("verdict").alias("verdict")))
    # one row for each distinct length and number of labels, not for each rule
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    labels = sorted(r[0] for r in rules.select(F.size(F.split("host", "[.]"))).distinct().collect())
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {k for u in batch.column("url").to_pylist() for k in url_keys(*split_url(u), lengths, labels)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["key"])

    universe = checkpoint(rows.select("url").mapInArrow(keys, "key string").distinct())
    most = max(rules.count(), universe.count() * FALSE_SHARE)
    shards = max(1, math.ceil(most * BITS / 8 / FILTER_BYTES))

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            none = pa.array([None] * len(parts), pa.string())
            yield _judged([batch.column("page_id"), pa.array([p[0] for p in parts]), pa.array([p[1] for p in parts]), none, none])

    best = rows.mapInArrow(split, _JUDGED)
    for shard in range(shards):
        mine = F.crc32(F.col("key").cast("binary")) % shards == shard
        cascades = {v: build(rules.filter((F.col("verdict") == v) & mine).select("key"), universe.filter(mine)) for v in VERDICTS}

        def run(batches: Iterable[pa.RecordBatch], cascades=cascades, shard=shard) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found, verdicts = [], []
                for host, path, rule, verdict in zip(*[batch.column(i).to_pylist() for i in range(1, 5)]):
                    for key in url_keys(host, path, lengths, labels):
                        if key == rule:
                            break  # found in an earlier shard; what follows ranks below it
                        hit = next((v for v in ("block", "allow") if cascades[v].listed(key)), None) if shard_of(key, shards) == shard else None
                        if hit:
                            rule, verdict = key, hit
                            break
                    found.append(rule)
                    verdicts.append(verdict)
                yield _judged([*batch.columns[:3], pa.array(found, pa.string()), pa.array(verdicts, pa.string())])

        best = best.mapInArrow(run, _JUDGED)
        if shard + 1 < shards:
            best = checkpoint(best)  # so that a task holds one shard's filters at a time
    return best.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


_JUDGED = "page_id long, host string, path string, rule string, verdict string"


def _judged(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])
