"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A pre-token starts as one symbol a byte. A heap holds its adjacent pairs by rank; the lowest-rank
pair is popped and merged, and the pairs it forms with its two neighbours are pushed. Entries that
an earlier merge outdated are skipped when popped. Every merge takes one symbol away, so the count
is the initial symbols minus the merges; token ids are never made.

Scale: texts stay where they are (no shuffle). Words repeat, so each Python worker keeps a table of
the counts it has worked out, bounded by ``CACHE``; a full table only costs time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import prepare, slices

LIMIT = 512
CACHE = 1_000_000

#: Fixed value: how the byte-level vocabulary cuts a text into pre-tokens (``\\s`` is Unicode white space).
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_SPACE = regex.compile(r"\p{White_Space}")


def byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for the 256 bytes: printable Latin-1 characters stand
    for themselves, the others get the code points from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {chr(b if b in shown else next(hidden)): b for b in range(256)}


class BytePairCounter:
    """Counts tokens of texts under the merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        symbol: dict[str, int] = byte_letters()
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(merges):
            self.rank.setdefault(symbol[left] << 20 | symbol[right], rank)
            self.made.append(symbol.setdefault(left + right, len(symbol)))
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.words: dict[str, int] = {}
        self.pretokens: dict[str, int] = {}

    def merged(self, word: bytes) -> int:
        """Symbols left when no pair of ``word`` can merge any more."""
        n = len(word)
        rank, symbols = self.rank.get, list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (r := rank(symbols[i] << 20 | symbols[i + 1])) is not None:
                heap.append(r << 32 | i)
        heapify(heap)
        left = n
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if symbols[i] < 0 or j >= n or rank(symbols[i] << 20 | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = self.made[r], -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (s := rank(symbols[i] << 20 | symbols[k])) is not None:
                    heappush(heap, s << 32 | i)
            h = before[i]
            if h >= 0 and (s := rank(symbols[h] << 20 | symbols[i])) is not None:
                heappush(heap, s << 32 | h)
        return left

    def _pretokens(self, text: str) -> int:
        known, total = self.pretokens, 0
        for piece in PRETOKEN.findall(text):
            n = known.get(piece)
            if n is None:
                n = self.merged(piece.encode("utf-8", "surrogatepass"))
                if len(known) < CACHE and len(piece) < 64:
                    known[piece] = n
            total += n
        return total

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings. A pre-token starts at every single space between
        two non-spaces, so such a text is the sum of its words, each with the space before it; any
        other text is cut as a whole."""
        first, *rest = text.split(" ")
        counts = list(map(self.words.get, rest))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    word = rest[i]
                    if not word or _SPACE.match(word[0]) or _SPACE.match(word[-1]):
                        return self._pretokens(text)
                    counts[i] = n = self._pretokens(" " + word)
                    if len(self.words) < CACHE and len(word) < 64 and "\n" not in word:
                        self.words[word] = n
        if rest and (not first or _SPACE.match(first[-1])):
            return self._pretokens(text)
        return sum(counts) + self._pretokens(first)

    def count(self, text: str) -> int:
        """Tokens of ``text``; a special token's string inside it is that one token."""
        if not text:
            return 0
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(self._plain(p) for p in parts if p) + len(parts) - 1


@lru_cache(maxsize=2)
def _counter(path: str) -> BytePairCounter:
    return BytePairCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; null and empty texts count 0 tokens.

    ``path``: a byte-level BPE vocabulary (tokenizers' json), readable on every executor. Repeated
    rows are counted each, other columns are ignored, an empty table gives an empty result. A text is counted whole, in
    memory about ten times its size."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"),
                 pa.array([counter.count(t or "") for t in batch.column("text").to_pylist()], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    got = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
