"""Packing token sequences by vector best fit.

A document is its token ids and one end id. Documents longer than the window are cut into full windows;
a full window is a sequence of its own. What is left of each document (one item at most, shorter than
the window) is packed with others: a bin has residual capacities for tokens, documents and attention
cost (the squares of the lengths), an item is a vector of the same three, and among the bins that can
take it under every constraint the item goes to the best by score - ``norm``: least weighted square
norm of what would remain; ``dot``: greatest weighted dot product of item and residual. Items come
longest first.

Scale: tokenising stays with the text's partition; only ``(row, piece, length, crc)`` moves. Items are
dealt in turn to shards of about ``SHARD_ITEMS``, each packed on its own, which costs at most one
part-filled sequence a shard (one in a thousand). Words repeat, so every task keeps tables of
their ids, bounded in bytes. There may be 2 ** 29 tasks, and 2 ** 33 rows or pieces in each; beyond that the operator
raises. Ids of documents are never touched: shards are packed as Arrow tables, where a null beside large numbers is exact.
A text is tokenised whole, in memory about twenty times its size.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, checkpoint, prepare, slices

WINDOW = 4096
END_ID = 1
SHARD_ITEMS = 4096

#: Bytes of the two word tables of a task, and what an entry takes beside its two strings.
WORD_BYTES = 10 << 20
STEM_BYTES = 18 << 20
ENTRY_BYTES = 170
JOINED = 64  # parts of words that go to the library as one text
PRUNES, COUNTED = 1, 4  # of a full table, and slices whose uses are counted before

#: Latin letters and the ASCII punctuation (but the apostrophe) after them, SIGNS; and the lower case of those letters, byte by byte.
PARTS = re.compile(rb"((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf\x9f])+)([!-&(-/:-@\[-`{-~]*)")
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER = bytes(c + 32 if 65 <= c <= 90 or 0x80 <= c <= 0x9E and c != 0x97 else c for c in range(256))

#: A row's or a piece's number is its task's, then ``NUMBERS`` bits of its place there (as Spark's own row numbers are made).
NUMBERS = 33

_COLUMNS = [("row", pa.int64()), ("number", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
            ("length", pa.int64()), ("ids_crc32", pa.int64())]
_PIECES = "row long, number long, doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds, the weights of the three dimensions in the score, and the score."""

    tokens: int = WINDOW
    documents: int = WINDOW
    attention: int = WINDOW * WINDOW
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"


class Table(dict):
    """Token ids of words, in a bounded number of bytes; a full table only costs time. What comes first fills it;
    ``PRUNES`` times, when it is full, uses are counted for a while and the less used half goes."""

    def __init__(self, most: int):
        super().__init__()
        self.most = self.room = most
        self.uses: Counter | None = None
        self.counted = self.prunes = 0

    def keep(self, word: bytes, ids: bytes) -> None:
        size = len(word) + len(ids) + ENTRY_BYTES
        if size <= self.room:
            self.room -= size
            self[word] = ids

    def used(self, words: Iterable[bytes]) -> None:
        """Called once a slice with the words looked up."""
        if self.prunes == PRUNES or self.room > self.most >> 6:
            return
        if self.uses is None:
            self.uses = Counter()
        self.uses.update(words)
        self.counted += 1
        if self.counted < COUNTED:
            return
        best = sorted(self.items(), key=lambda x: -self.uses[x[0]])
        self.clear()
        self.uses, self.counted, self.prunes, self.room = None, 0, self.prunes + 1, self.most
        for word, ids in best:
            if self.room < self.most >> 1:
                break
            self.keep(word, ids)


class WordTokenizer:
    """Token ids of a text as little-endian unsigned 32-bit numbers. The vocabulary's normaliser and
    pre-tokeniser work inside words, so a text's ids are its words' ids in turn. They also lower-case, and part
    letters from the punctuation after them, so the ids of a word of Latin letters and trailing ASCII
    punctuation are those of the two - many words share few of these."""

    def __init__(self, path: str):
        self.library, self.plain, self.ends = _library(path)
        self.words, self.stems = Table(WORD_BYTES), Table(STEM_BYTES)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        get, docs = self.words.get, []
        new: dict[bytes, bytes] = {}
        for text in texts:
            words = text.split()
            ids = list(map(get, words))
            if None in ids:
                new.update((w, b"") for w, i in zip(words, ids) if i is None)
            docs.append((words, ids))
        self.words.used(w for words, _ in docs for w in words)
        self._look_up(new)
        if self.words.room > ENTRY_BYTES:
            for w, e in new.items():
                self.words.keep(w, e)
        return [b"".join(ids) if None not in ids else b"".join([i if i is not None else new[w] for w, i in zip(words, ids)])
                for words, ids in docs]

    def _look_up(self, new: dict[bytes, bytes]) -> None:
        """Fill in the ids of ``new`` words: from their parts where those are known, else by the library."""
        known = self.stems.get
        unknown: dict[bytes, bytes] = {}
        others: dict[bytes, bytes] = {}
        stems: list[bytes] = []
        later: list[tuple[bytes, bytes, bytes]] = []
        for word, low in zip(new, b"\n".join(new).translate(LOWER).split(b"\n")):
            other, stem, end = False, low, b""
            if not low.isalpha():
                stem = low.rstrip(SIGNS)
                if stem.isalpha():
                    end = low[len(stem):]
                elif match := PARTS.fullmatch(low):
                    stem, end = match.groups()
                else:
                    other, stem = True, word
            stems.append(stem)
            a, b = known(stem), known(end) if end else b""
            if a is not None and b is not None:
                new[word] = a + b
                continue
            later.append((word, stem, end))
            if a is None:
                (others if other else unknown)[stem] = b""
            if b is None:
                unknown[end] = b""
        self._parts(unknown)
        self._each(others, list(others))
        unknown.update(others)
        for word, stem, end in later:
            a, b = unknown.get(stem), unknown.get(end)
            new[word] = (known(stem) if a is None else a) + ((known(end) if b is None else b) if end else b"")
        self.stems.used(stems)
        if self.stems.room > ENTRY_BYTES:
            for w, e in unknown.items():
                self.stems.keep(w, e)

    def _each(self, found: dict[bytes, bytes], names: list[bytes]) -> None:
        for w, e in zip(names, self.library.encode_batch([w.decode("utf-8", "replace") for w in names], add_special_tokens=False)):
            found[w] = array("I", e.ids).tobytes()

    def _parts(self, found: dict[bytes, bytes]) -> None:
        """Fill in the ids of letters or punctuation alone. Each is one word of the pre-tokeniser, so many are encoded as one
        text, cut after every token that ends a word; where the cuts are not as many as the parts, one by one."""
        names = list(found)
        for at in range(0, len(names), JOINED):
            some = names[at:at + JOINED]
            ids = np.array(self.plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cuts) != len(some) or cuts[-1] != 4 * len(ids):
                self._each(found, some)
                continue
            raw = ids.tobytes()
            for w, a, b in zip(some, [0, *cuts], cuts):
                found[w] = raw[a:b]


@lru_cache(maxsize=2)
def _library(path: str):
    """The tokenizer, one for parts of words and, by token id, whether the token ends a word. They stay with a Python worker; the
    word tables go with the task. Parts are lower-case, composed and parted by blanks, so theirs needs neither the normaliser nor
    the expressions of the pre-tokeniser; it is taken only if it gives every letter and sign the ids of the tokenizer."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer, pre_tokenizers

    library, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.normalizer = None
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    letters, signs = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ", SIGNS.decode()
    probe = " ".join([*letters, *signs, letters, signs, letters[::-1], signs[::-1]])
    if plain.encode(probe, add_special_tokens=False).ids != library.encode(probe, add_special_tokens=False).ids:
        plain = library
    suffix = getattr(library.model, "end_of_word_suffix", None)
    vocab = library.get_vocab()
    ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
    if suffix:
        ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
    return library, plain, ends


def numbered(task: int, place: int) -> int:
    """The number of a row or piece; raises where it would meet another task's."""
    if not (0 <= task < 1 << 62 - NUMBERS and 0 <= place < 1 << NUMBERS):
        raise OverflowError(f"task {task}, place {place}: no number left")
    return task << NUMBERS | place


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``row, number, doc_id, piece, start, length, ids_crc32`` (and ``ids``: their bytes): every document cut at
    the window. ``row`` tells apart rows that repeat a doc_id, ``number`` all pieces. A null or empty text is the end id alone."""
    prepare(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    fields = [*_COLUMNS, ("ids", pa.binary())] if with_ids else _COLUMNS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row, number = TaskContext.get().partitionId(), 0, 0
        tokenizer = WordTokenizer(path)
        for batch in slices(batches, "text", 1 << 19):
            out: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(byte_texts(batch))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * window)):
                    part = ids[at:at + 4 * window]
                    out.append((numbered(task, row), numbered(task, number), doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
                    number += 1
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _PIECES + (", ids binary" if with_ids else ""))


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item (any order; an item must fit an empty bin)."""
    full = np.array([cap.tokens, cap.documents, cap.attention], float)
    weight = np.array(cap.weights)
    residual = np.empty((1024, 3))
    place = np.empty(1024, np.int64)  # bin numbers of the open bins
    n_open = n_bins = 0
    used: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for turn, i in enumerate(order.tolist()):
        size = int(lengths[i])
        item = np.array([size, 1, size * size]) / full
        if turn % 256 == 255:  # bins that no later item can enter by tokens or documents are closed
            least = lengths[order[-1]] / full[0]
            keep = np.flatnonzero((residual[:n_open, 0] > least - 1e-9) & (residual[:n_open, 1] > item[1] - 1e-9))
            residual[:len(keep)], place[:len(keep)], n_open = residual[keep], place[keep], len(keep)
        left = residual[:n_open] - item
        able = np.flatnonzero((left > -1e-9).all(axis=1))
        if len(able):
            if cap.score == "dot":
                best = able[np.argmax(residual[able] @ (weight * item))]
            else:
                best = able[np.argmin(np.square(left[able]) @ weight)]
        else:
            if n_open == len(place):
                residual, place = np.concatenate([residual, np.empty_like(residual)]), np.concatenate([place, np.empty_like(place)])
            best, n_open = n_open, n_open + 1
            residual[best], place[best] = 1.0, n_bins
            n_bins += 1
            used.append(0)
        residual[best] -= item
        where[i] = place[best]
        offset[i] = used[where[i]]
        used[where[i]] += size
    return where, offset


def pack(parts: DataFrame, n_documents: int, cap: Capacity = Capacity()) -> DataFrame:
    """``parts`` (of ``pieces()``, materialised) with ``sequence_id`` and ``offset``; each sequence is
    filled without gaps from 0. ``n_documents`` sets the number of shards."""
    if cap.tokens * cap.tokens > cap.attention or cap.documents < 1:
        raise ValueError("a piece as long as the window must fit an empty sequence")
    shards = max(1, -(-n_documents // SHARD_ITEMS))
    whole = F.col("length") == cap.tokens
    columns = [n for n, _ in _COLUMNS]
    # a sequence of its own goes by its piece's number: below zero, so apart from the shards' sequences
    alone = parts.filter(whole).select(*columns, (-F.col("number") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("piece", "ascending")])
        where, offset = best_fit(table.column("length").to_numpy(), cap)
        shard = table.column("shard").to_numpy()
        return table.drop_columns(["shard"]).append_column("sequence_id", pa.array((shard << 32) + where)).append_column("offset", pa.array(offset))

    turn = F.pmod(F.col("row") + F.shiftright("row", NUMBERS) * 7919, F.lit(shards))
    packed = (parts.filter(~whole).select(*columns, turn.alias("shard")).groupBy("shard")
              .applyInArrow(run, _PIECES + ", sequence_id long, offset long"))
    return packed.unionByName(alone)


def best_fit_pack(docs: DataFrame, path: str, cap: Capacity = Capacity(), end_id: int = END_ID) -> DataFrame:
    """One row per piece of every row of ``docs``: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, row``. Repeated rows are packed each; an empty table gives an empty result."""
    parts = checkpoint(pieces(docs, path, cap.tokens, end_id))
    return pack(parts, parts.filter("piece = 0").count(), cap)


def sequences(parts: DataFrame, packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, doc_ids, ids`` (one binary of unsigned 32-bit ids). ``parts``
    were made ``with_ids``; a sequence gathers at most one window of tokens."""
    rows = packed.select("row", "piece", "doc_id", "sequence_id", "offset").join(parts.select("row", "piece", "ids"), ["row", "piece"])
    got = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return got.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
