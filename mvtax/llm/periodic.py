"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``REPEATS`` periods long,
that no neighbouring word extends. Periods up to ``DIRECT`` come from direct lag scans. Longer ones are
found scale by scale: at scale w, which covers the periods from (2w - 1) / 3 to w, every position gets the
hash of the w words that start there, and every window of w positions its (leftmost) least hash. Inside a
run of such a period q the w words of the q starts of one period all differ, a window holds each of them,
and at least w + q starts lie inside the run; so two neighbouring minima lie exactly q apart and have equal
hashes. Each such pair is a seed; it is extended word by word both ways, so nothing rests on hashes but the
seed (64-bit hashes, of which 40 bits or more pick the minima). What is found for a multiple of the
smallest period has the same bounds as the run itself and is dropped.

Scale: a document is worked on whole, where it lies; nothing is shuffled. The documents of a slice of an
Arrow batch are scanned together, longest first with a word of its own between two of them, so a scale
sees only the documents long enough for its periods. Time is the words times log(w) a scale, and there are
log(n) / log(1.5) scales for n words; memory is about 100 bytes a word of the slice (2 MB of texts, or one
longer text).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import byte_texts, prepare, slices

LEAST = 6
REPEATS = 4
DIRECT = 12

#: ``(doc_id, n_words) -> (first word, period)`` to write over the words from there on, or None.
Plant = Callable[[int, int], tuple[int, int] | None]

_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The test pattern: in about one document of ten the words from a on repeat with a period, both drawn
    from crc32 of the id. A document without an id or words gets none."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 else None


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours, by doubling."""
    k = 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:len(x) - (w - k)], x[w - k:]) if k < w else x


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + step, step * 4
    return n


def _lag_runs(ids: np.ndarray, q: int) -> Iterator[tuple[int, int, int]]:
    """Stretches whose words q apart are equal, from a direct scan of one lag."""
    breaks = np.flatnonzero(ids[q:] != ids[:-q])
    edges = np.concatenate([[-1], breaks, [len(ids) - q]])
    long = np.flatnonzero(np.diff(edges) - 1 >= max(LEAST, REPEATS * q) - q)
    for i in long.tolist():
        yield int(edges[i]) + 1, int(edges[i + 1]) + q, q


def _seeds(ids: np.ndarray, hashes: np.ndarray, powers: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbouring minimizers with equal hashes: position and distance, of the scale's periods."""
    gram = _mixed((hashes[w:] - hashes[:-w]) * powers[:len(hashes) - w])
    if len(gram) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = np.uint64((1 << len(gram).bit_length()) - 1)
    at = (_window_min((gram & ~mask) | np.arange(len(gram), dtype=np.uint64), w) & mask).astype(np.int64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    lag = np.diff(at)
    good = (lag <= w) & (3 * lag >= 2 * w - 1) & (gram[at[1:]] == gram[at[:-1]])
    return at[:-1][good], lag[good]


def find_runs(docs: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Per document, given as word numbers from 0: its runs as ``(start, length, period)`` by start, then period."""
    order = sorted((i for i, d in enumerate(docs) if len(d) >= LEAST), key=lambda i: -len(docs[i]))
    found: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not order:
        return found
    sizes = [len(docs[i]) for i in order]
    starts = np.cumsum([0, *[n + 1 for n in sizes[:-1]]])
    ids = np.empty(sum(sizes) + len(order), np.int64)
    for k, (i, at) in enumerate(zip(order, starts.tolist())):
        ids[at:at + sizes[k]] = docs[i]
        ids[at + sizes[k]] = -1 - k  # equal to nothing else
    runs: set[tuple[int, int, int]] = set()
    reach = np.array(sizes)

    def part(least: int) -> int:
        """Words of the documents, longest first, that can hold a run of ``least`` words."""
        k = int(np.searchsorted(-reach, -least, side="right"))
        return int(starts[k - 1]) + sizes[k - 1] + 1 if k else 0

    for q in range(1, DIRECT + 1):
        n = part(max(LEAST, REPEATS * q))
        if n:
            runs.update(_lag_runs(ids[:n], q))
    low = DIRECT + 1
    if part(REPEATS * low):
        n = part(REPEATS * low)
        with np.errstate(over="ignore"):
            up = np.full(n, _BASE, np.uint64)
            up[0] = 1
            up = np.multiply.accumulate(up)
            down = np.full(n, _BACK, np.uint64)
            down[0] = 1
            down = np.multiply.accumulate(down)
            hashes = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(ids[:n].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * up)])
            while (n := part(REPEATS * low)):
                w = (3 * low + 1) // 2
                done: tuple[int, int] = (0, 0)  # lag and end of the stretch extended last
                p, lags = _seeds(ids[:n], hashes[:n + 1], down, w)
                for i in np.lexsort((p, lags)).tolist():
                    at, q = int(p[i]), int(lags[i])
                    if done[0] == q and at < done[1]:
                        continue
                    right = at + _agree(ids[at:n - q], ids[at + q:n])
                    left = at - _agree(ids[:at][::-1], ids[q:at + q][::-1])
                    done = (q, right)
                    if right + q - left >= max(LEAST, REPEATS * q):
                        runs.add((left, right + q, q))
                low = w + 1
    least: dict[tuple[int, int], int] = {}
    for a, b, q in runs:
        least[a, b] = min(q, least.get((a, b), q))
    for (a, b), q in least.items():
        k = int(np.searchsorted(starts, a, side="right")) - 1
        found[order[k]].append((a - int(starts[k]), b - a, q))
    for r in found:
        r.sort(key=lambda x: (x[0], x[2]))
    return found


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run of the greatest exact length / period; ties: least start, then period."""
    best = runs[0]
    for r in runs[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _reported(plant: Plant | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            texts = [t.split() for t in byte_texts(batch)]
            number: dict[bytes, int] = {}
            docs = []
            for k, (doc_id, words) in enumerate(zip(ids, texts)):
                edit = plant(doc_id, len(words)) if plant else None
                if edit:
                    a, p = edit
                    texts[k] = words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
                docs.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
            out = []
            for doc_id, words, runs in zip(ids, texts, find_runs(docs)):
                top: tuple = (None,) * 4
                if runs:
                    start, length, period = _strongest(runs)
                    top = (start, length, period, 1000 * length // period)
                    kept = np.ones(len(words), bool)
                    for a, n, q in runs:
                        kept[a + q:a + n] = False
                    words = [words[i] for i in np.flatnonzero(kept).tolist()]
                said = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
                out.append((doc_id, len(runs), *top, sha256(said.encode()).hexdigest(), sha256(b" ".join(words)).hexdigest()))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in _SCHEMA.split(", ")])

    return run


def collapse_runs(docs: DataFrame, plant: Plant | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are not read): its number of runs, the
    run of the greatest exponent, and digests of all runs and of the words that stay when every run is cut
    to its first period. ``plant`` may first write a repetition over a document's words.

    A null text, and one without words, has no runs and the digest of the empty string; a null id stays null
    (nothing is planted). Repeated rows are reported each; an empty table gives an empty result."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_reported(plant), _SCHEMA)


def collapsed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: the whole texts with every run cut to its first period, words joined by one space."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t.split() for t in byte_texts(batch)]
            number: dict[bytes, int] = {}
            numbered = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for words in texts]
            out = []
            for words, runs in zip(texts, find_runs(numbered)):
                kept = np.ones(len(words), bool)
                for a, n, q in runs:
                    kept[a + q:a + n] = False
                out.append(b" ".join([words[i] for i in np.flatnonzero(kept).tolist()]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string")
