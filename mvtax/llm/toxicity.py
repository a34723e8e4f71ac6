"""Toxic spans by a linear-chain conditional random field.

Two states, clean and toxic. A token (a run of letters, lower-cased) scores for toxic the weights of
its word and of its beginnings of three to eight letters; neighbouring states score a transition. Forward and
backward messages give every token's marginal; a document's score is its largest one, its offending
offsets are the runs of tokens whose marginal is a half or more.

Labelled tokens. Labels mark documents, so tokens are labelled first: features are picked one by one,
each time the one that explains most of the toxic documents not explained yet and is (nearly) absent
from the clean ones. Copies of a document are explained together by its toxic word, so their other
shared words are not picked. Words that share their documents with a picked one are found after that: every
feature (nearly) absent from the clean documents is also taken if so many toxic documents have it in
surroundings of its own that chance would not give one such feature among all (copies have the same
surroundings and count once). Tokens with a taken feature in a toxic document are toxic, tokens of
clean documents are clean, toxic documents without any are left out; a token of a toxic document that has a
feature absent from the clean ones which was not taken may be either and is left out.

Training uses ``SAMPLE`` documents a class (in the order of a hash of the id, never held-out rows), so
everything the driver holds is bounded by that parameter. Gradients of the log likelihood are summed
by Spark each round; steps follow the gradient's signs (Rprop).

Messages are computed for many texts at once: texts are cut into chunks of ``CHUNK`` tokens, all
chunks' 2 x 2 products are formed together, chained per text, and then filled in; this is exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mvtax.llm.common import checkpoint, held_out, prepare, slices

SAMPLE = 2000
ROUNDS = 30
RIDGE = 0.01
CHUNK = 64
PURITY = 0.02
SUPPORT = 4
#: Features that chance may mark toxic, expected over all tested ones.
CHANCE = 0.001
#: Share of the sampled documents a feature needs for a weight, unless it marks toxic tokens.
FREQUENT = 0.005
THRESHOLD = 0.5
CACHE = 500_000

TOKEN = re.compile(r"[^\W\d_]+")


#: Letters of the word beginnings that are features beside the whole word.
PREFIXES = range(3, 9)
_WIDTH = 1 + len(PREFIXES)


def token_features(word: str) -> list[str]:
    return [f"w{word}", *(f"{n}{word[:n]}" for n in PREFIXES if n <= len(word))]


class Chains:
    """Messages of many chains at once: ``x`` holds the toxic potentials (exp of the scores) of all
    tokens, ``lens`` the tokens of each chain, ``trans`` the 2 x 2 transition potentials. Before its
    first token a chain is clean."""

    def __init__(self, x: np.ndarray, lens: np.ndarray, trans: np.ndarray):
        n_chunks = -(-lens // CHUNK)
        first = np.cumsum(n_chunks) - n_chunks
        chain = np.repeat(np.arange(len(lens)), lens)
        at = np.arange(len(x)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.cell = (first[chain] + at // CHUNK) * CHUNK + at % CHUNK
        total = int(n_chunks.sum())
        grid, real = np.ones(total * CHUNK), np.zeros(total * CHUNK, bool)
        grid[self.cell], real[self.cell] = x, True
        grid, real = grid.reshape(total, CHUNK), real.reshape(total, CHUNK)
        product = np.tile(np.eye(2), (total, 1, 1))
        for t in range(CHUNK):
            new = product @ trans
            new[:, :, 1] *= grid[:, t, None]
            new /= new.max(axis=(1, 2), keepdims=True)
            product = np.where(real[:, t, None, None], new, product)
        enter, leave = np.empty((total, 2)), np.empty((total, 2))
        order = np.argsort(-n_chunks, kind="stable")
        counts, starts = n_chunks[order], first[order]
        f = np.tile([1.0, 0.0], (len(lens), 1))
        b = np.ones((len(lens), 2))
        for k in range(int(counts.max(initial=0))):
            own = starts[counts > k] + k
            n = len(own)
            enter[own] = f[:n]
            f[:n] = np.einsum("ni,nij->nj", f[:n], product[own])
            f[:n] /= f[:n].max(axis=1, keepdims=True)
            own = (starts + counts - 1)[counts > k] - k
            leave[own] = b[:n]
            b[:n] = np.einsum("nij,nj->ni", product[own], b[:n])
            b[:n] /= b[:n].max(axis=1, keepdims=True)
        fore, back = np.empty((total, CHUNK, 2)), np.empty((total, CHUNK, 2))
        state = enter
        self.before = np.empty((total, CHUNK, 2))
        for t in range(CHUNK):
            self.before[:, t] = state
            new = state @ trans
            new[:, 1] *= grid[:, t]
            new /= new.max(axis=1, keepdims=True)
            state = np.where(real[:, t, None], new, state)
            fore[:, t] = state
        state = leave
        for t in range(CHUNK - 1, -1, -1):
            back[:, t] = state
            new = state.copy()
            new[:, 1] *= grid[:, t]
            new = new @ trans.T
            new /= new.max(axis=1, keepdims=True)
            state = np.where(real[:, t, None], new, state)
        self.back, self.trans, self.x = back.reshape(-1, 2)[self.cell], trans, x
        self.fore, self.before = fore.reshape(-1, 2)[self.cell], self.before.reshape(-1, 2)[self.cell]

    def marginals(self) -> np.ndarray:
        """Probability of toxic for every token."""
        joint = self.fore * self.back
        return joint[:, 1] / joint.sum(axis=1)

    def transitions(self) -> np.ndarray:
        """Expected number of each transition over all tokens, 2 x 2."""
        after = self.back.copy()
        after[:, 1] *= self.x
        pair = self.before[:, :, None] * self.trans[None] * after[:, None, :]
        return (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def pick_toxic_features(rows: np.ndarray, feats: np.ndarray, n_feats: int) -> list[int]:
    """The features that explain the toxic documents; (rows, feats) are the distinct pairs of toxic document
    and (nearly) clean-free feature."""
    picked = []
    while len(rows):
        support = np.bincount(feats, minlength=n_feats)
        best = int(np.argmax(support))
        if support[best] < SUPPORT:
            break
        picked.append(best)
        left = ~np.isin(rows, rows[feats == best])
        rows, feats = rows[left], feats[left]
    return picked


def far_above_chance(own: int, clean: int, share: float, tested: int) -> bool:
    """Whether ``own`` toxic among ``own + clean`` documents, drawn with a ``share`` of toxic ones, is expected less
    than ``CHANCE`` times among ``tested`` features."""
    n = own + clean
    tail = (math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share))
            for k in range(own, n + 1))
    return sum(tail) * tested < CHANCE


def surroundings(text: str, number: dict[str, int]) -> dict[int, int]:
    """For each feature of ``number`` in the text, the least hash of the words beside a token that has it: copies of a
    text, and texts with the same passage, have the same."""
    words = TOKEN.findall(text.lower())
    out: dict[int, int] = {}
    for i, word in enumerate(words):
        own = [number[f] for f in token_features(word) if f in number]
        if own:
            beside = xxhash.xxh3_64_intdigest(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}") >> 1
            for f in own:
                out[f] = min(beside, out.get(f, beside))
    return out


class Model:
    """Feature weights and transition potentials; no weights: a document scores ``empty``."""

    def __init__(self, weights: dict[str, float], trans: np.ndarray, empty: float = 0.0):
        self.weights, self.trans, self.empty = weights, trans, empty
        self.known: dict[str, float] = {}

    def potential(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in token_features(word)) + get("", 0.0)

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """The marginals of each text's tokens."""
        words = [TOKEN.findall(t.lower()) for t in texts]
        lens = np.array([len(w) for w in words], np.int64)
        if not lens.sum():
            return [np.zeros(0)] * len(texts)
        known, scores = self.known, []
        for doc in words:
            got = list(map(known.get, doc))
            if None in got:
                for i, s in enumerate(got):
                    if s is None:
                        got[i] = s = self.potential(doc[i])
                        if len(known) < CACHE and len(doc[i]) < 64:
                            known[doc[i]] = s
            scores.extend(got)
        x = np.exp(np.clip(np.array(scores), -60, 60))
        return np.split(Chains(x, lens, self.trans).marginals(), np.cumsum(lens)[:-1])


def offending(text: str, marginals: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Runs of toxic tokens as (start, end) in code points of the text; a text whose lower case has
    another length reports offsets in its lower case."""
    out: list[tuple[int, int]] = []
    previous = -2
    for i, m in enumerate(TOKEN.finditer(text.lower())):
        if marginals[i] >= threshold:
            if previous == i - 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append((m.start(), m.end()))
            previous = i
    return out


def _sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> DataFrame:
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    side = (labels.filter(F.col(label).isin(0, 1) & ~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
            .join(ids, "doc_id", "left_semi"))
    side = checkpoint(side)
    turn = F.xxhash64("doc_id")
    chosen = [side.filter(F.col("label") == y).orderBy(turn, "doc_id").limit(size) for y in (0, 1)]
    both = checkpoint(chosen[0].unionByName(chosen[1]))  # at most 2 * size rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return checkpoint(rows.join(F.broadcast(both), "doc_id"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", size: int = SAMPLE) -> Model:
    """Learn from ``size`` documents of each class. With no toxic document every score is 0, with toxic
    documents only it is 1."""
    spark = docs.sparkSession
    prepare(spark)
    sample = _sample(docs, labels, label, size)

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sorted({f for w in set(TOKEN.findall(t.lower())) for f in token_features(w)}) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.string()))],
                                             ["doc_id", "label", "f"])

    n_class = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n_class.get(1, 0), n_class.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, np.ones((2, 2)), float(n_toxic > 0))
    feats = sample.mapInArrow(listed, "doc_id long, label int, f array<string>")
    pairs = feats.select("doc_id", "label", F.explode("f").alias("f"))
    stats = checkpoint(pairs.groupBy("f").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SUPPORT))
    pure = stats.filter((F.col("t") >= SUPPORT) & ((F.col("n") - F.col("t")) / n_clean <= PURITY * F.col("t") / n_toxic))
    pure = pure.select("f", (F.col("n") - F.col("t")).alias("clean")).toArrow()  # bounded by the sample
    clean = dict(sorted(zip(pure.column("f").to_pylist(), pure.column("clean").to_pylist())))
    names = list(clean)
    place = {f: i for i, f in enumerate(names)}

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                got = surroundings(text, place)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(got), pa.int64()), pa.array(list(got), pa.int32()), pa.array(list(got.values()), pa.int64())],
                                                 ["doc_id", "f", "beside"])

    got = sample.filter("label = 1").mapInArrow(found, "doc_id long, f int, beside long").groupBy("doc_id", "f").agg(F.min("beside").alias("beside")).toArrow()
    rows = np.unique(got.column("doc_id").to_numpy(), return_inverse=True)[1]
    order = got.column("f").to_numpy().astype(np.int64)
    picked = {names[i] for i in pick_toxic_features(rows, order, len(names))}
    if not picked:
        return Model({}, np.ones((2, 2)), 0.0)
    tested, share = stats.count(), n_toxic / (n_toxic + n_clean)
    alone = np.unique(np.stack([order, got.column("beside").to_numpy()]), axis=1)[0]
    own = np.bincount(alone, minlength=len(names)).tolist()
    picked.update(f for i, f in enumerate(names) if own[i] >= SUPPORT and far_above_chance(own[i], clean[f], share, tested))
    often = stats.filter(F.col("n") >= FREQUENT * (n_toxic + n_clean)).select("f").toArrow().column("f").to_pylist()
    names = sorted(picked.union(often))
    number = {f: i for i, f in enumerate(names)}
    number[""] = len(names)  # the bias of the toxic state
    n_weights = len(number)

    def tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out_f, out_y = [], []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                parts = [token_features(w) for w in TOKEN.findall(text.lower())]
                hit = np.array([bool(y) and not picked.isdisjoint(p) for p in parts], bool)
                if not parts or (y and not hit.any()):
                    continue
                if y:  # may be either: not taken, absent from the clean documents
                    sure = [bool(h) or place.keys().isdisjoint(p) for h, p in zip(hit, parts)]
                    parts, hit = [p for p, s in zip(parts, sure) if s], hit[sure]
                out_f.append(np.array([[number.get(f, -1) for f in p] + [-1] * (_WIDTH - len(p)) for p in parts], np.int32).tobytes())
                out_y.append(hit.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_f, pa.binary()), pa.array(out_y, pa.binary())], ["f", "y"])

    data = checkpoint(sample.mapInArrow(tokens, "f binary, y binary").repartition(spark.sparkContext.defaultParallelism))
    # parameters: the weights, then the log potentials of clean-toxic, toxic-clean, toxic-toxic
    w = np.zeros(n_weights + 3)
    w[n_weights - 1], w[n_weights] = -2.0, -2.0
    step, last = np.full(len(w), 0.2), np.zeros(len(w))
    for _ in range(ROUNDS):
        grad = _gradient(data, w, n_weights) + RIDGE * w
        same = np.sign(grad * last)
        step = np.clip(np.where(same > 0, step * 1.2, np.where(same < 0, step * 0.5, step)), 1e-6, 1.0)
        grad = np.where(same < 0, 0.0, grad)
        w -= np.sign(grad) * step
        last = grad
    weights = {f: float(w[i]) for f, i in number.items() if w[i]}
    return Model(weights, _transition(w[n_weights:]))


def _transition(log: np.ndarray) -> np.ndarray:
    return np.exp(np.array([[0.0, log[0]], [log[1], log[2]]]))


def _gradient(data: DataFrame, w: np.ndarray, n_weights: int) -> np.ndarray:
    """Gradient of the negative log likelihood: expected minus labelled counts, summed over all chains."""
    trans = _transition(w[n_weights:])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_weights + 3)
        padded = np.append(w[:n_weights], 0.0)  # place -1: a feature without a weight
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                f = [np.frombuffer(x, np.int32).reshape(-1, _WIDTH) for x in part.column("f").to_pylist()]
                y = np.concatenate([np.frombuffer(x, bool) for x in part.column("y").to_pylist()])
                lens = np.array([len(x) for x in f], np.int64)
                f = np.concatenate(f)
                chains = Chains(np.exp(np.clip(padded[f].sum(axis=1) + w[n_weights - 1], -60, 60)), lens, trans)
                diff = chains.marginals() - y
                total[n_weights - 1] += diff.sum()
                for k in range(_WIDTH):
                    ok = f[:, k] >= 0
                    total[:n_weights] += np.bincount(f[ok, k], diff[ok], minlength=n_weights)
                was = np.r_[False, y[:-1]]
                was[np.cumsum(lens)[:-1]] = False
                seen = np.array([(~was & y).sum(), (was & ~y).sum(), (was & y).sum()])
                total[n_weights:] += chains.transitions().ravel()[1:] - seen
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total[place])], ["place", "value"])

    got = data.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    grad = np.zeros(n_weights + 3)
    grad[got.column("place").to_numpy()] = got.column("value").to_numpy()
    return grad


def tag(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for every row: the offending spans are (start, end) in
    code points. Texts without a letter (null, empty) score 0; repeated rows are scored each. A text is tagged whole: its
    tokens and their marginals take about forty times its size."""
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            got = model.tag(texts) if model.weights else [np.zeros(0)] * len(texts)
            score = [float(p.max()) if len(p) else model.empty for p in got]
            spans = [offending(t, p, threshold) if s >= threshold and len(p) else [] for t, p, s in zip(texts, got, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64()),
                 pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    got = rows.mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int>>")
    return got.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def detect(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Fit on ``labels`` and tag every row of ``docs``. Empty table: empty result."""
    return tag(docs, fit(docs, labels, label), threshold)
