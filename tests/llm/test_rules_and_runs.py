"""Quality rules and periodic runs against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import odd_rows

from mvtax.llm import ngram_rules, periodic, queries


def base(text: str):
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().strip()]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (n, sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


def grams(text: str):
    h = [zlib.crc32(w) for w in text.encode().split()]
    full = 1 << 64
    return ([h1 * 0x9E3779B97F4A7C15 % full >> 50 for h1 in h]
            + [((a * 0x9E3779B97F4A7C15 + b) * 0xD6E8FEB86659FD93 % full >> 50) + (1 << 14) for a, b in zip(h, h[1:])])


def rules(rows, labels):
    """Plain version of the whole operator: ``(doc_id, counts, ratio, kept)`` of each row."""
    good = {}
    for d, q in labels:
        if d is not None and q is not None:
            good[d] = min(q, good.get(d, 1))
    fold = {d: zlib.crc32(str(d).encode()) % 5 for d, q in good.items() if q == 1}
    texts = [(d, t or "") for d, t in rows]
    raw = Counter(g for _, t in texts for g in grams(t))
    target = Counter(g for d, t in texts if fold.get(d, 0) > 1 for g in grams(t))
    size = 2 << 14
    n_raw, n_target = sum(raw.values()) + size, sum(target.values()) + size

    def ratio(t):
        g = grams(t)
        if not g or n_target == size:
            return 0.0
        return round(math.fsum(math.log((target[x] + 1) / n_target) - math.log((raw[x] + 1) / n_raw) for x in g) / len(g), 9)

    scored = [(d, base(t), ratio(t)) for d, t in texts]
    ours = [r for d, b, r in scored if fold.get(d) == 1 and not b[5]]
    level = round(np.mean(ours) - 4 * np.std(ours), 6) if ours else -math.inf
    return [(d, b, r, bool(not b[5] and r >= level)) for d, b, r in scored]


def test_rules_equal_the_plain_version(odd, spark):
    labels = [(i, int(i % 3 > 0)) for i in range(9, 60)] + [(None, 1), (40, None), (41, 0), (41, 1), (16, 1), (16, 1)]
    got = ngram_rules.quality_rules(odd, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    want = rules([(r[0], r[1]) for r in odd_rows()], labels)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    key = lambda x: repr((x[0], x[1], round(x[2], 6), x[3]))
    assert sorted(map(key, [(r["doc_id"], tuple(r[c] for c in columns), r["ratio"] + 0.0, r["kept"]) for r in got])) == sorted(map(key, [(d, b, r + 0.0, k) for d, b, r, k in want]))


def test_rules_without_labels_or_rows(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = ngram_rules.quality_rules(odd, labels).collect()
    assert len(got) == len(odd_rows()) and all(r["ratio"] == 0 and r["kept"] != r["base_failed"] for r in got)
    assert ngram_rules.quality_rules(none, labels).collect() == []


def test_rules_keep_good_and_reject_bad_held_out(spark):
    folder = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op12_quality_rules(spark, folder).collect()}
    assert len(got) == 10000
    held = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    judged = [(r["quality"], got[r["doc_id"]]["kept"]) for r in held if not got[r["doc_id"]]["base_failed"]]
    good, bad = [k for q, k in judged if q == 1], [k for q, k in judged if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad) and len(bad) > 20


def plain_runs(x):
    """All runs by a scan of every lag."""
    n, found = len(x), {}
    for q in range(1, n // 4 + 1):
        a = 0
        while a < n - q:
            b = a
            while b < n - q and x[b] == x[b + q]:
                b += 1
            if b + q - a >= max(6, 4 * q):
                found.setdefault((a, b + q), q)
            a = max(b, a + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    x = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, b = rng.randint(1, 1 + (n - a) // rng.randint(3, 9)), rng.randint(a, n)
        for i in range(a, b):
            x[i] = x[a + (i - a) % p]
    return x


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_scan_of_all_lags(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = [repetitive(rng, rng.choice([0, 1, 5, 6, 30, 100, 400, 900])) for _ in range(rng.randint(1, 6))]
        assert periodic.find_runs([np.array(d, np.int64) for d in docs]) == [plain_runs(d) for d in docs]


def test_runs_of_the_structured_words():
    """Words whose rotations are much alike: Fibonacci, Thue-Morse, and one change in a long repetition."""
    fib, thue = [[0], [0, 1]], [0]
    for _ in range(13):
        fib.append(fib[-1] + fib[-2])
    for _ in range(10):
        thue += [1 - t for t in thue]
    broken = (list(range(100)) * 12)[:-7]
    broken[600] = -5
    for x in (fib[-1], thue, broken, [7] * 1000, thue[:128] * 6):
        assert periodic.find_runs([np.array(x, np.int64)])[0] == plain_runs(x)


def report(doc_id, text, plant):
    words = (text or "").encode().split()
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        if h % 10 == 0:
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = sorted(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2]))[:1]
    dropped = {i for a, m, q in runs for i in range(a + q, a + m)}
    top = (best[0][0], best[0][1], best[0][2], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_collapsed_texts_of_odd_rows(odd, none):
    short = odd.where("text is null or length(text) < 20000")  # the scan of all lags is quadratic
    want = sorted((report(r[0], r[1], True) for r in odd_rows() if len(r[1] or "") < 20000), key=repr)
    assert sorted((tuple(r) for r in periodic.collapse_runs(short, periodic.planted_period).collect()), key=repr) == want
    assert len(periodic.collapse_runs(odd).collect()) == len(odd_rows())
    assert periodic.collapse_runs(none).collect() == [] and periodic.collapsed(none).collect() == []
    assert {r["text"] for r in periodic.collapsed(odd.where("doc_id = 18")).collect()} == {"same"}


def test_the_query_over_whole_documents(spark, sample_docs):
    rows = [(r["doc_id"], r["text"]) for r in sample_docs.collect() if len(r["text"] or "") < 8000]
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == sample_docs.count()
    assert all(got[d] == report(d, t, True) for d, t in rows)
