"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mvtax.llm import components, exact_dedup, simhash, substring

from odd_rows import odd_rows


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_matches_brute_force(odd):
    got = exact_dedup.exact_dedup(odd)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(odd_rows())


def test_exact_dedup_empty_table(none):
    assert exact_dedup.exact_dedup(none).collect() == []
    assert exact_dedup.drop_copies(none).collect() == []


def test_drop_copies_keeps_one_row_of_each_text_and_all_columns(odd):
    got = exact_dedup.drop_copies(odd)
    assert got.columns == odd.columns
    texts = [r["text"] or "" for r in got.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({r[1] or "" for r in odd_rows()})
    best = {}
    for r in odd_rows():
        best[r[1] or ""] = max(best.get(r[1] or "", -1), -1 if r[0] is None else r[0])
    assert {(r["doc_id"], r["text"] or "") for r in got.collect() if r["doc_id"] is not None} == {(i, t) for t, i in best.items() if i >= 0}


def test_cuckoo_index_resizes_deletes_and_verifies():
    index = exact_dedup.CuckooIndex(2)
    keys = [hashlib.sha256(str(i).encode()).digest() + bytes(8) for i in range(3000)]
    for i, k in enumerate(keys):
        index.insert(k, i, 1)
    assert index.resizes >= 8 and all(index.keys[index.find(k)] == k for k in keys)
    other = bytearray(keys[5])
    other[20] ^= 1  # same fingerprint and bucket, other content: no duplicate
    assert index._places(bytes(other)) == index._places(keys[5]) and index.find(bytes(other)) == -1
    for k in keys[::2]:
        assert index.delete(k, 1)
    assert not index.delete(keys[0], 1)
    index = exact_dedup.CuckooIndex.load(index.dump())
    assert [index.find(k) >= 0 for k in keys] == [i % 2 == 1 for i in range(3000)]
    index.insert(keys[1], 9999, 4)
    assert index.values[index.find(keys[1])] == [9999, 5] and len(list(index.live())) == 1500


def test_index_batches(spark, odd, sample_docs):
    first = exact_dedup.content_keys(sample_docs)
    index = exact_dedup.build_index(first, 64)
    index = exact_dedup.update_index(index, exact_dedup.content_keys(odd), 64)
    index = exact_dedup.update_index(index, first, 64, delete=True)
    live = {(bytes(r["key"])[:32].hex(), r["group_size"]) for r in exact_dedup.live_entries(index).collect()}
    assert live == {(r[4], r[2]) for r in brute_exact(odd_rows())}


def plain_simhash(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps, distance=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_groups_match_brute_force(odd):
    rows = [r[:2] for r in odd_rows()]
    fps = [plain_simhash(t) for _, t in rows]
    comp = brute_components(fps)
    least = defaultdict(list)
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c].append(i)
    want = sorted(((i, f"{f:016x}", min(least[c], default=None)) for (i, _), f, c in zip(rows, fps, comp)), key=str)
    assert rows_of(simhash.near_groups(odd), "doc_id", "fingerprint", "component_id") == want


def test_near_groups_empty_and_kept_documents(odd, none):
    assert simhash.near_groups(none).collect() == [] and simhash.drop_near_copies(none).collect() == []
    got = simhash.drop_near_copies(odd)
    assert got.columns == odd.columns
    ids = {r["doc_id"] for r in got.select("doc_id").collect()}
    assert 10 in ids and 11 not in ids and 13 in ids and not {14, 15} & ids


@pytest.mark.parametrize("bucket_rows", [16, 8192])
def test_links_of_a_dense_cluster(spark, bucket_rows):
    rng = random.Random(1)
    center, fps = rng.getrandbits(64), set()
    while len(fps) < 400:  # a cluster whose members lie within 6 bits of its center
        fps.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    while len(fps) < 700:
        fps.add(rng.getrandbits(64))
    for f in list(fps)[:100]:
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), 4)))
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, 4, bucket_rows)
    root = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    comp = brute_components(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    groups = defaultdict(set)
    for s, c in zip(signed, comp):
        groups[c].add(root.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_plan_covers_every_pair_within_the_distance():
    rng = np.random.default_rng(2)
    corr = np.corrcoef(rng.normal(size=(64, 300)))
    for n in (10, 10_000, 10_000_000, 10_000_000_000):
        plan = simhash.plan_search(n, np.full(64, 0.5), corr)
        assert sum(t + 1 for t in plan.thresholds) == simhash.DISTANCE + 1
        assert sorted(b for p in plan.parts for b in p) == list(range(64))
    assert len(set(simhash.plan_search(10_000, np.full(64, 0.5), corr).thresholds)) > 1


def brute_substring(rows, window=50):
    order = lambda r: (1 << 63) - 1 if r[0] is None else r[0]
    first = {}
    split = [(r[0], order(r), (r[1] or "").encode().split()) for r in rows]
    for _, o, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(o, first.get(key, o))
    out = []
    for i, o, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < o:
                gone.update(range(k, k + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_substring_matches_brute_force(spark, odd):
    got = rows_of(substring.remove_repeats(odd), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute_substring([r[:2] for r in odd_rows()])


def test_substring_passages_of_every_length(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnop")  # noqa: E731  few words: hashes tie and repeat often
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 140)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(shared) + [word() for _ in range(rng.randint(0, 40))]
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(["z"] * n)) for i, n in enumerate((49, 50, 60, 300, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(substring.remove_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substring(rows)


def test_substring_lists_of_a_common_source_are_bounded(spark, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = [(0, " ".join(base))]  # the source of all: the same coordinate 60 times, and 60 different ones
    rows += [(i, " ".join([word(), *base[20:90], word()])) for i in range(1, 61)]
    rows += [(100 + i, " ".join([word(), *base[i:i + 60 + i % 7], word()])) for i in range(60)]
    rows.append(rows[5])
    listed, gathered = [], substring._gathered

    def spy(*args, **kw):
        got, n = gathered(*args, **kw)
        listed.append(got.agg(F.max(F.size(args[3]))).first()[0])
        return got, n

    monkeypatch.setattr(substring, "_gathered", spy)
    monkeypatch.setattr(substring, "LISTED", 8, raising=False)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(substring.remove_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_substring(rows)
    assert len(listed) == 3 and max(listed) <= 30


def test_substring_empty_table(none):
    assert substring.remove_repeats(none).collect() == []


def test_every_window_keeps_an_edge_of_its_own():
    rng = random.Random(5)
    words = [rng.choice([b"a", b"b", b"cc"]) for _ in range(400)]
    edges, at = substring.kept_edges(words)
    have = set(zip(edges.tolist(), at.tolist()))
    for p in range(len(words) - substring.WINDOW + 1):
        own, where = substring.kept_edges(words[p:p + substring.WINDOW])
        assert len(own) and all((e, w + p) in have for e, w in zip(own.tolist(), where.tolist()))
