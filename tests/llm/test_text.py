"""Token counts, packing, classifiers and fingerprints."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mvtax.llm import packing, quality, spotsigs, token_count, toxicity

from odd_rows import odd_rows

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def test_token_counts_match_the_library(odd):
    library = Tokenizer.from_file(BYTE)
    want = sorted(((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows()), key=str)
    got = token_count.count_tokens(odd, BYTE)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()), key=str) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got.collect())


def test_token_counts_of_odd_white_space_and_specials():
    import random

    library, counter, rng = Tokenizer.from_file(BYTE), token_count.BytePairCounter(BYTE), random.Random(4)
    parts = [" ", "  ", "\n", "\t", "the", "'s", "'ll", "12", "é", "<|endoftext|>", "!", "\x1c", "\u3000", "中文", "\r\n", "😀", "x" * 50]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_token_counts_empty_table(none):
    assert token_count.count_tokens(none, BYTE).collect() == []


def check_packing(rows, packed, window):
    library = Tokenizer.from_file(WORD)
    want = defaultdict(int)
    for r in rows:
        ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), window)):
            part = ids[at:at + window]
            want[r[0], piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    got, bins = defaultdict(int), defaultdict(list)
    for r in packed:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return bins


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_packing_holds_every_piece_once(odd, score):
    cap = packing.Capacity(256, 256, 256 * 256, score=score)
    packed = packing.best_fit_pack(odd, WORD, cap).collect()
    bins = check_packing(odd_rows(), packed, 256)
    assert len(bins) <= 1.05 * sum(r["length"] for r in packed) / 256 + 1


def test_packing_keeps_document_and_attention_limits():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500)
    cap = packing.Capacity(100, 5, 10_000)
    where, _ = packing.best_fit(lengths, cap)
    for b in np.unique(where):
        own = lengths[where == b]
        assert own.sum() <= 100 and len(own) <= 5 and (own * own).sum() <= 10_000
    with pytest.raises(ValueError):
        packing.pack(None, 1, packing.Capacity(100, 5, 9_999))


def test_sequences_hold_the_ids(odd, none):
    parts = packing.pieces(odd, WORD, 256, with_ids=True).cache()
    packed = packing.pack(parts.drop("ids"), parts.filter("piece = 0").count(), packing.Capacity(256, 256, 65536)).cache()
    length = {r["sequence_id"]: r["n"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    crc = {(r["sequence_id"], r["offset"]): (r["length"], r["ids_crc32"]) for r in packed.collect()}
    for r in packing.sequences(parts, packed).collect():
        assert len(r["ids"]) == 4 * length[r["sequence_id"]]
        for (s, offset), (n, c) in crc.items():
            if s == r["sequence_id"]:
                assert zlib.crc32(r["ids"][4 * offset:4 * (offset + n)]) == c
    assert packing.best_fit_pack(none, WORD).collect() == []


def test_quality_on_held_out_documents(spark, sample_docs):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    kept = quality.keep_good(docs, labels)
    want = quality.classify(docs, labels).filter("predicted = 1").count()
    assert kept.columns == docs.columns and kept.count() == want


def test_quality_without_classes(spark, odd, none):
    labels = spark.createDataFrame([(10, 1, 0), (11, 1, 0), (11, 1, 0), (None, 0, 0), (12, None, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(odd, labels)
    assert got.count() == len(odd_rows()) and {r["score"] for r in got.collect()} == {1.0}
    assert {r["score"] for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).collect() == [] and quality.keep_good(none, labels).collect() == []
    two = labels.unionByName(spark.createDataFrame([(14, 0, 1), (17, 0, 1), (18, 0, 1)], "doc_id long, quality int, toxic int"))
    assert all(0 <= r["score"] <= 1 for r in quality.classify(odd, two).collect())


def test_crf_messages_match_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    trans = rng.uniform(0.2, 2, (2, 2))
    lens = np.array([1, 7, 3])
    x = rng.uniform(0.1, 5, lens.sum())
    chains = toxicity.Chains(x, lens, trans)
    want, moves, at = [], np.zeros((2, 2)), 0
    for n in lens:
        total, toxic, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in product((0, 1), repeat=int(n)):
            p, before = 1.0, 0
            for t, s in enumerate(states):
                p *= trans[before, s] * (x[at + t] if s else 1)
                before = s
            total += p
            toxic += p * np.array(states)
            for a, b in zip((0, *states), states):
                pair[a, b] += p
        want.extend(toxic / total)
        moves += pair / total
        at += n
    assert np.allclose(chains.marginals(), want) and np.allclose(chains.transitions(), moves)


def test_crf_chunks_are_exact():
    rng = np.random.default_rng(1)
    x, trans = rng.uniform(0.1, 5, 500), np.array([[1, 0.3], [0.5, 2.0]])
    got = toxicity.Chains(x, np.array([500]), trans).marginals()
    f, fore = np.array([1.0, 0.0]), []
    for v in x:
        f = f @ trans * [1, v]
        f /= f.sum()
        fore.append(f)
    b, back = np.ones(2), []
    for v in x[::-1]:
        back.append(b)
        b = trans @ (b * [1, v])
        b /= b.sum()
    joint = np.array(fore) * np.array(back[::-1])
    assert np.allclose(got, joint[:, 1] / joint.sum(axis=1))


def test_toxicity_finds_held_out_words_and_offsets(spark, odd, none):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefg"), 6))
    rows, labels = [], []
    for i in range(400):
        text = [word() for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            text[int(rng.integers(30))] = rng.choice(["Zonkhead!", "zonkhead", "blorpface,"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = {r["doc_id"]: r for r in toxicity.tag(docs, model).collect()}
    assert all(got[i]["predicted"] == y for i, _, y in labels)
    for i, text in rows:
        for s in got[i]["spans"]:
            assert text[s["start"]:s["end"]].lower() in ("zonkhead", "blorpface")
    tagged = toxicity.tag(odd, model)
    assert tagged.count() == len(odd_rows()) and tagged.filter("score < 0 or score > 1 or score is null").count() == 0
    assert toxicity.tag(none, model).collect() == []
    assert {r["score"] for r in toxicity.detect(odd, lab.limit(0)).collect()} == {0.0}


def test_toxicity_finds_words_whose_documents_another_word_explains(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdefg"), 3))
    copied = " ".join([*(word() for _ in range(8)), "blorpface", "quiet", "river", "harbour", *(word() for _ in range(8))])
    rows, labels = [], []
    for i in range(1000):
        text = [word() for _ in range(20)]
        bad = i % 4 == 0
        if bad and i % 16:
            text[4], text[12] = "blorpface", "zonkhead"  # either alone explains these documents
        rows.append((i, copied if bad and i % 16 == 0 else " ".join(text)))
        labels.append((i, 1, int(bad)))
    new = [(5000, "abc def zonkhead gab"), (5001, "abc def blorpface gab"), (5002, "abc quiet river harbour def")]
    docs = spark.createDataFrame(rows + new, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["doc_id"]: [new[r["doc_id"] - 5000][1][s["start"]:s["end"]] for s in r["spans"]]
           for r in toxicity.tag(docs.filter("doc_id >= 5000"), model).collect()}
    assert got == {5000: ["zonkhead"], 5001: ["blorpface"], 5002: []}


def brute_edits(rows):
    rows = sorted(((-(1 << 63) if r[0] is None else r[0], r[1] or "", r[0]) for r in rows))
    out = []
    for k, (_, text, i) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (set(spotsigs.signatures(t.encode()).tolist()) for t in (text, edited, after))
        like = lambda x, y: 1.0 if not x | y else len(x & y) / len(x | y)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(like(a, b), 9), round(like(a, c), 9)))
    return sorted(out, key=str)


def test_edit_likeness_matches_brute_force(odd, none):
    got = spotsigs.edit_likeness(odd).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got), key=str) \
        == brute_edits(odd_rows())
    assert spotsigs.edit_likeness(none).collect() == []
    one = odd.filter("doc_id = 10")
    assert [r["near_next"] for r in spotsigs.edit_likeness(one).collect()] == [1.0]


def test_equal_texts_have_equal_fingerprints(odd):
    by_text = defaultdict(set)
    got = {r["doc_id"]: r["fingerprint"] for r in spotsigs.spot_sets(odd).collect()}
    for r in odd_rows():
        if r[0] is not None and r[0] != 16:
            by_text[r[1] or ""].add(got[r[0]])
    # different texts may share a set: the blank ones do, and two whose only anchor has the same words after it
    assert all(len(f) == 1 for f in by_text.values()) and len({next(iter(f)) for f in by_text.values()}) >= len(by_text) - 2


def test_near_pairs_match_brute_force(odd, none, sample_docs):
    for docs in (odd, sample_docs):
        sets = spotsigs.spot_sets(docs).cache()
        members, pairs = spotsigs.near_pairs(sets, 0.5)
        rows = [(r["doc_id"], set(r["signatures"])) for r in sets.collect()]
        first = {}
        for i, s in rows:
            key = frozenset(s)
            ids = [x for x in (i, first.get(key)) if x is not None]
            first[key] = min(ids) if ids else None
        classes = [(c, s) for s, c in first.items() if s]
        want = {(min(a, b), max(a, b), round(len(s & t) / len(s | t), 9))
                for x, (a, s) in enumerate(classes) for b, t in classes[x + 1:] if len(s & t) >= 0.5 * len(s | t) and a is not None and b is not None}
        assert {(r["a"], r["b"], round(r["likeness"], 9)) for r in pairs.collect()} == want
        assert members.count() == len(rows)
    assert [d.count() for d in spotsigs.near_pairs(spotsigs.spot_sets(none))] == [0, 0]
