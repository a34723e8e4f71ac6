"""Large document ids beside null ones, and numbers of rows and pieces at their bounds."""

import pytest
import public_tokenizers

from mvtax.llm import exact_dedup, packing

WORD = public_tokenizers.path("word_bpe_49k.json")
BIG = 2**62 + 1


def rows(n):
    return [(BIG + i, f"text number {i}") for i in range(n)] + [(None, "text of nobody")]


def test_exact_dedup_keeps_large_ids_beside_a_null(spark):
    docs = spark.createDataFrame(rows(400) + [(BIG + 1000, "text number 3")], "doc_id long, text string").coalesce(1)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sum(r["kept"] for r in got) == 401
    assert {r["keep_id"] for r in got if r["kept"]} == {None, BIG + 1000, *(BIG + i for i in range(400) if i != 3)}
    left = exact_dedup.drop_copies(docs).collect()
    assert sorted((r["doc_id"] or 0) for r in left) == sorted([0, BIG + 1000, *(BIG + i for i in range(400) if i != 3)])


def test_index_updates_keep_large_ids(spark):
    keyed = exact_dedup.content_keys(spark.createDataFrame(rows(50), "doc_id long, text string").coalesce(1))
    index = exact_dedup.update_index(exact_dedup.build_index(keyed, 4), keyed, 4)
    live = exact_dedup.live_entries(index).collect()
    assert {r["keep_id"] for r in live} == {None, *(BIG + i for i in range(50))} and all(r["group_size"] == 2 for r in live)
    index = exact_dedup.update_index(index, keyed.where("doc_id is null"), 4, delete=True)
    assert sum(r["group_size"] for r in exact_dedup.live_entries(index).collect()) == 101


def test_packing_keeps_large_ids_beside_a_null(spark):
    docs = spark.createDataFrame(rows(40) + [(BIG + 100, "word " * 9000)], "doc_id long, text string").coalesce(1)
    got = packing.best_fit_pack(docs, WORD).collect()
    assert {r["doc_id"] for r in got} == {None, BIG + 100, *(BIG + i for i in range(40))}
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)


def test_numbers_of_many_tasks_do_not_meet(spark):
    places = [(t, p) for t in (0, 1, 131_071, 131_072, 800_000, 2**29 - 1) for p in (0, 1, 67_108_864, 2**33 - 1)]
    numbers = [packing.numbered(t, p) for t, p in places]
    assert len(set(numbers)) == len(places) and max(numbers) < 2**62
    for t, p in ((2**29, 0), (0, 2**33)):
        with pytest.raises(OverflowError):
            packing.numbered(t, p)
    full = [(n, n, i, 0, 0, 4096, 0) for i, n in enumerate(numbers)]
    got = packing.pack(spark.createDataFrame(full, packing._PIECES), len(full)).collect()
    assert len({r["sequence_id"] for r in got}) == len(places) and all(r["sequence_id"] < 0 for r in got)
    part = [(n, n, i, 0, 0, 1500, 0) for i, n in enumerate(numbers)]
    got = packing.pack(spark.createDataFrame(part, packing._PIECES), len(part)).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(places)


def test_word_tables_are_bounded_and_exact(monkeypatch):
    import numpy as np
    monkeypatch.setattr(packing, "WORD_BYTES", 2000)
    monkeypatch.setattr(packing, "STEM_BYTES", 2000)
    tokenizer = packing.WordTokenizer(WORD)
    texts = ["Über ÉCOLE, ñandú!! don't x×y 'tis ABC... ß. 12a, <|endoftext|> a<|endoftext|> İ. Ÿ, 　é?", " ".join(f"Wort{'abcdefgh'[i % 8] * i}," for i in range(60))]
    for _ in range(3):
        for text, got in zip(texts, tokenizer.encode([t.encode() for t in texts])):
            words = text.encode().split()
            want = [i for w in words for i in tokenizer.library.encode(w.decode(), add_special_tokens=False).ids]
            assert np.frombuffer(got, "<u4").tolist() == want == tokenizer.library.encode(text, add_special_tokens=False).ids
    assert len(tokenizer.words) <= 2000 // packing.ENTRY_BYTES and len(tokenizer.stems) <= 2000 // packing.ENTRY_BYTES


def test_word_parts_go_to_the_library_together():
    """Letters and punctuation are encoded many at a time, with the ids that each has alone; the tables go with the task."""
    import numpy as np
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, library):
            self.library, self.calls = library, 0

        def encode(self, text, **how):
            self.calls += 1
            return self.library.encode(text, **how)

        def encode_batch(self, texts, **how):
            self.calls += len(texts)
            return self.library.encode_batch(texts, **how)

    plain = Tokenizer.from_file(WORD)
    words = [a + b + c for a in ("Aba", "été", "STRASSE", "ß", "qqqqqqqqz", "the") for b in ("xy", "Äo", "nst", "") for c in ("", ",", "...", "<|", "!?)", "_")]
    odd = ["don't", "a<|endoftext|>", "<|startoftext|>b", "4034x", "日本語", "Ж.", "éa", "\u0000", "�", "x" * 5000, "İx", "''s"]
    text = " ".join(words + odd)
    tokenizer = packing.WordTokenizer(WORD)
    tokenizer.library = Counting(tokenizer.library)
    want = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert tokenizer.encode([text.encode(), b"", text.encode()]) == [want, b"", want]
    assert tokenizer.library.calls <= len(odd) + 2
    assert packing.WordTokenizer(WORD).words is not tokenizer.words and not packing.WordTokenizer(WORD).words
    no_ends = packing.WordTokenizer(WORD)
    no_ends.ends = np.zeros_like(no_ends.ends)  # a vocabulary without an end of word: one by one, the same ids
    assert no_ends.encode([text.encode()]) == [want]
