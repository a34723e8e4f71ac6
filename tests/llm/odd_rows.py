"""Rows that the tests of the training-data operators share."""

import random

EXTRA = "key string, score double, size int, fp string, rep_id int, hash int, n int, kept string, source_size int, edge int, copies int, part int, rate int"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
_FILL = ("k", 0.5, 1, "f", 1, 1, 1, "x", 1, 1, 1, 1, 1)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows and ids, ties, near copies, a long text."""
    rng = random.Random(3)
    base = words(rng, 130)
    near = base.split()
    near[40] = "changed"
    rows = [(10, base, "en", "s1", 5), (11, base, "en", "s1", 5), (11, base, "en", "s1", 5), (12, " ".join(near), "en", "s2", 5),
            (13, None, "en", "s2", None), (14, "", None, "s2", 0), (15, " \t\n ", "en", None, 4), (None, base, None, None, None),
            (None, None, None, None, None), (16, "one", "en", "s3", 3), (16, "other text of the same id", "en", "s3", 3),
            (17, words(rng, 30000), "en", "s3", 1), (18, "same " * 400, "en", "s1", 1), (9, "same " * 300, "en", "s1", 1),
            (19, "Éa ßb \u3000 中文 😀 <|endoftext|> x<|startoftext|>y", "de", "s1", 1), (20, "a  b\n\n c\x0b d ", "en", "s1", 1)]
    for i in range(30, 60):
        rows.append((i, words(rng, rng.randint(1, 200)) + (" " + base[:400] if i % 7 == 0 else ""), "en", f"s{i % 4}", 1))
    return rows
