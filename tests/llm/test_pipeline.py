"""The whole pipeline through ``run()`` against a plain pipeline, and the classifier against its definition."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_dedup import brute_components, plain_simhash
from tokenizers import Tokenizer

import corpus_pipeline
from mvtax.llm import mixing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_scores(rows, labels):
    """Regularised quadratic discriminant from its definition: ``{place: score}`` of ``rows (doc_id, text)``."""
    x = np.array([quality.statistics((t or "").encode()) for _, t in rows])
    good = {}
    for d, q in labels:
        if d is not None and q in (0, 1) and zlib.crc32(str(d).encode()) % 5:
            good[d] = max(q, good.get(d, 0))
    y = np.array([good.get(d, -1) for d, _ in rows])
    parts = [x[y == k] for k in (0, 1)]
    if not len(parts[0]) or not len(parts[1]):
        return np.full(len(rows), 0.5 if not len(parts[0]) and not len(parts[1]) else float(len(parts[1]) > 0))
    cov = [np.cov(p.T, bias=True) for p in parts]
    n = [len(p) for p in parts]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    logs = []
    for k in (0, 1):
        c = ((1 - quality.POOL) * cov[k] + quality.POOL * pooled) / np.outer(scale, scale)
        c = (1 - quality.RIDGE) * c + quality.RIDGE * np.eye(len(c))
        z = (x - parts[k].mean(axis=0)) / scale
        logs.append(math.log(n[k] / sum(n)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", z, np.linalg.solve(c, z.T).T))
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fixture(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of the sample, with null and empty texts, exact and near copies, a long text and a null id beside a large one."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    sample = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    base = next(t for _, t, *_ in sample if t and len(t.split()) > 200)
    near = base.split(" ")
    near[60] = "changed"
    rows = sample + [(2**60 + 1, None, "en", "s", 0), (2**60 + 2, "", None, None, None), (2**60 + 3, base, "en", "s", 1), (2**60 + 4, " ".join(near), "en", "s", 1),
                     (None, " ".join(reversed(base.split())), "en", None, 1),
                     (2**60 + 5, " ".join(t for _, t, *_ in sample[:60] if t), "en", "s", 1)]
    fixture(spark, folder, rows)
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()]
    spark.createDataFrame([(d, q, 0) for d, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, labels


def test_scores_equal_the_definition(spark, corpus):
    folder, rows, labels = corpus
    got = quality.classify(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()
    want = plain_scores([r[:2] for r in rows], labels)
    assert sorted((str(r["doc_id"]), round(r["score"], 6), r["predicted"]) for r in got) == sorted(
        (str(r[0]), round(float(s), 6), int(s >= 0.3)) for r, s in zip(rows, want))


def test_run_equals_the_plain_pipeline(spark, corpus):
    folder, rows, labels = corpus
    rows = [r for r, s in zip(rows, plain_scores([r[:2] for r in rows], labels)) if s >= 0.3]
    last = {}
    for r in rows:  # of equal texts the largest id
        other = last.get(r[1] or "")
        if other is None or (r[0] or -1) > (other[0] or -1):
            last[r[1] or ""] = r
    rows = list(last.values())
    groups = defaultdict(list)
    for r, c in zip(rows, brute_components([plain_simhash(r[1]) for r in rows])):
        groups[c].append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(rows) > 100
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter()
    for r in rows:
        ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want[r[0], piece, at, len(part), zlib.crc32(part.tobytes())] += copies[r[0]]
    packed = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == +want
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert len(bins) <= 1.1 * sum(r["length"] for r in packed) / 4096 + 1


def test_run_of_an_empty_table(spark, corpus, tmp_path):
    import shutil
    fixture(spark, str(tmp_path), [])
    shutil.copytree(f"{corpus[0]}/labels.parquet", f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
