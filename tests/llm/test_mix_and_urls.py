"""Mixing, URL rules, the registered queries and the pipeline."""

import math
from collections import defaultdict

import numpy as np
import pytest

from mvtax.llm import mixing, queries, url_filter

from odd_rows import odd_rows


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share by weight; who passes its cap stops there and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > cap * sizes[s] + 1e-9}
        if not over:
            target.update({s: left * weight[s] / w for s in open_})
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets_match_repeated_sharing(spark):
    rng = np.random.default_rng(3)
    for case in range(4):
        sizes = {f"s{i}": int(rng.integers(1, 10 ** int(rng.integers(1, 5)))) for i in range(int(rng.integers(1, 9)))}
        if case:
            sizes[None] = 50
        df = spark.createDataFrame([(1, s, n) for s, n in sizes.items()], "doc_id long, source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_tilts_solve_the_dual(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f"s{i % 3}", int(n)) for i, n in enumerate(rng.lognormal(5, 1.2, 600))]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    targets = mixing.source_targets(df)
    for r in mixing.tilts(df, targets).collect():
        own = np.array([n for _, s, n in rows if s == r["source"] and n > 0], float)
        if r["lam"] is None:
            assert math.isclose(r["target"], 2 * own.sum())
            continue
        rate = np.minimum(2, np.exp(r["lam"] * own / own.mean()))
        assert math.isclose((rate * own).sum(), r["target"], rel_tol=1e-6)


def test_mix_meets_targets_and_limits(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(["w"] * int(n)), f"s{0 if i % 3 else i % 7}") for i, n in enumerate(rng.lognormal(3, 1, 3000).clip(1, 400))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).cache()
    sums = defaultdict(lambda: [0, 0.0])
    for r in got.collect():
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sums[r["source"]][0] += r["taken"]
        sums[r["source"]][1] = r["target"]
    assert all(abs(t - want) <= 0.02 * want + 5 for t, want in sums.values())
    again = mixing.mix(df.repartition(7))
    assert sorted(map(tuple, again.select("doc_id", "copies").collect())) == sorted(map(tuple, got.select("doc_id", "copies").collect()))


def test_mix_of_odd_rows(odd, none):
    got = mixing.mix(odd)
    rows = got.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert sum(r["size"] for r in rows) == sum(len((r[1] or "").encode().split()) for r in odd_rows())
    taken = mixing.take_copies(odd)
    assert taken.columns == odd.columns
    assert mixing.mix(none).collect() == [] and mixing.take_copies(none).collect() == []


URLS = [(1, "https://Www.Example.COM/en/1?x=/en/"), (2, "http://example.com/en/"), (3, "http://example.com/e"), (4, "http://com"),
        (5, None), (6, "no scheme/en/"), (7, "ftp://a.net/es/x#y"), (8, "http://xnet/es/"), (9, "http://net/fr/"), (10, ""),
        (11, "http://example.com?q/en/"), (12, "http://notexample.com/en/"), (None, "x://m.net/fr/#"), (1, "http://É.com/")]
RULES = [*queries.URL_RULES, ("com", "/", "allow"), (None, "/", "block"), ("net", None, "block")]


def brute_judge(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


@pytest.mark.parametrize("limit", [url_filter.FILTER_BYTES, 4])
def test_urls_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "FILTER_BYTES", limit)  # 4: several shards
    pages = spark.createDataFrame([(*u, "x", "y") for u in URLS], "page_id long, url string, host string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert got == sorted(((i, *brute_judge(u)) for i, u in URLS), key=str)
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_shards_give_the_longest_rule(spark, monkeypatch):
    hosts = ["com", "a.com", "b.a.com", "net", "x.net"]
    rules = [(h, p, v) for i, h in enumerate(hosts) for p, v in (("/", "allow"), ("/en/", "block"), (f"/e{i}", "allow"), ("/abcdef/", "block"))]
    rules += [(f"h{i}.org", "/", "block") for i in range(600)]
    pages = [(i, f"http://{h}{p}") for i, (h, p) in enumerate((h, p) for h in [*hosts, "c.b.a.com", "h7.org", "x.h8.org", "org"] for p in ("", "/", "/en/1", "/e1", "/abcdef/x"))]
    tables = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")
    found = []
    for limit in (url_filter.FILTER_BYTES, 200):
        monkeypatch.setattr(url_filter, "FILTER_BYTES", limit)
        found.append(sorted(map(tuple, url_filter.judge(*tables).collect())))

    def longest(url):
        host, path = url_filter.split_url(url)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2:] if fits else (None, "allow")

    assert found[0] == found[1] == [(i, *url_filter.split_url(u), *longest(u)) for i, u in pages]


def test_a_very_long_url_has_few_keys():
    import tracemalloc
    host = ".".join(["a"] * 100_000) + ".example.com"
    tracemalloc.start()
    keys = url_filter.url_keys(host, "/en/" + "x" * 1_000_000, [1, 4], [1, 2, 3])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(keys) == sorted(h + p for h in ("a.example.com", "example.com", "com") for p in ("/", "/en/"))
    assert peak < 100 << 20


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS", 3)  # many false positives, so several levels
    keys = [f"host{i}.example/" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    listed = spark.createDataFrame([(k,) for k in keys[::3]], "key string")
    cascade = url_filter.build(listed, universe)
    assert len(cascade.levels) > 2
    assert [cascade.listed(k) for k in keys] == [i % 3 == 0 for i in range(3000)]


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder).cache()
        kept[name] = docs.count()
        if name != "best-fit packing":
            assert docs.columns == before.columns
    sizes = list(kept.values())
    assert 200 >= sizes[0] >= sizes[1] >= sizes[2] > 100
    bins = defaultdict(int)
    for r in docs.collect():
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 4096


def test_a_source_of_empty_texts_mixes(spark):
    rows = [(1, "a b c", "x"), (2, None, "y"), (3, "", "y"), (4, " ", None)]
    for part in (rows, rows[1:]):
        got = mixing.mix(spark.createDataFrame(part, "doc_id long, text string, source string")).collect()
        assert {r["doc_id"]: (r["size"], r["copies"]) for r in got if r["doc_id"] > 1} == {2: (0, 1), 3: (0, 1), 4: (0, 1)} and len(got) == len(part)
