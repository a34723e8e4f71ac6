"""Graph operators on the hand-worked fixture: unit vectors a, b, c at 0, 60 and 90 degrees."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mvtax.operators import graph as G
from mvtax.operators.knn import knn, knn_bruteforce

A, B, C = 0, 1, 2


@pytest.fixture(scope="module")
def abc(spark):
    rows = [(A, [1.0, 0.0]), (B, [math.cos(math.pi / 3), math.sin(math.pi / 3)]), (C, [0.0, 1.0])]
    return spark.createDataFrame(rows, "id long, vec array<double>").withColumn("g", F.lit(0)) \
                .withColumn("view", F.lit("v"))


def _edges(df):
    return {(r["src"], r["dst"]): r["w"] for r in df.collect()}


def _scale(abc, k):
    nbr = knn(abc, k=k, group_cols=["g", "view"])
    return nbr.withColumn("k", F.lit(k)), ["g", "view", "k"]


def test_k1(abc):
    e, keys = _scale(abc, 1)
    assert {(r.src, r.dst) for r in e.collect()} == {(A, B), (B, C), (C, B)}
    heat = _edges(G.heat_affinity(e, keys))
    assert heat[(A, B)] == pytest.approx(0.02394, abs=1e-5)
    assert heat[(B, C)] == pytest.approx(0.36788, abs=1e-5)
    mutual = _edges(G.mutualize(G.heat_affinity(e, keys), keys))
    assert set(mutual) == {(B, C), (C, B)}
    assert _edges(G.snn_graph(e, keys)) == {}
    bl = G.blend(G.mutualize(G.heat_affinity(e, keys), keys), G.snn_graph(e, keys), keys)
    assert _edges(bl)[(B, C)] == pytest.approx(0.23912, abs=1e-5)
    lap = _edges(G.normalize_sym(bl, keys))
    assert lap[(B, C)] == pytest.approx(1.0, abs=1e-9)  # off-diagonal of L is -1


def test_k2(abc):
    e, keys = _scale(abc, 2)
    heat = _edges(G.heat_affinity(e, keys))
    assert heat[(A, B)] == pytest.approx(0.60653, abs=1e-5)
    assert heat[(B, C)] == pytest.approx(0.96474, abs=1e-5)
    assert heat[(A, C)] == pytest.approx(0.36788, abs=1e-5)
    snn = _edges(G.snn_graph(e, keys))
    assert all(v == pytest.approx(0.5) for v in snn.values()) and len(snn) == 6
    bl = G.blend(G.mutualize(G.heat_affinity(e, keys), keys), G.snn_graph(e, keys), keys)
    b = _edges(bl)
    assert b[(A, B)] == pytest.approx(0.56924, abs=1e-5)
    assert b[(B, C)] == pytest.approx(0.80208, abs=1e-5)
    assert b[(A, C)] == pytest.approx(0.41412, abs=1e-5)
    deg = {r.src: r.deg for r in G.degree(bl, keys).collect()}
    assert deg[A] == pytest.approx(0.98337, abs=1e-5)
    assert deg[B] == pytest.approx(1.37132, abs=1e-5)
    lap = _edges(G.normalize_sym(bl, keys))
    assert lap[(A, B)] == pytest.approx(0.49020, abs=1e-5)
    assert lap[(B, C)] == pytest.approx(0.62108, abs=1e-5)
    assert lap[(A, C)] == pytest.approx(0.37868, abs=1e-5)


def test_fused_fast_path_equals_composition(spark):
    """The one-join fused build equals heat -> mutual / SNN -> blend -> normalise per view and k."""
    from taxonomy_helpers import SF001
    from mvtax.sources.tables import embedding_views
    v = embedding_views(spark, SF001).withColumn("g", F.col("id") % 3)
    p = G.group_params(v, ["g"], (6, 8, 10))
    fast = _edges(G.fused_affinity(v, ["g"], params=p).select(
        F.struct("g", "src").alias("src"), "dst", "w"))
    nbr = knn(v.join(p.select("g", "kmax"), "g"), group_cols=["g", "view"], k_col="kmax")
    e = G.explode_kset(nbr, p, ["g"])
    a = G.scale_graphs(e, ["g", "view", "k"])
    slow = _edges(G.fuse_views(G.multi_scale(a, p, ["g"]), ["g"], G.DEFAULT_CONFIG.view_weights)
                  .select(F.struct("g", "src").alias("src"), "dst", "w"))
    assert set(fast) == set(slow)
    assert all(fast[k] == pytest.approx(slow[k], abs=1e-12) for k in fast)


def test_blocked_knn_equals_bruteforce(spark):
    from taxonomy_helpers import SF001
    from mvtax.sources.tables import embedding_matrix
    m = embedding_matrix(spark, SF001)
    fast = knn(m, k=7, group_cols=["label"], block_rows=16).collect()
    slow = knn_bruteforce(m, k=7, group_cols=["label"]).collect()
    key = lambda r: (r.label, r.src, r.rank)
    fa, sl = sorted(fast, key=key), sorted(slow, key=key)
    assert [(r.label, r.src, r.dst, r.rank) for r in fa] == [(r.label, r.src, r.dst, r.rank) for r in sl]
    assert all(a.dist == pytest.approx(b.dist, abs=1e-12) for a, b in zip(fa, sl))


def test_lsh_knn_complete_and_close_to_exact(spark):
    from taxonomy_helpers import SF001
    from mvtax.operators.knn import knn_lsh
    from mvtax.sources.tables import embedding_matrix
    m = embedding_matrix(spark, SF001)
    exact = {(r.src, r.dst): r.dist for r in knn(m, k=5).collect()}
    # a neighbour at angle t shares a bucket of one table with p = (1 - t/pi)^bits; here cos ~ .33
    # (t ~ 1.23), so 8 tables x 2 bits give expected recall 1 - (1 - .61^2)^8 ~ .97
    approx = knn_lsh(m, k=5, tables=8, bits=2).collect()
    per_src = {}
    for r in approx:
        per_src.setdefault(r.src, []).append(r)
    assert len(per_src) == m.count() and all(len(v) == 5 for v in per_src.values())
    hits = [r for r in approx if (r.src, r.dst) in exact]
    assert all(r.dist == pytest.approx(exact[(r.src, r.dst)], abs=1e-12) for r in hits)
    assert len(hits) / len(exact) >= 0.85


def test_knn_of_equal_vectors_gives_the_lowest_ids(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(120)], "id long, vec array<double>")
    got = knn(df, k=5, block_rows=32)
    near = {}
    for r in got.collect():
        near.setdefault(r["src"], []).append((r["rank"], r["dst"]))
    for i in range(120):
        assert [d for _, d in sorted(near[i])] == [j for j in range(7) if j != i][:5]


def test_knn_streams_references_past_query_blocks(spark, monkeypatch):
    """Many query blocks, bounds of single precision, vectors of any length, null groups, few queries: as by brute force; no
    candidates move after the products, and a Python worker gets small batches whatever a pack holds."""
    from mvtax.operators import knn as K
    monkeypatch.setattr(K, "QUERY_ROWS", 48)
    monkeypatch.setattr(K, "TILE", 1 << 9)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rng = np.random.default_rng(3)
    rows = [(None if i % 50 == 7 else "ab"[i % 3 == 0], int(i), (rng.integers(-2, 3, 5) * 10.0 ** (i % 4)).tolist(), i % 4 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, id long, vec array<double>, q boolean")
    for normalize in (True, False):
        got = knn(df, k=9, group_cols=["g"], block_rows=16, normalize=normalize)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
        want = knn_bruteforce(df, k=9, group_cols=["g"], normalize=normalize)
        key = lambda r: (r.g, r.src, r["rank"])
        got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
        assert [key(r) for r in got] == [key(r) for r in want]
        assert np.allclose([r.dist for r in got], [r.dist for r in want], rtol=1e-12, atol=1e-12)
        few = knn(df, k=9, group_cols=["g"], block_rows=16, normalize=normalize, query_col="q").collect()
        assert {(r.src, r.dst, r["rank"]) for r in few} == {(r.src, r.dst, r["rank"]) for r in got if r.src % 4 == 0}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 8 << 20


def test_lsh_knn_is_the_best_of_the_buckets_formed_once(spark):
    """Each row's nearest of all rows that share a bucket of any table; what is returned no longer holds the buckets' products."""
    from mvtax.operators.knn import _planes, knn_lsh
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6))
    df = spark.createDataFrame([("ab"[i % 3 == 0], i, v.tolist()) for i, v in enumerate(x)], "g string, id long, vec array<double>")
    out = knn_lsh(df, k=4, group_cols=["g"], tables=3, bits=3, block_rows=32)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 1  # rows left short, if any
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    code = (u @ _planes(spark, 6, 3, 3, 42) >= 0).reshape(300, 3, 3) @ (1 << np.arange(3))
    want = {}
    for i in range(300):
        group = [j for j in range(300) if j != i and (j % 3 == 0) == (i % 3 == 0)]
        cand = [j for j in group if (code[i] == code[j]).any()]
        order = sorted((round(1 - float(u[i] @ u[j]), 12), j) for j in (cand if len(cand) >= 4 else group))
        want[i] = [j for _, j in order[:4]]
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.src, r["rank"])):
        got.setdefault(r.src, []).append(r.dst)
    assert got == want


def test_knn_groups_share_the_tasks(spark, monkeypatch):
    """Many groups have as many query blocks as the tasks take together: each block is a copy of its group that moves."""
    from mvtax.operators import knn as K
    packs = []
    monkeypatch.setattr(K, "cut_lineage", lambda df: packs.append(cut(df)) or packs[-1])
    cut = __import__("mvtax.session", fromlist=["x"]).cut_lineage
    df = spark.createDataFrame([(i % 16, i, [float(i % 7), float(i % 11), 1.0]) for i in range(3200)], "g int, id long, vec array<double>")
    got = knn(df, k=3, group_cols=["g"], block_rows=8)
    blocks = sum(r.q for r in packs[0].groupBy("g").agg({"_nq": "max"}).toDF("g", "q").collect())
    assert blocks <= K.TASKS_PER_CORE ** 2 * spark.sparkContext.defaultParallelism
    key = lambda r: (r.g, r.src, r["rank"])
    want = knn_bruteforce(df, k=3, group_cols=["g"])
    assert [(*key(r), r.dst) for r in sorted(got.collect(), key=key)] == [(*key(r), r.dst) for r in sorted(want.collect(), key=key)]
