"""Graph algebra on edge tables.

A graph is a DataFrame ``(*keys, src, dst, w)``; ``keys`` are the group columns plus
``view`` and ``k`` while per-view, per-scale graphs are built. All k of a k-set come from
one kNN run at the group's largest k (``rank <= k`` slices it: W1 is a total order, so
the result equals a separate run per k).

The fused output is the affinity ``A = sum_v w_v * mean_k D^-1/2 W D^-1/2``; the
Laplacian is ``L = diag(sum_v w_v) - A`` (the diagonal is 1 when the weights sum to 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, TaxonomyConfig
from ..functions.params import adaptive_kset_col, clamp_kset_col, single_group
from ..session import cut_lineage
from .knn import knn, knn_lsh

G0 = "_g0"  # constant group key when the caller has no group columns


def explode_kset(nbr: DataFrame, kset: DataFrame, group_cols) -> DataFrame:
    """kNN at max k  x  per-group k-set -> ``(*group, view, k, src, dst, dist, rank)``, rank <= k."""
    g = list(group_cols)
    ks = kset.select(*g, F.explode(F.array_distinct("kset")).alias("k"))
    return nbr.join(ks, g).where(F.col("rank") <= F.col("k"))


def local_scale(e: DataFrame, keys, sigma_k: int = 7) -> DataFrame:
    """sigma_i = distance to the neighbour of rank min(sigma_k, k), plus 1e-12."""
    return (e.where(F.col("rank") == F.least(F.lit(sigma_k), F.col("k")))
             .select(*keys, F.col("src").alias("id"), (F.col("dist") + F.lit(1e-12)).alias("sigma")))


def heat_affinity(e: DataFrame, keys, sigma_k: int = 7) -> DataFrame:
    """G1: directed ``w_ij = exp(-d_ij^2 / (sigma_i sigma_j))`` on kNN edges i -> j."""
    s = local_scale(e, keys, sigma_k)
    si = s.select(*keys, F.col("id").alias("src"), F.col("sigma").alias("si"))
    sj = s.select(*keys, F.col("id").alias("dst"), F.col("sigma").alias("sj"))
    return (e.join(si, keys + ["src"]).join(sj, keys + ["dst"])
             .select(*keys, "src", "dst",
                     F.exp(-(F.col("dist") * F.col("dist")) / (F.col("si") * F.col("sj"))).alias("w")))


def mutualize(h: DataFrame, keys) -> DataFrame:
    """``min(W, W^T)``; an edge survives only if both directions exist."""
    rev = h.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("w").alias("w2"))
    return h.join(rev, keys + ["src", "dst"]).select(*keys, "src", "dst", F.least("w", "w2").alias("w"))


def symmetrize_max(w: DataFrame, keys) -> DataFrame:
    """``max(W, W^T)``."""
    both = w.select(*keys, "src", "dst", "w").unionByName(
        w.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy(*keys, "src", "dst").agg(F.max("w").alias("w"))


def snn_graph(e: DataFrame, keys) -> DataFrame:
    """On each kNN edge i -> j, ``|N_i & N_j| / k`` when positive; then max-symmetrised."""
    nb = e.groupBy(*keys, "src").agg(F.collect_list("dst").alias("nbrs"))
    ni = nb.select(*keys, "src", F.col("nbrs").alias("ni"))
    nj = nb.select(*keys, F.col("src").alias("dst"), F.col("nbrs").alias("nj"))
    sim = (e.where(F.col("src") != F.col("dst"))
            .join(ni, keys + ["src"]).join(nj, keys + ["dst"])
            .select(*keys, "src", "dst",
                    (F.size(F.array_intersect("ni", "nj")).cast("double") / F.col("k")).alias("w"))
            .where(F.col("w") > 0))
    return symmetrize_max(sim, keys)


def blend(mutual: DataFrame, snn: DataFrame, keys, wm: float = 0.65, ws: float = 0.35) -> DataFrame:
    """``wm * Wm + ws * Wsnn`` over the union of edges."""
    u = (mutual.select(*keys, "src", "dst", (F.col("w") * wm).alias("w"))
         .unionByName(snn.select(*keys, "src", "dst", (F.col("w") * ws).alias("w"))))
    return u.groupBy(*keys, "src", "dst").agg(F.sum("w").alias("w"))


def degree(w: DataFrame, keys) -> DataFrame:
    """A4: row sums."""
    return w.groupBy(*keys, "src").agg(F.sum("w").alias("deg"))


def normalize_sym(w: DataFrame, keys) -> DataFrame:
    """``D^-1/2 W D^-1/2`` (off-diagonal of ``I - L``); degrees floored at 1e-12."""
    d = degree(w, keys)
    di = d.select(*keys, "src", F.col("deg").alias("di"))
    dj = d.select(*keys, F.col("src").alias("dst"), F.col("deg").alias("dj"))
    return (w.join(di, keys + ["src"]).join(dj, keys + ["dst"])
             .select(*keys, "src", "dst",
                     (F.col("w") / F.sqrt(F.greatest("di", F.lit(1e-12)))
                      / F.sqrt(F.greatest("dj", F.lit(1e-12)))).alias("w")))


def scale_graphs(e: DataFrame, keys, cfg: TaxonomyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per (view, k): heat -> mutual, SNN, blend, normalise. ``keys`` ends with ``view, k``."""
    h = heat_affinity(e, keys, cfg.sigma_k)
    m = mutualize(h, keys)
    s = snn_graph(e, keys)
    return normalize_sym(blend(m, s, keys, cfg.mutual_weight, cfg.snn_weight), keys)


def multi_scale(a: DataFrame, kset: DataFrame, group_cols) -> DataFrame:
    """Mean over the group's (clamped, de-duplicated) k-set; absent entries count as 0."""
    g = list(group_cols)
    nk = kset.select(*g, F.size(F.array_distinct("kset")).alias("_nk"))
    s = a.groupBy(*g, "view", "src", "dst").agg(F.sum("w").alias("w"))
    s = s.join(nk, g)
    return s.select(*g, "view", "src", "dst", (F.col("w") / F.col("_nk")).alias("w"))


def view_weight_col(weights: dict):
    m = F.create_map(*[x for kv in weights.items() for x in (F.lit(kv[0]), F.lit(float(kv[1])))])
    return F.coalesce(m[F.col("view")], F.lit(0.0))


def fuse_views(av: DataFrame, group_cols, weights: dict) -> DataFrame:
    """``sum_v w_v A_v``."""
    g = list(group_cols)
    return (av.withColumn("_wv", view_weight_col(weights))
              .groupBy(*g, "src", "dst").agg(F.sum(F.col("_wv") * F.col("w")).alias("w")))


def group_params(vectors: DataFrame, group_cols, base_k, id_col: str = "id") -> DataFrame:
    """Per group: ``n`` and the clamped adaptive k-set (M8, M9); groups with n <= 2 have no graph."""
    g = list(group_cols)
    n = vectors.select(*g, id_col).distinct().groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
    return (n.withColumn("kset", clamp_kset_col(adaptive_kset_col("n", base_k), "n"))
             .withColumn("kmax", F.array_max("kset")))


def node_table(nbr: DataFrame, kset: DataFrame, group_cols, sigma_k: int = 7) -> DataFrame:
    """Per (group, view, k, vertex): its k nearest neighbours ``nb`` (ordered), their ids ``ids`` and
    the local scale ``sig`` (W2). One aggregation; each list is bounded by k."""
    g = list(group_cols)
    ks = kset.select(*g, F.explode(F.array_distinct("kset")).alias("k"))
    e = nbr.join(ks, g).where(F.col("rank") <= F.col("k"))
    node = (e.groupBy(*g, "view", "k", "src")
             .agg(F.sort_array(F.collect_list(F.struct("rank", "dst", "dist"))).alias("nb"),
                  F.max(F.when(F.col("rank") == F.least(F.lit(sigma_k), F.col("k")), F.col("dist"))).alias("sig")))
    return node.select(*g, "view", "k", "src", "nb", F.transform("nb", lambda x: x["dst"]).alias("ids"),
                       (F.col("sig") + F.lit(1e-12)).alias("sig"))


def blended_edges(node: DataFrame, keys, wm: float = 0.65, ws: float = 0.35) -> DataFrame:
    """G1-G4 in one join: each kNN edge i -> j meets j's row, which gives sigma_j, N_j and (if i is
    in N_j) the reverse distance. ``W = wm * min(w_ij, w_ji) + ws * |N_i & N_j| / k``.
    Each unordered pair is emitted once per orientation: by its lower-id end when mutual,
    else by its only directed edge."""
    ed = (node.select(*keys, "src", F.col("sig").alias("si"), F.col("ids").alias("ni"), F.explode("nb").alias("x"))
              .select(*keys, "src", F.col("x.dst").alias("dst"), F.col("x.dist").alias("dij"), "si", "ni"))
    nj = node.select(*keys, F.col("src").alias("dst"), F.col("sig").alias("sj"), F.col("ids").alias("nj"),
                     F.col("nb.dist").alias("dj"))
    j = ed.join(nj, keys + ["dst"])
    dji = F.get("dj", (F.array_position("nj", F.col("src")) - 1).cast("int"))  # null where src is not in nj
    wij = F.exp(-(F.col("dij") * F.col("dij")) / (F.col("si") * F.col("sj")))
    wji = F.exp(-(dji * dji) / (F.col("sj") * F.col("si")))
    snn = F.size(F.array_intersect("ni", "nj")).cast("double") / F.col("k")
    mutual = F.when(dji.isNotNull(), F.least(wij, wji)).otherwise(F.lit(0.0))  # least() skips NULLs
    w = mutual * F.lit(wm) + snn * F.lit(ws)
    j = j.select(*keys, "src", "dst", dji.isNull().alias("_one"), w.alias("w"))
    j = j.where((F.col("_one") | (F.col("src") < F.col("dst"))) & (F.col("w") > 0))
    both = F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")),
                             F.struct(F.col("dst").alias("a"), F.col("src").alias("b"))))
    return (j.select(*keys, "w", both.alias("p"))
             .select(*keys, F.col("p.a").alias("src"), F.col("p.b").alias("dst"), "w"))


def fused_affinity(views: DataFrame, group_cols=(), base_k=(6, 8, 10), params: DataFrame | None = None,
                   cfg: TaxonomyConfig = DEFAULT_CONFIG, id_col: str = "id") -> DataFrame:
    """E2 graph stage for all groups at once: views ``(*group, id, view, vec)`` ->
    ``(*group, src, dst, w)`` holding the off-diagonal of ``I - L``.

    kNN once per (group, view) at the group's largest k, checkpointed (it feeds two
    branches); per k the node table and one self-join give the blended graph; degrees and
    the symmetric normalisation are one aggregate and two joins; the k-mean (G6) and the
    view weighting (G7) are linear, so they fold into one final aggregate."""
    g = list(group_cols)
    if not g:
        views, g = views.withColumn(G0, single_group(id_col)), [G0]
        if params is not None:
            params = params.withColumn(G0, F.lit(0))
    p = params if params is not None else group_params(views, g, base_k, id_col)
    p = p.where(F.col("n") > 2).select(*g, "kset", "kmax")
    vk = views.join(p.select(*g, "kmax"), g)
    if cfg.knn_method == "lsh":  # opt-in approximate tier; k = the largest k of any group
        kmax = int(p.agg(F.max("kmax")).first()[0] or 1)
        nbr = knn_lsh(vk, k=kmax, id_col=id_col, vec_col="vec", group_cols=g + ["view"],
                      tables=cfg.lsh_tables, bits=cfg.lsh_bits, block_rows=cfg.knn_block_rows)
    else:
        nbr = knn(vk, id_col=id_col, vec_col="vec", group_cols=g + ["view"], k_col="kmax",
                  block_rows=cfg.knn_block_rows)
    node = cut_lineage(node_table(nbr, p, g, cfg.sigma_k))
    keys = g + ["view", "k"]
    # written once: the degrees and the edges are read from it
    a = normalize_sym(cut_lineage(blended_edges(node, keys, cfg.mutual_weight, cfg.snn_weight)), keys)
    nk = p.select(*g, F.size(F.array_distinct("kset")).alias("_nk"))
    out = (a.join(nk, g).withColumn("_wv", view_weight_col(cfg.view_weights))
            .groupBy(*g, "src", "dst").agg(F.sum(F.col("_wv") * F.col("w") / F.col("_nk")).alias("w")))
    return out.drop(G0) if G0 in g else out
