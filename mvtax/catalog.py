"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) in full.
Doubles are rounded to 4 places (``+ 0.0`` folds ``-0.0``) so the SQL oracle can
compare values; the SQL twin of each query lives in :mod:`mvtax.oracle`.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import BASE_K_BROAD, DEFAULT_CONFIG
from .functions import params as P
from .functions import text as T
from .functions.vector import l2_normalize
from .operators import graph as G
from .operators.knn import knn
from .session import cut_lineage
from .sources.tables import embedding_matrix, embedding_views

KNN_K = 10
GRAPH_K = 10
MULTI_KSET = (5, 7, 9)


def r4(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 4) + F.lit(0.0)


# ---------------------------------------------------------------- vectors / graph

def _full_view(spark, sf):
    m = embedding_matrix(spark, sf)
    return m.select("id", F.lit("all").alias("view"), l2_normalize("vec").alias("vec"))


def q_l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    m = embedding_matrix(spark, sf)
    z = m.select("id", F.posexplode(l2_normalize("vec")).alias("pos", "x"))
    return z.select("id", F.col("pos").cast("long").alias("pos"), r4("x").alias("x"))


def q_knn(spark, sf):
    e = knn(embedding_matrix(spark, sf), k=KNN_K)
    return e.select("src", "dst", F.col("rank").cast("long").alias("rank"), r4("dist").alias("dist"))


def q_knn_lsh(spark, sf):
    """J4 approximate tier (opt-in): every row still gets exactly k neighbours with exact distances, and of the exact
    join's neighbours at least nine in ten are among them. Every row is searched for by the index; recall is measured
    against brute force on the searches' query set, every row whose id is divisible by 100, against all rows."""
    from .operators.knn import knn_lsh
    m = embedding_matrix(spark, sf)
    e = cut_lineage(knn_lsh(m, k=KNN_K, tables=8, bits=2))
    exact = knn(m.withColumn("asked", F.col("id") % 100 == 0), k=KNN_K, query_col="asked").select("src", "dst")
    same = exact.join(e.select("src", "dst", F.lit(1).alias("hit")), ["src", "dst"], "left")
    found, wanted = same.agg(F.count("hit"), F.count(F.lit(1))).first()
    a = m.select(F.col("id").alias("src"), l2_normalize("vec").alias("va"))
    b = m.select(F.col("id").alias("dst"), l2_normalize("vec").alias("vb"))
    from .functions.vector import dot
    off = F.abs(F.col("dist") - (1.0 - dot("va", "vb")))
    return e.join(a, "src").join(b, "dst").groupBy("src").agg(
        F.countDistinct("dst").alias("neighbours"), F.max("rank").cast("long").alias("last_rank"),
        F.sum((F.col("src") == F.col("dst")).cast("long")).alias("selves"), r4(F.max(off)).alias("distance_error")).withColumn(
        "recall_ok", F.lit(found >= 0.9 * wanted))


def _single_scale(spark, sf, k=GRAPH_K):
    v = _full_view(spark, sf).withColumn("_g0", P.single_group("id"))
    nbr = cut_lineage(knn(v, k=k, group_cols=["_g0", "view"]))  # read by scales, weights and neighbour lists
    return nbr.withColumn("k", F.lit(k)), ["_g0", "view", "k"]


def q_local_scale(spark, sf):
    e, keys = _single_scale(spark, sf)
    return G.local_scale(e, keys).select("id", r4("sigma").alias("sigma"))


def _edges_out(df):
    return df.select("src", "dst", r4("w").alias("w"))


def q_heat_affinity(spark, sf):
    e, keys = _single_scale(spark, sf)
    return _edges_out(G.heat_affinity(e, keys))


def q_mutual_knn(spark, sf):
    e, keys = _single_scale(spark, sf)
    return _edges_out(G.mutualize(G.heat_affinity(e, keys), keys))


def q_snn_graph(spark, sf):
    e, keys = _single_scale(spark, sf)
    return _edges_out(G.snn_graph(e, keys))


def _blend(spark, sf):
    e, keys = _single_scale(spark, sf)
    m = G.mutualize(G.heat_affinity(e, keys), keys)
    return G.blend(m, G.snn_graph(e, keys), keys), keys


def q_affinity_blend(spark, sf):
    b, _ = _blend(spark, sf)
    return _edges_out(b)


def q_degree(spark, sf):
    b, keys = _blend(spark, sf)
    return G.degree(b, keys).select(F.col("src").alias("id"), r4("deg").alias("deg"))


def q_laplacian(spark, sf):
    """Nonzeros of ``L = I - D^-1/2 W D^-1/2`` (diagonal included, isolated vertices too)."""
    b, keys = _blend(spark, sf)
    b = cut_lineage(b)  # read by degrees and edges
    off = G.normalize_sym(b, keys).select("src", "dst", (-F.col("w")).alias("l"))
    diag = embedding_matrix(spark, sf).select(F.col("id").alias("src"), F.col("id").alias("dst"),
                                              F.lit(1.0).alias("l"))
    return off.unionByName(diag).select("src", "dst", r4("l").alias("l"))


def q_multi_scale(spark, sf):
    v = _full_view(spark, sf).withColumn("_g0", P.single_group("id"))
    kset = v.select("_g0").distinct().withColumn("kset", F.array(*[F.lit(k) for k in MULTI_KSET]))
    nbr = cut_lineage(knn(v, k=max(MULTI_KSET), group_cols=["_g0", "view"]))
    e = G.explode_kset(nbr, kset, ["_g0"])
    a = G.scale_graphs(e, ["_g0", "view", "k"])
    return _edges_out(G.multi_scale(a, kset, ["_g0"]))


def q_view_fusion(spark, sf):
    return _edges_out(G.fused_affinity(embedding_views(spark, sf), base_k=BASE_K_BROAD))


def q_adaptive_kset(spark, sf):
    """M8 + M9 per label group of ``embeddings``, for all three level bases."""
    m = embedding_matrix(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    out = []
    for lvl, base in (("Broad", (6, 8, 10)), ("Sub", (8, 12, 18)), ("Niche", (6, 10, 14))):
        ks = P.clamp_kset_col(P.adaptive_kset_col("n", base), "n")
        out.append(m.select(F.col("label").cast("long").alias("label"), F.lit(lvl).alias("level"),
                            F.col("n").cast("long").alias("n"), F.array_join(ks, ",").alias("kset")))
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---------------------------------------------------------------- spectral, k choice, levels (rows + properties)

def _broad_inputs(spark, sf):
    from .config import BROAD
    from .functions.params import eig_width_col
    from .session import cut_lineage
    v = embedding_views(spark, sf).withColumn("_root", P.single_group("id"))
    p = G.group_params(v, ["_root"], BROAD.base_k).withColumn("width", eig_width_col(14, "n", 48))
    return v, cut_lineage(p)


def _broad_embedding(spark, sf):
    from .operators.spectral import spectral_embed
    from .session import cut_lineage
    v, p = _broad_inputs(spark, sf)
    aff = cut_lineage(G.fused_affinity(v, ["_root"], params=p))
    verts = v.where(F.col("view") == "v1").select("_root", "id").join(p.select("_root", "width"), "_root")
    return cut_lineage(spectral_embed(aff, verts, ["_root"]))


def _norm(c: str):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))


def q_spectral_embed(spark, sf):
    """G8 on the Broad graph of all rows: width, unit rows, ascending eigenvalues and the residual bound."""
    z = _broad_embedding(spark, sf)
    rising = F.size(F.filter(F.sequence(F.lit(2), F.size("eigval")),
                             lambda i: F.element_at("eigval", i) < F.element_at("eigval", i - 1) - 1e-9))
    return z.select("id", F.size("z").cast("long").alias("width"), r4(_norm("z")).alias("norm"),
                    rising.cast("long").alias("out_of_order"), r4("residual").alias("residual"))


def q_spectral_distributed(spark, sf):
    """G8 for all label groups of ``embeddings`` in one plan, checked against the graph itself: per group the
    eigenpairs with ``|A x - a x| <= 1e-4`` and the pairs of orthonormal vectors, by joins over the edges."""
    from .operators.spectral import spectral_embed
    from .session import cut_lineage
    m = embedding_matrix(spark, sf).select(F.col("label").cast("int").alias("g"), "id", F.lit("v1").alias("view"), l2_normalize("vec").alias("vec"))
    p = cut_lineage(G.group_params(m, ["g"], (6, 8, 10)).withColumn("width", F.least(F.lit(6), F.col("n") - 1).cast("int")))
    aff = cut_lineage(G.fused_affinity(m, ["g"], params=p, cfg=replace(DEFAULT_CONFIG, view_weights={"v1": 1.0})))
    z = cut_lineage(spectral_embed(aff, m.select("g", "id").join(p.select("g", "width"), "g"), ["g"], raw=True))
    x = z.select("g", "id", "eigval", F.posexplode("x").alias("j", "x")).withColumn("a", 1.0 - F.element_at("eigval", F.col("j") + 1))
    ax = (aff.join(x.select("g", F.col("id").alias("dst"), "j", "x"), ["g", "dst"])
             .groupBy("g", F.col("src").alias("id"), "j").agg(F.sum(F.col("w") * F.col("x")).alias("ax")))
    gap = F.coalesce("ax", F.lit(0.0)) - F.col("a") * F.col("x")
    good = (x.join(ax, ["g", "id", "j"], "left").groupBy("g", "j").agg(F.sqrt(F.sum(gap * gap)).alias("r"))
             .groupBy("g").agg(F.sum((F.col("r") <= 1e-4).cast("long")).alias("eigenpairs")))
    y = x.select("g", "id", F.col("j").alias("i"), F.col("x").alias("y"))
    dots = x.join(y, ["g", "id"]).where("i <= j").groupBy("g", "i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("d"))
    near = F.abs(F.col("d") - (F.col("i") == F.col("j")).cast("double")) <= 1e-6
    ortho = dots.groupBy("g").agg(F.sum(near.cast("long")).alias("orthonormal"))
    n = z.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    return n.join(good, "g").join(ortho, "g").select(F.col("g").cast("long").alias("label"), "n", "eigenpairs", "orthonormal")


def _scatter(x: DataFrame, labels: DataFrame, label: str):
    """Sum of squared distances of the rows ``(id, vec)`` to the mean of their cluster: of one label for all it is the total
    scatter, so a labelling that says nothing does not lower it."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    j = x.join(labels.select("id", F.col(label).alias("_l")), "id").withColumn("_v", array_to_vector("vec"))
    per = j.groupBy("_l").agg(Summarizer.metrics("variance", "count").summary(F.col("_v")).alias("s"))
    from pyspark.ml.functions import vector_to_array
    var = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, v: a + v)
    return per.agg(F.sum(F.when(F.col("s.count") > 1, var * (F.col("s.count") - 1)).otherwise(0.0))).first()[0] or 0.0


def q_choose_k(spark, sf):
    """C1 on the Broad embedding: every candidate k, with what its score is beyond the sum of its parts
    (0), whether silhouette, largest share and imbalance lie in their ranges, and the silhouette's distance (0) from the mean
    silhouette (A15) of labels fitted for that k alone."""
    from .config import BROAD
    from .operators.cluster import silhouette
    from .operators.kmeans import choose_k, kmeans_groups
    from .session import cut_lineage
    z = _broad_embedding(spark, sf).select("_root", "id", "z")
    sc = choose_k(z, ["_root"], BROAD, return_scores=True)
    parts = F.col("sil") + 0.13 * F.log("k") - 0.07 * F.col("imb") - F.when(F.col("big_frac") > BROAD.max_big_frac, 0.35).otherwise(0.0)
    ranges = F.col("sil").between(-1, 1) & F.col("big_frac").between(1 / F.col("k"), 1) & F.col("imb").between(0, F.sqrt(F.col("k") - 1.0))
    sc = cut_lineage(sc)
    ks = cut_lineage(sc.select(F.col("k").alias("kk"), "k"))
    each = cut_lineage(z.select("id", "z").join(F.broadcast(ks.select("kk")), F.col("kk") <= F.size("z")))  # the rows once for each k
    lab = cut_lineage(kmeans_groups(each, ks, ["kk"]))
    unit = each.select("kk", "id", l2_normalize(F.slice("z", 1, F.col("kk"))).alias("vec"))
    own = silhouette(unit, lab, ["kk"]).groupBy("kk").agg(F.avg("s").alias("own"))
    return sc.join(own, sc["k"] == own["kk"]).select(F.col("k").cast("long"), r4(F.col("score") - parts).alias("beyond_parts"), ranges.alias("in_range"),
                                                     r4(F.col("sil") - F.col("own")).alias("silhouette_gap"))


def q_kmeans_level(spark, sf):
    """C2, k = 10 on the Broad embedding: per row its cluster's place in the order of smallest ids against its
    label (0), whether it is farther from its cluster's mean than from another mean (Lloyd's fixed point), how many
    clusters there are, and whether they take a quarter off the scatter of the rows about one mean."""
    from pyspark.sql import Window
    from .functions.vector import sq_norm
    from .operators.cluster import centroids
    from .operators.kmeans import kmeans_groups
    from .session import cut_lineage
    z = _broad_embedding(spark, sf).select("_root", "id", "z")
    ks = z.select("_root").distinct().withColumn("k", F.lit(10))
    lab = cut_lineage(kmeans_groups(z, ks, ["_root"]))
    first = lab.groupBy("label").agg(F.min("id").alias("first"))
    first = first.withColumn("place", F.row_number().over(Window.orderBy("first")) - 1)  # one row a cluster
    x = z.select("_root", "id", F.slice("z", 1, 10).alias("vec"))
    c = centroids(x, lab, ["_root"], normalize=False).groupBy("_root").agg(F.collect_list(F.struct("label", "mean")).alias("cs"))
    d = F.transform("cs", lambda s: F.struct(s["label"].alias("l"), sq_norm(F.zip_with("vec", s["mean"], lambda p, q: p - q)).alias("d")))
    own = F.filter(d, lambda s: s["l"] == F.col("label"))[0]["d"]
    far = own - F.array_min(F.transform(d, lambda s: s["d"])) > 1e-2
    used = lab.select("label").distinct().count()
    tight = _scatter(x.select("id", "vec"), lab, "label") <= 0.75 * _scatter(x.select("id", "vec"), lab.withColumn("one", F.lit(0)), "one")
    return (x.join(lab, ["_root", "id"]).join(c, "_root").join(first.select("label", "place"), "label")
             .select("id", (F.col("label") - F.col("place")).cast("long").alias("label_gap"), far.alias("far"),
                     F.lit(used).cast("long").alias("clusters"), F.lit(tight).alias("tight")))


def q_sample_cap(spark, sf):
    """Per label group, a uniform sample of min(n, 20) rows (a sampling operator: the cap is the feature);
    rows and distinct ids drawn per group."""
    from .operators.cluster import sample_cap
    m = embedding_matrix(spark, sf).select(F.col("label").alias("g"), "id", "vec")
    return (sample_cap(m, ["g"], cap=20).groupBy(F.col("g").cast("long").alias("label"))
            .agg(F.count(F.lit(1)).alias("drawn"), F.countDistinct("id").alias("ids")))


def _dense_gaps(df, col: str):
    """Largest label + 1 minus the number of distinct labels: 0 if labels are 0..m-1."""
    return df.agg((F.max(col) + 1 - F.countDistinct(col)).cast("long").alias("gap"))


def _first_view(spark, sf):
    return embedding_views(spark, sf).where(F.col("view") == "v1").select("id", "vec")


def q_run_level(spark, sf):
    """C7 on all rows: one label a row; labels dense; no cluster below the level's minimum beside larger ones; more than
    one cluster, and the rows of the first view nearer to their clusters' means than to one mean."""
    from .config import BROAD
    from .plans.level import run_level
    v = embedding_views(spark, sf).withColumn("_root", P.single_group("id"))
    lab, _ = run_level(v, ["_root"], BROAD)
    sizes = lab.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    least = F.greatest(F.lit(BROAD.min_size_floor), F.floor(F.lit(BROAD.min_size_frac) * F.sum("c")))
    gap, ok, many = sizes.agg((F.max("label") + 1 - F.count("label")).cast("long"), (F.min("c") >= least) | (F.count("c") == 1), F.count("c") > 1).first()
    x = _first_view(spark, sf)
    tight = _scatter(x, lab, "label") <= 0.99 * _scatter(x, lab.withColumn("one", F.lit(0)), "one")
    return lab.select("id", F.lit(gap).alias("label_gap"), F.lit(ok).alias("sizes_ok"), F.lit(many).alias("several"), F.lit(tight).alias("tight"))


def q_hierarchy(spark, sf):
    """C8 on all rows: per row the parents its Sub and Niche clusters have, label gaps, padded widths equal per level, more
    clusters from level to level, and less scatter of the first view about their means."""
    from .plans.hierarchy import build_hierarchy
    h = build_hierarchy(embedding_views(spark, sf))
    per_sub = h.groupBy("cluster_sub").agg(F.countDistinct("cluster_broad").alias("sub_parents"))
    per_niche = h.groupBy("cluster_niche").agg(F.countDistinct("cluster_sub").alias("niche_parents"))
    levels = ("cluster_broad", "cluster_sub", "cluster_niche")
    gaps = h.agg(*[(F.max(c) + 1 - F.countDistinct(c)).cast("long").alias(f"{c}_gap") for c in levels],
                 *[F.countDistinct(F.size(c)).alias(f"{c}_widths") for c in ("broad_dims", "sub_dims", "niche_dims")],
                 *[F.countDistinct(c).alias(f"_{c}") for c in levels]).first().asDict()
    n = [gaps.pop(f"_{c}") for c in levels]
    x = _first_view(spark, sf)
    scatter = [_scatter(x, h.withColumn("one", F.lit(0)), "one"), *[_scatter(x, h, c) for c in levels]]
    flags = {"several": 1 < n[0] <= n[1] <= n[2], "tighter": scatter[1] <= 0.99 * scatter[0] and scatter[3] <= scatter[2] <= scatter[1] and scatter[3] <= 0.9 * scatter[0]}
    return (h.select("id", "cluster_sub", "cluster_niche").join(per_sub, "cluster_sub").join(per_niche, "cluster_niche").drop("cluster_sub", "cluster_niche")
             .select("*", *[F.lit(v).cast("long").alias(c) for c, v in gaps.items()], *[F.lit(v).alias(c) for c, v in flags.items()]))


def q_text_projection(spark, sf):
    """V2 of every whole document by the signed projection of an unbounded vocabulary: the values of all 32 coordinates."""
    from .operators.views import projected_vectors
    from .sources.tables import table
    z = projected_vectors(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "text", 32)
    z = z.select("id", F.posexplode("vec").alias("pos", "x"))
    return z.select("id", F.col("pos").cast("long").alias("pos"), r4("x").alias("x"))


def q_level_census(spark, sf):
    """A13 and A14 of the three levels of the records in one pass: distinct clusters and rows of each level, and its 20 largest."""
    from .operators.profile import level_census
    h = records_hierarchy(spark, sf)
    names = [F.concat(F.lit(f"{x} "), F.col(f"cluster_{x}")).alias(f"cluster_label_{x}") for x in ("broad", "sub", "niche")]
    return level_census(h.select("*", *names))


def _scratch(spark, name: str) -> str:
    """A new folder beside the session's checkpoints."""
    import uuid
    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_csv_scan(spark, sf):
    """S1 on all parts and customers, written as CSV and scanned: quoted line breaks and quotes stay, NA spellings become null."""
    from .sources.io import read_csv
    from .sources.tables import table
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name"),
                                        F.concat("p_brand", F.lit('\n"'), "p_type", F.lit('", x')).alias("about"),
                                        F.when(F.col("p_partkey") % 3 == 0, "NaN").when(F.col("p_partkey") % 3 == 1, "n/a").otherwise(F.col("p_type")).alias("kind"))
    c = table(spark, sf, "customer").select((-F.col("c_custkey")).cast("string").alias("key"), F.col("c_name").alias("name"),
                                            F.col("c_mktsegment").alias("about"), F.lit(None).cast("string").alias("kind"))
    path = _scratch(spark, "csv")
    p.unionByName(c).write.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    return read_csv(spark, path)


def q_cache_snapshots(spark, sf):
    """S4 and S5 on one path: every part's brand as its label, then the types of even keys appended by a run that reads the
    cache it writes to, an unfinished snapshot, a full snapshot and a last change; what a reader sees."""
    from .sources.io import append_label_cache, read_label_cache
    from .sources.tables import table
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("k"), "p_partkey").alias("cache_key"), "p_brand", "p_type")
    path = _scratch(spark, "cache")
    append_label_cache(p.select("cache_key", F.col("p_brand").alias("label")), path)
    kept = read_label_cache(spark, path)
    even = p.where("p_partkey % 2 = 0").select("cache_key", F.col("p_type").alias("label"))
    append_label_cache(kept.join(even.select("cache_key"), "cache_key", "left_anti").unionByName(even), path)
    p.select("cache_key", F.lit("lost").alias("label")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{path}/snapshot-00000003")  # as a killed write leaves it
    append_label_cache(read_label_cache(spark, path), path, full=True)
    append_label_cache(p.where("p_partkey % 10 = 0").select("cache_key", F.lit("tenth").alias("label")), path)
    return read_label_cache(spark, path).select("cache_key", "label")


def q_text_embed(spark, sf):
    """V2 default encoder on every whole document, then V3 to 64 dims."""
    from .operators.views import pca_reduce, tfidf_vectors
    from .sources.tables import table
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    z = pca_reduce(tfidf_vectors(d, "text", sparse=True), 64)
    return z.select("id", F.size("vec").cast("long").alias("width"),
                    r4(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))


def q_pca_views(spark, sf):
    """V4: the six record views encoded and reduced to their configured widths."""
    from .operators.views import build_views
    v = build_views(_kc(spark, sf))
    return v.select("id", "view", F.size("vec").cast("long").alias("width"))


def records_hierarchy(spark, sf):
    """A data-derived three-level assignment of the records: region -> nation -> (nation, segment),
    numbered like the clustering hierarchy (W8)."""
    from pyspark.sql import Window
    from .sources.tables import table
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    j = d.join(c, "id", "left").join(n, "c_nationkey", "left").select(
        "id", F.coalesce("n_regionkey", F.lit(-1)).alias("r"), F.coalesce("c_nationkey", F.lit(-1)).alias("nk"),
        F.coalesce("c_mktsegment", F.lit("")).alias("seg"))
    pairs = j.select("r", "nk", "seg").distinct()
    pairs = (pairs.withColumn("cluster_broad", F.dense_rank().over(Window.orderBy("r")) - 1)
                  .withColumn("cluster_sub", F.dense_rank().over(Window.orderBy("r", "nk")) - 1)
                  .withColumn("cluster_niche", F.dense_rank().over(Window.orderBy("r", "nk", "seg")) - 1))
    return j.join(pairs, ["r", "nk", "seg"]).select("id", "cluster_broad", "cluster_sub", "cluster_niche")


def q_label_levels(spark, sf):
    """R8, R9, R11 (+ R10 twice) on the records with a region / nation / segment hierarchy;
    a deterministic proposer names every tenth cluster id."""
    import pandas as pd
    from .plans.labeling import label_levels

    def proposer(contexts, levels, parents):
        first = contexts.str.split("\n").str[1].str.replace("Size: ", "", regex=False)
        return pd.Series([f"Size {s} Integrators" if int(s) % 10 == 0 else None for s in first])

    lab, _ = label_levels(_kc(spark, sf), records_hierarchy(spark, sf), proposer=proposer)
    return lab.select("id", "cluster_label_broad", "cluster_label_sub", "cluster_label_niche")


# ---------------------------------------------------------------- end to end

def taxonomy(spark, sf, cfg=DEFAULT_CONFIG):
    """Records (documents + customer + nation + part + pages) from their texts to names: six text views,
    three levels, labels; one row for every record."""
    from .operators.views import build_views
    from .plans.taxonomy import build_taxonomy
    rec = _kc(spark, sf)
    return build_taxonomy(rec, build_views(rec), cfg=cfg)[0]


def q_taxonomy(spark, sf):
    """E1 - E3 end to end: every record's base columns, and whether it has three names, cluster ids, level
    dims as columns and 32 location dims."""
    t = taxonomy(spark, sf)
    named = [F.coalesce(F.col(f"cluster_label_{x}") != "", F.lit(False)) for x in ("broad", "sub", "niche")]
    clustered = F.col("cluster_broad").isNotNull() & F.col("cluster_sub").isNotNull() & F.col("cluster_niche").isNotNull()
    dims = [F.size(F.array(*[c for c in t.columns if c.startswith(p) and c[len(p):].isdigit()])) == F.size(f"{x}_dims")
            for p, x in (("broad_dim", "broad"), ("sub_dim", "sub"), ("niche_dim", "niche"))]
    loc = sum(1 for c in t.columns if c.startswith("loc_dim"))
    from .session import cut_lineage
    t = cut_lineage(t)
    n = t.agg(*[F.countDistinct(f"cluster_{x}") for x in ("broad", "sub", "niche")]).first()
    return t.select("id", "company_name", F.col("loc_text").alias("location"), (named[0] & named[1] & named[2]).alias("named"), clustered.alias("clustered"),
                    (dims[0] & dims[1] & dims[2]).alias("dims_match"), F.lit(loc).cast("long").alias("loc_dims"),
                    F.lit(1 < n[0] <= n[1] <= n[2]).alias("several"))


def flagship(spark, sf):
    """The fused multi-view graph of all rows: six views, the adaptive k-set, one affinity. (The full
    ``taxonomy`` runs hundreds of jobs and is a query of its own.)"""
    return q_view_fusion(spark, sf)


# ---------------------------------------------------------------- text layer (records fixture)

def _records(spark, sf):
    from .sources.tables import records
    return records(spark, sf)


def q_select_known_columns(spark, sf):
    from .sources.io import known_columns
    return known_columns(_records(spark, sf))


def q_view_text(spark, sf):
    """The production view texts."""
    from .operators.views import view_text_columns
    return _kc(spark, sf).select("id", *[c.alias(v) for v, c in view_text_columns().items()])


def q_strip_scheme(spark, sf):
    from .sources.tables import table
    pg = table(spark, sf, "pages")
    return pg.select("page_id", "url", T.strip_scheme("url").alias("domain"))


def _kc(spark, sf):
    from .sources.io import known_columns
    return known_columns(_records(spark, sf))


def q_to_list(spark, sf):
    r = _kc(spark, sf)
    out = [F.col("id")]
    for c in ("keywords", "services", "roles", "business_model"):
        lst = T.to_list(c)
        out += [F.array_join(lst, "|").alias(f"{c}_items"), F.size(lst).cast("long").alias(f"{c}_n")]
    return r.select(*out)


def q_uniq_list(spark, sf):
    r = _kc(spark, sf)
    u = T.uniq(F.concat(T.to_list("services"), T.to_list("keywords"), T.to_list("roles"),
                        F.split("product_categories", " ")))
    return r.select("id", F.array_join(u, "|").alias("items"), F.size(u).cast("long").alias("n"))


def q_tokens(spark, sf):
    r = _kc(spark, sf)
    t = T.tokens("ai_summary")
    return r.select("id", F.size(t).cast("long").alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


def q_ngrams(spark, sf):
    """M5-M7 + W9 on every whole summary: gram counts and the most common gram."""
    from .operators.rules import gram_heads, repeated_keys, row_grams
    from .session import bound_batches
    bound_batches(spark)
    r = _kc(spark, sf).select("id", "ai_summary")
    g = r.select("id", row_grams(T.tokens("ai_summary")).alias("g")).select("id", "g.*")
    g = g.select("id", "n2", "n3", "n_kept", F.when(F.col("id").isNotNull(), F.col("head")).alias("top_gram"))
    again = repeated_keys(r.where(F.col("id").isNotNull()), ["id"])
    if again is not None:  # rows of one id share the head of all of them
        heads = gram_heads(r.join(again, "id", "left_semi"), ["id"], F.lower(F.col("ai_summary")))
        heads = again.join(heads, "id", "left").withColumn("of_all", F.lit(True))
        g = g.join(heads, "id", "left").withColumn("top_gram", F.when(F.col("of_all"), F.col("gram_head")).otherwise(F.col("top_gram")))
    return g.select("id", "n2", "n3", "n_kept", F.coalesce("top_gram", F.lit("")).alias("top_gram"))


def q_title_case(spark, sf):
    from .sources.tables import table
    p = table(spark, sf, "part")
    s = F.concat(F.lit(" "), F.col("p_name"), F.lit("/"), F.lower("p_type"), F.lit(" hvac-plc & "), F.col("p_brand"),
                 F.lit("\tscada "))
    return p.select("p_partkey", T.title_case_keep_acronyms(s).alias("title"))


def q_sanitize_label(spark, sf):
    from .sources.tables import table
    p = table(spark, sf, "part")
    s = F.concat(F.lit("- "), F.col("p_name"), F.lit(" "), F.upper("p_name"), F.lit(" Systems!! "), F.col("p_brand"),
                 F.lit(" (group) "), F.lower("p_type"), F.lit(" "), F.lower("p_type"), F.lit(" -"))
    return p.select("p_partkey", T.sanitize_label(s).alias("label"))


# ---------------------------------------------------------------- profiles (clusters = nations / regions)

def cluster_assign(spark, sf, level: str = "sub"):
    """Records grouped by their customer's nation (sub) or region (broad); -1 when unmatched."""
    from .sources.tables import table
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    j = d.join(c, "id", "left").join(n, "c_nationkey", "left")
    key = "c_nationkey" if level == "sub" else "n_regionkey"
    return j.select("id", F.coalesce(F.col(key), F.lit(-1)).cast("int").alias("cluster"))


def q_first_n(spark, sf):
    from .config import PROFILE_CAPS
    from .operators.profile import CAPPED_FIELDS, first_n
    r, a = _kc(spark, sf), cluster_assign(spark, sf)
    out = a.select("cluster").distinct()
    for name, col, keep in CAPPED_FIELDS:
        f = first_n(r, a, col, PROFILE_CAPS[name], keep, "cluster", name)
        out = out.join(f.select("cluster", F.array_join(name, "|").alias(name)), "cluster", "left")
    return out.select(F.col("cluster").cast("long").alias("cluster"),
                      *[F.coalesce(F.col(n), F.lit("")).alias(n) for n, _, _ in CAPPED_FIELDS])


def q_top_keywords(spark, sf):
    from .operators.profile import top_keywords
    t = top_keywords(_kc(spark, sf), cluster_assign(spark, sf), with_counts=True)
    return t.select(F.col("cluster").cast("long").alias("cluster"), F.col("_r").cast("long").alias("rank"),
                    "kw", F.col("cnt").cast("long").alias("cnt"))


def q_role_ratios(spark, sf):
    from .operators.profile import role_counts
    from .operators.rules import role_ratio_strings
    rc = role_counts(_kc(spark, sf), cluster_assign(spark, sf))
    return rc.select(F.col("cluster").cast("long").alias("cluster"),
                     F.array_join(F.transform("role_counts", lambda x: x.cast("string")), ",").alias("counts"),
                     F.col("role_total").cast("long").alias("total"),
                     F.array_join(role_ratio_strings("role_counts", "role_total"), ",").alias("ratios"))


def _profiles(spark, sf, level="Sub"):
    from .plans.labeling import labelled_profiles
    r = _kc(spark, sf)
    if level == "Broad":
        return labelled_profiles(r, cluster_assign(spark, sf, "broad").withColumnRenamed("cluster", "cid"),
                                 "Broad", None)
    subs = cluster_assign(spark, sf, "sub")
    bro = cluster_assign(spark, sf, "broad")
    par = (subs.join(bro.withColumnRenamed("cluster", "parent_id"), "id")
               .select(F.col("cluster").alias("cid"), "parent_id").distinct()
               .withColumn("parent_label", F.concat(F.lit("Region "), F.col("parent_id").cast("string"))))
    return labelled_profiles(r, subs.withColumnRenamed("cluster", "cid"), "Sub", par)


def q_cluster_profile(spark, sf):
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"), F.col("size").cast("long").alias("size"),
                    F.array_join("top_keywords", "|").alias("top_keywords"),
                    F.array_join("services", "|").alias("services"),
                    F.array_join("company_names", "|").alias("company_names"),
                    F.array_join("industries", "|").alias("industries"))


def q_census(spark, sf):
    from .operators.profile import census
    from .sources.tables import table
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    lab = c.join(n, "c_nationkey")  # every customer
    return census(lab, "c_nationkey", "n_name").select(F.col("c_nationkey").cast("long").alias("cluster"),
                                                       F.col("n_name").alias("name"),
                                                       F.col("count").cast("long").alias("count"))


# fitted sector rules for the synthetic vocabulary (the industrial defaults never match it)
FITTED_SECTORS = (
    (r"\b(ring|bolt|gear)\b", "Fasteners & Gears"),
    (r"\b(widget|gizmo)\b", "Widgets & Gadgets"),
    (r"\b(machinery|building)\b", "Machinery & Building"),
)
FITTED_UMBRELLAS = ("Fasteners & Gears", "Widgets & Gadgets", "Machinery & Building", "Household Goods")


def q_umbrella(spark, sf):
    from .operators.rules import umbrella_from_texts
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"),
                    umbrella_from_texts("texts").alias("default_rules"),
                    umbrella_from_texts("texts", FITTED_SECTORS).alias("fitted_rules"))


def q_enforce_umbrella(spark, sf):
    from .operators.rules import with_enforce_umbrella
    p = _profiles(spark, sf).withColumn("_l", F.coalesce(F.element_at(F.col("industries"), 1), F.lit("")))
    p = with_enforce_umbrella(p, "_l", "texts", "default_sector")
    p = with_enforce_umbrella(p, "_l", "texts", "fitted_sector", FITTED_SECTORS, FITTED_UMBRELLAS)
    p = with_enforce_umbrella(p, "head", "texts", "head_sector")
    return p.select(F.col("cid").cast("long").alias("cluster"), "default_sector", "fitted_sector", "head_sector")


def q_canonical_head(spark, sf):
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"), F.col("gram_head"), F.col("head"))


def q_role_suffix(spark, sf):
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"), "suffix")


def q_head_suffix(spark, sf):
    from .operators.rules import with_force_head_suffix
    p = _profiles(spark, sf)
    p = p.withColumn("_raw", F.coalesce(F.concat(F.element_at("services", 1),
                                                 F.lit(" Integrators and suppliers & distributors")), F.lit("")))
    p = with_force_head_suffix(p, "_raw", "Sub", "head", "suffix", "texts", "sub_label")
    p = with_force_head_suffix(p, "head", "Broad", "head", "suffix", "texts", "broad_label")
    return p.select(F.col("cid").cast("long").alias("cluster"), "sub_label", "broad_label")


def q_fallback_label(spark, sf):
    pb = _profiles(spark, sf, "Broad").select(F.col("cid").cast("long").alias("cluster"), F.lit("Broad").alias("level"),
                                              F.col("fallback").alias("label"))
    ps = _profiles(spark, sf).select(F.col("cid").cast("long").alias("cluster"), F.lit("Sub").alias("level"),
                                     F.col("fallback").alias("label"))
    return pb.unionByName(ps)


def q_cache_key(spark, sf):
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"), "cache_key")


def q_context_text(spark, sf):
    from .operators.rules import context_text
    p = _profiles(spark, sf)
    return p.select(F.col("cid").cast("long").alias("cluster"), context_text("Sub", "parent_label").alias("context"))


def q_sibling_dedupe(spark, sf):
    from .operators.rules import sibling_dedupe
    p = _profiles(spark, sf)
    lab = p.select("cid", "parent_id", F.col("fallback").alias("label"))
    d = sibling_dedupe(lab, p, "parent_id", "cid")
    return d.select(F.col("cid").cast("long").alias("cluster"), F.col("parent_id").cast("long").alias("parent"),
                    "label")


def q_label_attach(spark, sf):
    """J1 + J2: every record gets its nation's rule label and its region's rule label."""
    ps = _profiles(spark, sf).select(F.col("cid").alias("cluster"), F.col("fallback").alias("sub_label"),
                                     "parent_id")
    pb = _profiles(spark, sf, "Broad").select(F.col("cid").alias("parent_id"), F.col("fallback").alias("broad_label"))
    a = cluster_assign(spark, sf)
    out = a.join(ps, "cluster", "left").join(pb, "parent_id", "left")
    return out.select("id", "sub_label", "broad_label")


def q_cache_probe(spark, sf):
    """A cache written from the Broad labels; probing Broad keys hits, Sub keys miss."""
    pb = _profiles(spark, sf, "Broad")
    cache = pb.select("cache_key", F.concat(F.lit("cached "), F.col("fallback")).alias("label"))
    out = []
    for lvl, p in (("Broad", pb), ("Sub", _profiles(spark, sf))):
        j = p.select("cid", "cache_key", "fallback").join(cache, "cache_key", "left")
        out.append(j.select(F.col("cid").cast("long").alias("cluster"), F.lit(lvl).alias("level"),
                            F.col("label").isNotNull().alias("hit"),
                            F.coalesce("label", "fallback").alias("label")))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- clustering operators on embeddings

def _x_labels(spark, sf):
    m = embedding_matrix(spark, sf)
    x = m.select(P.single_group("id").alias("g"), "id", l2_normalize("vec").alias("vec"))
    lab = m.select(P.single_group("id").alias("g"), "id", F.col("label").cast("int").alias("label"))
    return x, lab


def q_centroids(spark, sf):
    from .operators.cluster import centroids
    x, lab = _x_labels(spark, sf)
    c = centroids(x, lab, ["g"])
    return c.select(F.col("label").cast("long").alias("label"), F.col("size").cast("long").alias("size"),
                    F.posexplode("c").alias("pos", "x")).select("label", "size", F.col("pos").cast("long"),
                                                                r4("x").alias("x"))


def q_refine_centroid(spark, sf):
    from .operators.cluster import refine_by_centroid
    x, lab = _x_labels(spark, sf)
    return refine_by_centroid(x, lab, ["g"], 0.025).select("id", F.col("label").cast("long").alias("label"))


def q_merge_small(spark, sf):
    from .operators.cluster import merge_small
    x, lab = _x_labels(spark, sf)
    return merge_small(x, lab, ["g"], 50).select("id", F.col("label").cast("long").alias("label"))


def q_merge_duplicates(spark, sf):
    from .operators.cluster import merge_duplicates
    x, lab = _x_labels(spark, sf)
    return merge_duplicates(x, lab, ["g"], 0.3).select("id", F.col("label").cast("long").alias("label"))


def q_relabel(spark, sf):
    from .operators.cluster import dense_relabel
    m = embedding_matrix(spark, sf)
    lab = m.select(F.col("label").alias("g"), "id",
                   F.when(F.col("vec")[0] > 0, 7).otherwise(3).cast("int").alias("label"))
    return dense_relabel(lab, ["g"]).select("id", F.col("label").cast("long").alias("label"))


def q_child_numbering(spark, sf):
    from .plans.hierarchy import child_numbering
    m = embedding_matrix(spark, sf)
    local = m.select("id", F.col("label").alias("parent"),
                     F.when(F.col("vec")[0] > 0, 1).otherwise(0).alias("label"))
    return child_numbering(local, "parent", "child").select("id", F.col("child").cast("long").alias("child"))


def q_pad_dims(spark, sf):
    from .plans.hierarchy import pad_dims
    m = embedding_matrix(spark, sf)
    z = m.where(F.col("label") > 0).select("id", F.slice("vec", 1, F.col("label")).alias("z"))
    out = pad_dims(z, m.select("id"), "dims")
    return out.select("id", F.posexplode("dims").alias("pos", "x")).select(
        "id", F.col("pos").cast("long"), r4("x").alias("x"))


def q_dims_to_columns(spark, sf):
    from .plans.hierarchy import dims_to_columns
    m = embedding_matrix(spark, sf).select("id", F.slice("vec", 1, 4).alias("d"))
    out = dims_to_columns(m, "d", "broad_dim")
    return out.select("id", *[r4(f"broad_dim{i}").alias(f"broad_dim{i}") for i in range(1, 5)],
                      r4(F.aggregate(F.array(*[F.col(f"broad_dim{i}") for i in range(1, 5)]), F.lit(0.0),
                                     lambda a, v: a + v)).alias("dims_sum"))


def q_mean_pool(spark, sf):
    """A3: masked mean of the vectors of each label (mask = first coordinate > 0), then V1."""
    from .operators.views import mean_pool
    m = embedding_matrix(spark, sf).withColumn("mask", F.when(F.col("vec")[0] > 0, 1.0).otherwise(0.0))
    return mean_pool(m, ["label"]).select(F.col("label").cast("long").alias("label"), F.posexplode("vec").alias("pos", "x")) \
        .select("label", F.col("pos").cast("long"), r4("x").alias("x"))


def q_concat_views(spark, sf):
    from .config import CONCAT_ORDER
    from .plans.level import concat_views
    v = embedding_views(spark, sf).withColumn("g", P.single_group("id"))
    c = concat_views(v, ["g"], CONCAT_ORDER)
    return c.select("id", F.posexplode("vec").alias("pos", "x")).select("id", F.col("pos").cast("long"),
                                                                        r4("x").alias("x"))


def q_balance_stats(spark, sf):
    m = embedding_matrix(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    return m.agg((F.max("c") / F.sum("c")).alias("big_frac"),
                 (F.stddev_pop("c") / (F.avg("c") + 1e-9)).alias("imb")).select(r4("big_frac").alias("big_frac"),
                                                                                r4("imb").alias("imb"))


def q_silhouette(spark, sf):
    from .operators.cluster import silhouette
    x, lab = _x_labels(spark, sf)
    return silhouette(x, lab, ["g"]).agg(r4(F.avg("s")).alias("silhouette"))


def q_k_score(spark, sf):
    from .operators.cluster import silhouette
    x, lab = _x_labels(spark, sf)
    sil = silhouette(x, lab, ["g"]).groupBy("g").agg(F.avg("s").alias("sil"))
    m = (lab.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("g").agg((F.max("c") / F.sum("c")).alias("big"),
                              (F.stddev_pop("c") / (F.avg("c") + 1e-9)).alias("imb"),
                              F.count(F.lit(1)).alias("k")))
    return sil.join(m, "g").select(r4(P.k_score_col("sil", "k", "imb", "big", 0.35)).alias("score"))


QUERIES = {
    "l2_normalize": q_l2_normalize,
    "knn": q_knn,
    "local_scale": q_local_scale,
    "heat_affinity": q_heat_affinity,
    "mutual_knn": q_mutual_knn,
    "snn_graph": q_snn_graph,
    "affinity_blend": q_affinity_blend,
    "degree": q_degree,
    "laplacian": q_laplacian,
    "multi_scale": q_multi_scale,
    "view_fusion": q_view_fusion,
    "adaptive_kset": q_adaptive_kset,
    "select_known_columns": q_select_known_columns,
    "view_text": q_view_text,
    "strip_scheme": q_strip_scheme,
    "to_list": q_to_list,
    "uniq_list": q_uniq_list,
    "tokens": q_tokens,
    "ngrams": q_ngrams,
    "title_case": q_title_case,
    "sanitize_label": q_sanitize_label,
    "first_n": q_first_n,
    "top_keywords": q_top_keywords,
    "role_ratios": q_role_ratios,
    "cluster_profile": q_cluster_profile,
    "census": q_census,
    "umbrella": q_umbrella,
    "enforce_umbrella": q_enforce_umbrella,
    "canonical_head": q_canonical_head,
    "role_suffix": q_role_suffix,
    "head_suffix": q_head_suffix,
    "fallback_label": q_fallback_label,
    "cache_key": q_cache_key,
    "context_text": q_context_text,
    "sibling_dedupe": q_sibling_dedupe,
    "label_attach": q_label_attach,
    "cache_probe": q_cache_probe,
    "centroids": q_centroids,
    "refine_centroid": q_refine_centroid,
    "merge_small": q_merge_small,
    "merge_duplicates": q_merge_duplicates,
    "relabel": q_relabel,
    "child_numbering": q_child_numbering,
    "pad_dims": q_pad_dims,
    "dims_to_columns": q_dims_to_columns,
    "mean_pool": q_mean_pool,
    "concat_views": q_concat_views,
    "balance_stats": q_balance_stats,
    "silhouette": q_silhouette,
    "k_score": q_k_score,
    "spectral_embed": q_spectral_embed,
    "spectral_distributed": q_spectral_distributed,
    "choose_k": q_choose_k,
    "kmeans_level": q_kmeans_level,
    "sample_cap": q_sample_cap,
    "run_level": q_run_level,
    "hierarchy": q_hierarchy,
    "text_embed": q_text_embed,
    "pca_views": q_pca_views,
}
QUERIES.update({"text_projection": q_text_projection, "level_census": q_level_census, "csv_scan": q_csv_scan, "cache_snapshots": q_cache_snapshots})
QUERIES["taxonomy"] = q_taxonomy
QUERIES["label_levels"] = q_label_levels
QUERIES["knn_lsh"] = q_knn_lsh
