"""Cluster tables and repair operators, all groups at once.

Inputs are long tables keyed by ``(*group, id)``; k choice and KMeans are in ``kmeans.py``. A group's
centroid table has one row per cluster; it meets the rows as one list per group, broadcast within a
counted bound and joined by shuffle beyond it. The only Python is the merge of a group's centroids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import LevelConfig
from ..functions.vector import dot, l2_normalize
from ..session import cut_lineage, ship_package, spread
from .blocks import small_side

SAMPLE_BUCKETS = 4096


def sample_cap(z: DataFrame, group_cols, cap: int = 7000, seed: int = 42) -> DataFrame:
    """Per group a uniform sample without replacement of exactly ``min(n_g, cap)`` rows, those with
    the smallest ``hash(id, seed)``. Counts per hash bucket find the bucket in which a group reaches its cap;
    only that bucket's rows (``n_g / SAMPLE_BUCKETS`` on average) are ranked."""
    g = list(group_cols)
    h = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40))
    rows = z.withColumn("_h", h).withColumn("_b", F.shiftright("_h", 28))
    counts = rows.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*g).orderBy("_b"))
    cut = (counts.withColumn("_upto", upto).where(F.col("_upto") - F.col("_c") < cap)
           .groupBy(*g).agg(F.max(F.struct("_b", (F.col("_upto") - F.col("_c")).alias("_before"))).alias("_cut")))
    cut = cut_lineage(cut.select(*g, F.col("_cut._b").alias("_cb"), F.col("_cut._before").alias("_before")))
    rows = rows.join(small_side(cut, cut.count()), g).where(F.col("_b") <= F.col("_cb"))
    ranked = (rows.where(F.col("_b") == F.col("_cb"))
              .withColumn("_r", F.row_number().over(Window.partitionBy(*g).orderBy("_h", "id")) + F.col("_before"))
              .where(F.col("_r") <= cap).drop("_r"))
    return rows.where(F.col("_b") < F.col("_cb")).unionByName(ranked).select(z.columns)


def silhouette(x: DataFrame, lab: DataFrame, group_cols) -> DataFrame:
    """``(*group, id, s)``, the exact cosine silhouette, linear in n: with unit rows the mean distance to a
    cluster is ``1 - x . mean(cluster)``; the own cluster excludes the row itself."""
    g = list(group_cols)
    j = x.join(lab, g + ["id"]).join(_lists(centroids(x, lab, g, normalize=False).select(*g, "label", "sum", "size"), g), g)
    own = F.filter("cs", lambda s: s["label"] == F.col("label"))[0]
    a = (own["size"] - 1 - (dot("vec", own["sum"]) - dot("vec", "vec"))) / F.greatest(own["size"] - 1, F.lit(1))
    others = F.filter("cs", lambda s: s["label"] != F.col("label"))
    b = F.array_min(F.transform(others, lambda s: F.lit(1.0) - dot("vec", s["sum"]) / s["size"]))
    return j.select(*g, "id", F.when(own["size"] <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b)).alias("s"))


def _lists(table: DataFrame, g) -> DataFrame:
    """A per-cluster table as one list ``cs`` per group, with a broadcast hint if its counted size allows."""
    table = cut_lineage(table)
    value = [c for c in table.columns if c not in g]
    width = [F.size(c) for c in value if isinstance(table.schema[c].dataType, T.ArrayType)]
    size = table.agg(F.coalesce(F.sum(sum(width, F.lit(8)) * 8), F.lit(0))).first()[0]
    return small_side(table.groupBy(*g).agg(F.collect_list(F.struct(*value)).alias("cs")), 1, size)


# ---------------------------------------------------------------- centroids, refinement, merges

def centroids(x: DataFrame, labels: DataFrame, group_cols, normalize: bool = True) -> DataFrame:
    """A1 + A2: per (group, label) the L2-normalised mean vector, the vector sum and the size.
    ``Summarizer`` aggregates partially on the map side."""
    g = list(group_cols)
    j = x.join(labels, g + ["id"])
    agg = (j.groupBy(*g, "label")
             .agg(Summarizer.metrics("mean", "sum", "count").summary(array_to_vector("vec")).alias("s"))
             .select(*g, "label", vector_to_array("s.mean").alias("mean"), vector_to_array("s.sum").alias("sum"),
                     F.col("s.count").alias("size")))
    return agg.withColumn("c", l2_normalize("mean") if normalize else F.col("mean"))


def refine_by_centroid(x: DataFrame, labels: DataFrame, group_cols, margin: float) -> DataFrame:
    """Move a row to its most similar centroid when that beats its own by more than
    ``margin`` (ties -> lowest label); every row moves at once. ``x``: ``(*group, id, vec)``."""
    g = list(group_cols)
    j = x.join(labels, g + ["id"]).join(_lists(centroids(x, labels, g).select(*g, "label", "c"), g), g)
    sims = F.transform("cs", lambda c: F.struct(dot(F.col("vec"), c["c"]).alias("sim"),
                                                (-c["label"]).alias("nl")))
    j = j.withColumn("_s", sims)
    best = F.array_max("_s")
    curr = F.filter("_s", lambda s: s["nl"] == -F.col("label"))[0]["sim"]
    new = F.when(best["sim"] - curr > margin, -best["nl"]).otherwise(F.col("label"))
    return j.select(*g, "id", new.cast("int").alias("label"))


def dense_relabel(labels: DataFrame, group_cols) -> DataFrame:
    """Labels -> 0..m-1 per group in label order (window over the distinct labels only)."""
    g = list(group_cols)
    d = labels.select(*g, "label").distinct()
    d = d.withColumn("_new", F.dense_rank().over(Window.partitionBy(*g).orderBy("label")) - 1)
    return labels.join(d, g + ["label"]).select(*g, "id", F.col("_new").cast("int").alias("label"))


def merge_small(x: DataFrame, labels: DataFrame, group_cols, min_size) -> DataFrame:
    """C4: every cluster smaller than ``min_size`` joins the most similar large cluster
    (centroids from the input labels; ties -> lowest label). ``min_size`` is an int or a
    DataFrame ``(*group, _ms)``. Groups without a small cluster keep their labels; the others
    are densely relabelled. If every cluster of a group is small, nothing merges."""
    g = list(group_cols)
    c = cut_lineage(centroids(x, labels, g))
    if isinstance(min_size, DataFrame):
        c = c.join(min_size.select(*g, "_ms"), g)
    else:
        c = c.withColumn("_ms", F.lit(int(min_size)))
    c = c.withColumn("_small", F.col("size") < F.col("_ms"))
    s = c.where("_small").select(*g, F.col("label").alias("s"), F.col("c").alias("cs"))
    big = c.where(~F.col("_small")).select(*g, F.col("label").alias("t"), F.col("c").alias("ct"))
    pairs = s.join(big, g).withColumn("sim", dot("cs", "ct")).where(F.col("sim") > -1.0)
    tgt = (pairs.groupBy(*g, "s").agg(F.max(F.struct("sim", (-F.col("t")).alias("nt"))).alias("b"))
                .select(*g, F.col("s").alias("label"), (-F.col("b.nt")).alias("_t")))
    has_small = c.where("_small").select(*g).distinct().withColumn("_hs", F.lit(True))
    moved = labels.join(tgt, g + ["label"], "left").select(*g, "id", F.coalesce("_t", "label").alias("label"))
    relab = dense_relabel(moved, g).withColumnRenamed("label", "_rl")
    return (labels.join(has_small, g, "left").join(relab, g + ["id"])
            .select(*g, "id", F.when(F.col("_hs"), F.col("_rl")).otherwise(F.col("label")).cast("int")
                    .alias("label")))


def merge_duplicates(x: DataFrame, labels: DataFrame, group_cols, threshold) -> DataFrame:
    """C5 + W6: while the two most similar clusters of a group are at least ``threshold`` alike (cosine of
    their centroids), the smaller one joins the larger - at equal size the higher label the lower; the first
    pair in label order wins a tie - then labels are dense again. Sums and sizes add up, so only the
    centroid table is worked on (one row a cluster), never the data."""
    ship_package(labels.sparkSession)
    g = list(group_cols)
    thr = threshold if isinstance(threshold, F.Column) else F.lit(float(threshold))
    c = centroids(x, labels, g).select(*g, "label", "sum", "size").withColumn("_thr", thr)
    sch = T.StructType([labels.schema[col] for col in g] + [T.StructField("label", T.IntegerType()), T.StructField("_new", T.IntegerType())])

    def per_group(key, pdf):
        pdf = pdf.sort_values("label", ignore_index=True)
        least = max(float(pdf["_thr"].iloc[0]), np.finfo(float).tiny)  # a merge needs a positive similarity
        sums, sizes = np.vstack(pdf["sum"].to_numpy()), pdf["size"].to_numpy(np.int64).copy()
        gram = sums @ sums.T
        target, alive = np.arange(len(pdf)), np.ones(len(pdf), bool)
        while True:
            norm = np.sqrt(np.maximum(np.diag(gram), 0))
            cos = gram / np.where(norm > 0, norm, 1)[:, None] / np.where(norm > 0, norm, 1)[None, :]
            cos[~np.triu(np.outer(alive, alive), 1)] = -np.inf
            a, b = np.unravel_index(np.argmax(cos), cos.shape)
            if cos[a, b] < least:
                break
            stay, go = (a, b) if sizes[a] >= sizes[b] else (b, a)
            sizes[stay] += sizes[go]
            gram[stay] += gram[go]  # the Gram matrix of the sums after the two are added
            gram[:, stay] += gram[:, go]
            alive[go] = False
            target[target == go] = stay
        new = np.searchsorted(np.flatnonzero(alive), target)
        out = pd.DataFrame({"label": pdf["label"].astype(np.int32), "_new": new.astype(np.int32)})
        for col, value in reversed(list(zip(g, key))):
            out.insert(0, col, value)
        return out

    mapping = spread(c, *g).groupBy(*g).applyInPandas(per_group, sch)
    return labels.join(mapping, g + ["label"]).select(*g, "id", F.col("_new").cast("int").alias("label"))


def merge_small_level(x: DataFrame, labels: DataFrame, group_cols, level: LevelConfig) -> DataFrame:
    """Level thresholds (minimum size from the group's row count), then C4 and C5."""
    g = list(group_cols)
    ms = (labels.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
                .select(*g, F.greatest(F.lit(level.min_size_floor),
                                       F.floor(F.lit(level.min_size_frac) * F.col("_n")).cast("long")).alias("_ms")))
    merged = cut_lineage(merge_small(x, labels, g, ms))
    return merge_duplicates(x, merged, g, level.dup_threshold)
