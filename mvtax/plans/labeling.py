"""Clusters -> names, top-down.

Per level, one profile row per cluster (A11); rule columns give the head, suffix and the
rule-only label (R3-R7); the cache is probed with a left join on the cache key (J3); the
optional ``proposer`` sees only cache misses - with a ``label_budget`` at most so many, in level order
(Broad, Sub, Niche; by cluster id), through ``mapInPandas``. Sub and Niche labels are
de-duplicated among siblings (R10); Niche sees the de-duplicated Sub names as parents.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_CONFIG, TaxonomyConfig
from ..functions.text import sanitize_label
from ..operators import rules as R
from ..operators.profile import cluster_profile
from ..session import cut_lineage, ship_package

Proposer = Callable[[pd.Series, pd.Series, pd.Series], pd.Series]


def labelled_profiles(records: DataFrame, assign: DataFrame, level: str, parents: DataFrame | None,
                      cfg: TaxonomyConfig = DEFAULT_CONFIG) -> DataFrame:
    """Profile + rule columns per cluster. ``assign``: ``(id, cid)``; ``parents``:
    ``(cid, parent_id, parent_label)`` or None (Broad)."""
    prof = cut_lineage(cluster_profile(records, assign, "cid"))
    if parents is not None:
        prof = prof.join(parents, "cid", "left")
    else:
        prof = (prof.withColumn("parent_id", F.lit(None).cast("int"))
                    .withColumn("parent_label", F.lit(None).cast("string")))
    prof = (prof.withColumn("texts", R.texts_blob()).withColumn("hblob", R.head_blob())
                .withColumn("sblob", R.suffix_blob()))
    heads = R.gram_heads(prof, ["cid"], F.col("hblob"))
    prof = prof.join(heads, "cid", "left")
    prof = (prof.withColumn("head", R.canonical_head("hblob", "gram_head"))
                .withColumn("suffix", R.role_suffix("sblob", "role_counts"))
                .withColumn("cache_key", R.cache_key(level, "cid", "parent_label")))
    return cut_lineage(R.with_fallback_label(prof, level, "head", "suffix", "texts", "fallback", cfg.compat_word_cap))


def propose(misses: DataFrame, level: str, proposer: Proposer | None, budget: int | None = None) -> DataFrame:
    """``(cid, proposal)`` for the first ``budget`` misses by cid; NULL when no proposer."""
    if proposer is None or (budget is not None and budget <= 0):
        return misses.select("cid", F.lit(None).cast("string").alias("proposal")).limit(0)
    ship_package(misses.sparkSession)
    if budget is not None:
        misses = misses.orderBy("cid").limit(budget)  # the opt-in budget: the first clusters by id
    todo = misses.select("cid", R.context_text(level, "parent_label").alias("context"), "parent_label")

    def run(it):
        for pdf in it:
            out = proposer(pdf["context"], pd.Series([level] * len(pdf)), pdf["parent_label"])
            yield pd.DataFrame({"cid": pdf["cid"], "proposal": out.astype("object").where(out.notna(), None)})

    schema = T.StructType([T.StructField("cid", T.IntegerType()), T.StructField("proposal", T.StringType())])
    got = todo.select(F.col("cid").cast("int"), "context", "parent_label").mapInPandas(run, schema)
    return got.select("cid", sanitize_label(F.regexp_replace(F.trim("proposal"), "^[\"']+|[\"']+$", ""))
                      .alias("proposal"))


def label_level(prof: DataFrame, level: str, cache: DataFrame, proposer: Proposer | None, budget: int | None,
                cfg: TaxonomyConfig = DEFAULT_CONFIG):
    """Cache -> proposal -> rule fallback -> normalise. Returns ``(labels (cid, label),
    new cache rows, proposals used)``."""
    j = prof.join(cache.withColumnRenamed("label", "cached"), "cache_key", "left")
    props = propose(j.where(F.col("cached").isNull()), level, proposer, budget)
    used = 0
    if proposer is not None and (budget is None or budget > 0):
        props = cut_lineage(props)  # the proposer runs once, even on retries downstream
        used = props.where(F.coalesce(F.col("proposal"), F.lit("")) != "").count()  # calls that gave a name
    # one row per cluster throughout (no union): hits keep the cached label, misses are normalised
    m = j.join(props, "cid", "left")
    m = m.withColumn("_cand", F.when(F.coalesce(F.col("proposal"), F.lit("")) != "", F.col("proposal"))
                     .otherwise(F.col("fallback")))
    m = R.with_force_head_suffix(m, "_cand", level, "head", "suffix", "texts", "_forced", cfg.compat_word_cap)
    label = F.when(F.col("_forced") != "", F.col("_forced")).otherwise(F.col("fallback"))
    if level == "Broad" and cfg.strict_umbrella:
        label = R.strict_sector(label, "texts")
    m = cut_lineage(m.select("cid", "cache_key", "cached", F.coalesce(F.col("cached"), label).alias("label")))
    return m.select("cid", "label"), m.where(F.col("cached").isNull()).select("cache_key", "label"), used


def label_levels(records: DataFrame, hier: DataFrame, cache: DataFrame | None = None,
                 proposer: Proposer | None = None, cfg: TaxonomyConfig = DEFAULT_CONFIG):
    """Broad, then Sub (parent = Broad label, de-duplicated within each Broad), then Niche
    (parent = de-duplicated Sub label, de-duplicated within each Sub). Returns
    ``(labels (id, cluster_label_broad, cluster_label_sub, cluster_label_niche), cache)``."""
    spark = records.sparkSession
    if cache is None:
        cache = spark.createDataFrame([], "cache_key string, label string")
    budget = cfg.label_budget
    # read by every field of three levels of profiles: written once, so their joins and broadcasts run once
    records = cut_lineage(records)
    h = cut_lineage(hier.select("id", F.col("cluster_broad").cast("int"), F.col("cluster_sub").cast("int"),
                                F.col("cluster_niche").cast("int")))
    pb = labelled_profiles(records, h.select("id", F.col("cluster_broad").alias("cid")), "Broad", None, cfg)
    lb, new_b, used = label_level(pb, "Broad", cache, proposer, budget, cfg)
    lb = cut_lineage(lb)
    budget = budget if budget is None else budget - used

    sub_par = (h.select(F.col("cluster_sub").alias("cid"), F.col("cluster_broad").alias("parent_id")).distinct()
                .join(lb.select(F.col("cid").alias("parent_id"), F.col("label").alias("parent_label")), "parent_id"))
    ps = labelled_profiles(records, h.select("id", F.col("cluster_sub").alias("cid")), "Sub", sub_par, cfg)
    ls, new_s, used = label_level(ps, "Sub", cache, proposer, budget, cfg)
    budget = budget if budget is None else budget - used
    ls = cut_lineage(R.sibling_dedupe(ls.join(sub_par.select("cid", "parent_id"), "cid"), ps, "parent_id", "cid"))

    niche_par = (h.select(F.col("cluster_niche").alias("cid"), F.col("cluster_sub").alias("parent_id")).distinct()
                  .join(ls.select(F.col("cid").alias("parent_id"), F.col("label").alias("parent_label")), "parent_id"))
    pn = labelled_profiles(records, h.select("id", F.col("cluster_niche").alias("cid")), "Niche", niche_par, cfg)
    ln, new_n, used = label_level(pn, "Niche", cache, proposer, budget, cfg)
    ln = cut_lineage(R.sibling_dedupe(ln.join(niche_par.select("cid", "parent_id"), "cid"), pn, "parent_id", "cid"))

    out = (h.join(lb.select(F.col("cid").alias("cluster_broad"), F.col("label").alias("cluster_label_broad")),
                  "cluster_broad", "left")
            .join(ls.select(F.col("cid").alias("cluster_sub"), F.col("label").alias("cluster_label_sub")),
                  "cluster_sub", "left")
            .join(ln.select(F.col("cid").alias("cluster_niche"), F.col("label").alias("cluster_label_niche")),
                  "cluster_niche", "left"))
    new = cut_lineage(new_b.unionByName(new_s).unionByName(new_n))  # materialised before the anti join
    kept = cache.join(new.select("cache_key"), "cache_key", "left_anti")
    return out, kept.unionByName(new)
