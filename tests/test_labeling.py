"""Proposer budget in level order, cache hits skip proposing, labels attach per level."""

from dataclasses import replace

import pandas as pd

from mvtax.config import DEFAULT_CONFIG


def test_label_levels_budget_and_cache(spark):
    from taxonomy_helpers import SF001
    from mvtax.catalog import _kc, records_hierarchy
    from mvtax.plans.labeling import label_levels
    rec, hier = _kc(spark, SF001), records_hierarchy(spark, SF001)
    cfg = replace(DEFAULT_CONFIG, label_budget=3)

    def acme(contexts, levels, parents):
        return pd.Series(["Acme Integrators"] * len(contexts))

    lab, cache = label_levels(rec, hier, proposer=acme, cfg=cfg)
    broad = {r.cluster_broad: r.cluster_label_broad for r in lab.select("cluster_broad", "cluster_label_broad")
             .distinct().collect()}
    # the budget goes to the first three Broad clusters by id; a Broad label drops the role word
    assert [broad[c] for c in sorted(broad)[:3]] == ["Acme"] * 3
    assert all(broad[c] != "Acme" for c in sorted(broad)[3:])
    subs = {r.cluster_label_sub for r in lab.select("cluster_label_sub").collect()}
    assert not any(s.startswith("Acme") for s in subs)  # budget spent at the Broad level

    def other(contexts, levels, parents):
        return pd.Series(["Zeta Consultants"] * len(contexts))

    lab2, _ = label_levels(rec, hier, cache=cache, proposer=other, cfg=cfg)
    cols = ["id", "cluster_label_broad", "cluster_label_sub", "cluster_label_niche"]
    a = sorted(tuple(r) for r in lab.select(*cols).collect())
    b = sorted(tuple(r) for r in lab2.select(*cols).collect())
    assert a == b  # every cluster hit the cache; the new proposer was never used
    assert lab.count() == rec.count()


def test_label_levels_reads_records_once(spark):
    from taxonomy_helpers import SF001
    from mvtax.catalog import _kc, records_hierarchy
    from mvtax.plans.labeling import label_levels
    rec, hier = _kc(spark, SF001), records_hierarchy(spark, SF001)
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for pdf in it:
            seen.add(len(pdf))
            yield pdf

    lab, _ = label_levels(rec.mapInPandas(count, rec.schema), hier)
    assert lab.count() == rec.count() == seen.value
