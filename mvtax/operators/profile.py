"""Cluster profiles (A8-A14, W3, W4, R4): one grouped pass per level, no per-cluster loop.

``records``: ``(id, <company columns>)``; ``assign``: ``(id, cluster)``. "First n" lists
use ``row_number() <= n`` over ``id`` (Spark inserts a window group-limit before the
shuffle, so a large cluster never sorts in one task). Keyword counts are a grouped
aggregate with the first ``(id, position)`` kept for Counter's first-seen tie order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROFILE_CAPS, ROLE_HINTS, ROLE_STEMS, TOP_KEYWORDS
from ..functions.text import py_strip, to_list, tokens

ROLE_KEYS = [k for k, _ in ROLE_HINTS]

# profile field -> source column (fixed by the original cluster summary)
CAPPED_FIELDS = (
    ("industries", "industry", False),
    ("services", "services", False),
    ("summaries", "ai_summary", False),
    ("company_names", "company_name", True),
    ("business_models", "business_model", False),
)


def _col_or_blank(df: DataFrame, c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")


def first_n(records: DataFrame, assign: DataFrame, value_col: str, n: int, keep_blank: bool = False,
            cluster_col: str = "cluster", out: str = "values") -> DataFrame:
    """Per cluster, the first ``n`` values by id (blank values skipped unless ``keep_blank``)."""
    v = records.select("id", _col_or_blank(records, value_col).alias("v")).join(assign, "id")
    if not keep_blank:
        v = v.where(py_strip("v") != "")
    w = Window.partitionBy(cluster_col).orderBy("id")
    top = v.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return (top.groupBy(cluster_col).agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("_s"))
               .select(cluster_col, F.transform("_s", lambda s: s["v"]).alias(out)))


def top_keywords(records: DataFrame, assign: DataFrame, n: int = TOP_KEYWORDS, cluster_col: str = "cluster",
                 with_counts: bool = False) -> DataFrame:
    """A8 + W4: the ``n`` most frequent keywords per cluster; ties by first appearance."""
    kw = (records.select("id", F.posexplode(to_list(_col_or_blank(records, "keywords"))).alias("pos", "kw"))
                 .join(assign, "id"))
    cnt = kw.groupBy(cluster_col, "kw").agg(F.count(F.lit(1)).alias("cnt"),
                                            F.min(F.struct("id", "pos")).alias("first"))
    w = Window.partitionBy(cluster_col).orderBy(F.desc("cnt"), "first")
    top = cnt.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    if with_counts:
        return top.select(cluster_col, "kw", "cnt", "_r")
    return (top.groupBy(cluster_col).agg(F.sort_array(F.collect_list(F.struct("_r", "kw"))).alias("_s"))
               .select(cluster_col, F.transform("_s", lambda s: s["kw"]).alias("top_keywords")))


def role_counts(records: DataFrame, assign: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """R4 counts: every role token of ``roles`` / ``business_model`` (parsed as lists) plus one per
    matched stem in ``services`` / ``ai_summary`` (each stem at most once per cluster).
    Stems are tested per row on the space-padded lower-cased text, with a partial aggregate
    (``bool_or``) - no cluster-sized string is ever built. Returns ``(cluster, counts, total)``
    with ``counts`` in the fixed role order."""
    keys = F.array(*[F.lit(k) for k in ROLE_KEYS])
    toks = F.concat(tokens(F.array_join(to_list(_col_or_blank(records, "roles")), " ")),
                    tokens(F.array_join(to_list(_col_or_blank(records, "business_model")), " ")))
    base = records.select("id", F.filter(toks, lambda t: F.array_contains(keys, t)).alias("rt"),
                          F.concat(F.lit(" "), F.lower(_col_or_blank(records, "services")), F.lit(" ")).alias("sv"),
                          F.concat(F.lit(" "), F.lower(_col_or_blank(records, "ai_summary")), F.lit(" ")).alias("sm"))
    base = base.join(assign, "id")
    def is_role(k):
        return lambda t: t == F.lit(k)

    aggs = [F.sum(F.size(F.filter("rt", is_role(k)))).alias(f"_t{i}") for i, k in enumerate(ROLE_KEYS)]
    aggs += [F.bool_or(F.col("sv").contains(stem) | F.col("sm").contains(stem)).alias(f"_s{j}")
             for j, (stem, _) in enumerate(ROLE_STEMS)]
    a = base.groupBy(cluster_col).agg(*aggs)
    counts = []
    for i, k in enumerate(ROLE_KEYS):
        c = F.coalesce(F.col(f"_t{i}"), F.lit(0)).cast("long")
        for j, (_, role) in enumerate(ROLE_STEMS):
            if role == k:
                c = c + F.when(F.col(f"_s{j}"), 1).otherwise(0)
        counts.append(c)
    out = a.select(cluster_col, F.array(*counts).alias("role_counts"))
    return out.withColumn("role_total", F.greatest(F.lit(1), F.aggregate("role_counts", F.lit(0).cast("long"),
                                                                        lambda s, x: s + x)))


def capped_lists(records: DataFrame, assign: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """All five W3 lists in one pass: rows are exploded to ``(field, value)``, blanks dropped per
    field, and a single ``row_number() over (cluster, field order by id)`` keeps the first
    ``cap(field)`` - one shuffle instead of one per field. The literal bound (the largest cap)
    lets Spark apply its window group-limit before the shuffle."""
    items = F.array(*[F.struct(F.lit(name).alias("f"), _col_or_blank(records, col).alias("v"),
                               F.lit(PROFILE_CAPS[name]).alias("cap"), F.lit(keep).alias("keep"))
                      for name, col, keep in CAPPED_FIELDS])
    long = (records.select("id", F.explode(items).alias("x")).join(assign, "id")
                   .select(cluster_col, "id", "x.f", "x.v", "x.cap", "x.keep")
                   .where(F.col("keep") | (py_strip("v") != "")))
    w = Window.partitionBy(cluster_col, "f").orderBy("id")
    top = (long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max(PROFILE_CAPS.values()))
               .where(F.col("_r") <= F.col("cap")))
    agg = top.groupBy(cluster_col).agg(F.sort_array(F.collect_list(F.struct("f", "id", "v"))).alias("_s"))
    return agg.select(cluster_col, *[F.transform(_field(name), lambda e: e["v"]).alias(name)
                                     for name, _, _ in CAPPED_FIELDS])


def _field(name: str):
    return F.filter("_s", lambda e: e["f"] == F.lit(name))


def cluster_profile(records: DataFrame, assign: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """One row per cluster: size, top keywords, capped lists, role counts and total."""
    assign = assign.select("id", cluster_col)
    prof = assign.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("size"))
    prof = prof.join(top_keywords(records, assign, cluster_col=cluster_col), cluster_col, "left")
    prof = prof.join(capped_lists(records, assign, cluster_col), cluster_col, "left")
    prof = prof.join(role_counts(records, assign, cluster_col), cluster_col, "left")
    empty = F.array().cast("array<string>")
    fill = {c: F.coalesce(F.col(c), empty) for c in ["top_keywords"] + [n for n, _, _ in CAPPED_FIELDS]}
    return prof.select(cluster_col, "size", *[fill[c].alias(c) for c in fill], "role_counts", "role_total")


def census(labelled: DataFrame, id_col: str, name_col: str, k: int = 20) -> DataFrame:
    """A14 + O2: the ``k`` largest (id, name) groups; ties by id. A top-k report by design."""
    c = labelled.groupBy(id_col, name_col).agg(F.count(F.lit(1)).alias("count"))
    return c.orderBy(F.desc("count"), id_col).limit(k)


LEVEL_COLUMNS = (("broad", "cluster_broad", "cluster_label_broad"), ("sub", "cluster_sub", "cluster_label_sub"),
                 ("niche", "cluster_niche", "cluster_label_niche"))


def level_census(clustered: DataFrame, k: int = 20, levels=LEVEL_COLUMNS) -> DataFrame:
    """A13 and A14 of all levels in one pass over the rows (GROUPING SETS): ``(level, clusters, rows, place, cluster, name,
    count)`` - the number of distinct clusters and rows of a level, beside its ``k`` largest clusters (a top-k report; ties by id).
    ``levels``: ``(level, id column, name column)``. Rows without a cluster at a level are left out of that level."""
    ids = [F.col(i).cast("long").alias(i) for _, i, _ in levels]
    names = [F.col(n) for _, _, n in levels]
    sets = [[F.col(i), F.col(n)] for _, i, n in levels]
    rows = clustered.select(*ids, *names)
    bits = 2 * len(levels)
    mine = [((1 << bits) - 1) ^ (1 << bits - 1 - j) ^ (1 << len(levels) - 1 - j) for j in range(len(levels))]  # grouping_id of each set
    sizes = rows.groupingSets(sets, *[F.col(i) for _, i, _ in levels], *names).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("count"))
    pick = lambda cols: F.coalesce(*[F.when(F.col("_set") == m, F.col(c)) for m, c in zip(mine, cols)])
    sizes = sizes.select(F.element_at(F.create_map(*[F.lit(x) for m, (level, _, _) in zip(mine, levels) for x in (m, level)]), F.col("_set").cast("int")).alias("level"),
                         pick([i for _, i, _ in levels]).alias("cluster"), pick([n for _, _, n in levels]).alias("name"), "count").where("cluster is not null")
    per = Window.partitionBy("level")  # one row a cluster
    place = F.row_number().over(per.orderBy(F.desc("count"), "cluster", "name"))
    ranked = sizes.withColumn("place", place.cast("long"))
    total = sizes.groupBy("level").agg(F.countDistinct("cluster").alias("clusters"), F.sum("count").alias("rows"))  # one row a level
    return ranked.where(F.col("place") <= k).join(total, "level").select("level", "clusters", "rows", "place", "cluster", "name", "count")
