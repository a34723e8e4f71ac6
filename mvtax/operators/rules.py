"""Rule and label operators (R1-R7, R10, M11-M14) as Column expressions over the profile table.

The profile has one row per cluster, so these run JVM-side over a small table; the only
data-sized work (n-gram counts over the capped texts) is done inside the row. Rule tables
are parameters (ordered ``(regex, value)`` pairs); the defaults are the fixed tables in
:mod:`mvtax.config`.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (BROAD_DEFAULT, BROAD_RULES, BROAD_STRIP_SUFFIXES, BROAD_UMBRELLAS, CACHE_VERSION,
                      GENERIC_BAN, HEAD_DEFAULT, HEAD_RULES, LAB_SUFFIX_RULES, MAX_LABEL_WORDS, ROLE_HINTS,
                      VALID_SUFFIXES)
from ..functions.text import (WS, drop_banned_grams, first_match, fmt_percent0, fmt_ratio2, ngrams,
                              normalize_alnum, py_strip, py_title, sanitize_label, title_case_keep_acronyms,
                              tokens)
from ..session import bound_batches, cut_lineage

ROLE_KEYS = [k for k, _ in ROLE_HINTS]
ROLE_SUFFIX = [v for _, v in ROLE_HINTS]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ban_array() -> Column:
    return F.array(*[F.lit(b) for b in GENERIC_BAN])


# ---------------------------------------------------------------- texts of a profile

def texts_blob(prof_cols=("services", "summaries", "industries")) -> Column:
    """``" ".join(services + summaries + industries)`` over the capped lists."""
    return F.array_join(F.concat(*[F.col(c) for c in prof_cols]), " ")


def head_blob() -> Column:
    """``(" ".join(texts) + " " + " ".join(top_keywords)).lower()``."""
    return F.lower(F.concat(texts_blob(), F.lit(" "), F.array_join("top_keywords", " ")))


def suffix_blob() -> Column:
    """``" ".join(texts + top_keywords).lower()``."""
    return F.lower(F.array_join(F.concat("services", "summaries", "industries", "top_keywords"), " "))


# ---------------------------------------------------------------- R1, R2

def umbrella_from_texts(blob, rules=BROAD_RULES, default=BROAD_DEFAULT) -> Column:
    """First sector rule found in the lower-cased texts, else the default sector."""
    return first_match(F.lower(_c(blob)), rules, default)


def with_enforce_umbrella(df: DataFrame, label, texts, out: str, rules=BROAD_RULES,
                          umbrellas=BROAD_UMBRELLAS) -> DataFrame:
    """R2: empty / generic labels fall back to R1; then the first listed sector contained in the
    label, or containing it (after folding to ``a-z0-9`` words), else the title-cased label.
    Staged: the label and its folded form are columns, so the 2 x 12 containment tests
    reference them instead of copying the expression."""
    lab, base = f"_{out}_lab", f"_{out}_base"
    ban = _ban_array()
    lc = _c(label)
    df = df.withColumn(lab, F.when((lc == "") | F.array_contains(ban, F.lower(lc)),
                                   umbrella_from_texts(texts, rules)).otherwise(lc))
    df = df.withColumn(base, normalize_alnum(lab))
    res = None
    for umb in umbrellas:
        cand = re.sub(r"[^a-z0-9]+", " ", umb.lower()).strip()
        cond = (F.instr(F.col(base), cand) > 0) | (F.instr(F.lit(cand), F.col(base)) > 0)
        res = F.when(cond, F.lit(umb)) if res is None else res.when(cond, F.lit(umb))
    return df.withColumn(out, res.otherwise(title_case_keep_acronyms(lab))).drop(lab, base)


def strict_sector(label, texts, rules=BROAD_RULES, umbrellas=BROAD_UMBRELLAS) -> Column:
    """R2 as documented (``strict_umbrella``): a label that is not one of the sectors gives way to R1."""
    return F.when(_c(label).isin(*umbrellas), _c(label)).otherwise(umbrella_from_texts(texts, rules))


# ---------------------------------------------------------------- R3, W9

_GRAMS = "n2 long, n3 long, n_kept long, head string"


def row_grams(toks) -> Column:
    """M6, M7 and W9 of one row's tokens: the number of 2-grams, of 3-grams, of both without banned words, and the most common
    of the latter in title case (null if none; ties: 3-grams first, then first position). Counted inside the row, so no gram moves."""
    ban = frozenset(GENERIC_BAN)

    @F.pandas_udf(_GRAMS)
    def count(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            t = text.split(" ") if text else []
            banned = not ban.isdisjoint(t)
            kept, most, gram = 0, 0, None
            for n in (3, 2):
                grams = Counter(zip(*[t[i:] for i in range(n)]))  # in order of first position
                if banned:
                    grams = {g: c for g, c in grams.items() if ban.isdisjoint(g)}
                kept += sum(grams.values())
                best = max(grams.items(), key=itemgetter(1), default=(None, 0))
                if best[1] > most:
                    most, gram = best[1], " ".join(best[0]).title()  # tokens are ASCII: as ``py_title`` has it
            out.append((max(len(t) - 1, 0), max(len(t) - 2, 0), kept, gram))
        return pd.DataFrame(out, columns=["n2", "n3", "n_kept", "head"])

    return count(F.coalesce(F.array_join(_c(toks), " "), F.lit("")))


def repeated_keys(rows: DataFrame, key_cols) -> DataFrame | None:
    """The keys that several rows have, materialised; None if there are none."""
    again = cut_lineage(rows.groupBy(*key_cols).count().where("count > 1").select(*key_cols))
    return None if again.isEmpty() else again


def gram_heads(prof: DataFrame, key_cols, blob: Column) -> DataFrame:
    """W9 over M5-M7: the most common 3-/2-gram of ``tokens(blob)`` (banned words excluded);
    ties: count desc, 3-grams first, then first position. Returns ``(*keys, gram_head)``. A key's row is counted where it
    is; only keys of several rows have their grams gathered."""
    k = list(key_cols)
    bound_batches(prof.sparkSession)
    again = repeated_keys(prof, k)
    if again is None:
        heads = prof.select(*k, row_grams(tokens(blob))["head"].alias("gram_head"))
    else:
        t = prof.select(*k, tokens(blob).alias("_t"))
        same = [t[c].eqNullSafe(again[c]) for c in k]
        heads = t.join(again, same, "left_anti").select(*k, row_grams("_t")["head"].alias("gram_head"))
        heads = heads.unionByName(_gathered_grams(t.join(again, same, "left_semi"), k))
    return heads.where(F.col("gram_head").isNotNull())


def _gathered_grams(t: DataFrame, k: list[str]) -> DataFrame:
    """``(*keys, gram_head)``: the most common gram of all rows of a key; ``t``: ``(*keys, _t)``."""
    t = t.repartition(*k)
    g3 = t.select(*k, F.posexplode(ngrams("_t", 3)).alias("pos", "gram")).withColumn("n", F.lit(3))
    g2 = t.select(*k, F.posexplode(ngrams("_t", 2)).alias("pos", "gram")).withColumn("n", F.lit(2))
    grams = g3.unionByName(g2)
    grams = grams.where(F.size(drop_banned_grams(F.array("gram"))) > 0)
    cnt = grams.groupBy(*k, "gram", "n").agg(F.count(F.lit(1)).alias("cnt"), F.min("pos").alias("first"))
    w = Window.partitionBy(*k).orderBy(F.desc("cnt"), F.desc("n"), "first")
    best = cnt.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    words = F.slice(F.split("gram", " "), 1, 3)
    return best.select(*k, F.array_join(F.transform(words, lambda w_: py_title(w_)), " ").alias("gram_head"))


def canonical_head(blob, gram_head, rules=HEAD_RULES, default=HEAD_DEFAULT) -> Column:
    """First head rule found in the blob, else the n-gram head, else the default."""
    fallback = F.when(F.coalesce(_c(gram_head), F.lit("")) != "", _c(gram_head)).otherwise(F.lit(default))
    return first_match(_c(blob), rules, fallback)


# ---------------------------------------------------------------- R4, R5

def top_role_suffix(role_counts) -> Column:
    """Suffix of the role with the largest share; ties (and all-zero) -> first role."""
    rc = _c(role_counts)
    idx = F.array_max(F.transform(rc, lambda c, i: F.struct(c.alias("c"), (-i).alias("ni"))))["ni"]
    sufs = F.array(*[F.lit(s) for s in ROLE_SUFFIX])
    return F.element_at(sufs, (-idx + 1).cast("int"))


def role_suffix(blob, role_counts, lab_rules=LAB_SUFFIX_RULES) -> Column:
    """A lab suffix when a lab rule matches the blob, else the top role's suffix."""
    return first_match(_c(blob), lab_rules, top_role_suffix(role_counts))


# ---------------------------------------------------------------- R6, R7

def _words(c) -> Column:
    return F.filter(F.split(_c(c), f"{WS}+"), lambda w: w != "")


def _suffix_rx(s: str) -> str:
    return r"(?i)\b" + s + r"\b"


def with_force_head_suffix(df: DataFrame, label, level: str, head, suffix, texts, out: str,
                           compat: bool = True, rules=BROAD_RULES) -> DataFrame:
    """R6, staged into columns. ``head``: the rule/n-gram head of the cluster; ``suffix``: its
    role suffix; ``texts``: the texts blob for sector rules. Broad -> a sector without role
    words, at most 4 words. Sub / Niche -> "Head Suffix": a suffix named in the label wins and
    the words before it are the head; at most ``MAX_LABEL_WORDS`` words (``compat`` keeps the
    original cut that keeps only the last word or two of the suffix)."""
    t = f"_{out}_"
    df = df.withColumn(t + "lab", sanitize_label(label))
    lab = F.col(t + "lab")
    if level == "Broad":
        df = with_enforce_umbrella(df, lab, texts, t + "umb", rules)
        h = title_case_keep_acronyms(t + "umb")
        h = py_strip(F.regexp_replace(h, r"(?i)\b(" + "|".join(BROAD_STRIP_SUFFIXES) + r")\b", ""))
        df = df.withColumn(t + "h", sanitize_label(h))
        return (df.withColumn(out, F.array_join(F.slice(_words(t + "h"), 1, 4), " "))
                  .drop(t + "lab", t + "umb", t + "h"))
    found = None
    for suf in VALID_SUFFIXES:
        cond = lab.rlike(_suffix_rx(suf))
        found = F.when(cond, F.lit(suf)) if found is None else found.when(cond, F.lit(suf))
    df = df.withColumn(t + "found", found)
    fd = F.col(t + "found")
    before = None
    for suf in VALID_SUFFIXES:
        part = F.regexp_extract(lab, r"(?i)^(.*?)\b" + re.escape(suf) + r"\b", 1)
        before = F.when(fd == suf, part) if before is None else before.when(fd == suf, part)
    df = df.withColumn(t + "hp", py_strip(before))
    hp = F.col(t + "hp")
    named = F.when(fd.isNotNull() & (hp != "") & ~F.array_contains(_ban_array(), F.lower(hp)), hp)
    df = df.withColumn(t + "h0", _words(F.coalesce(named, _c(head))))
    hw = F.col(t + "h0")
    h = F.when(F.size(hw) > 0, F.array_join(F.slice(hw, 1, 3), " ")).otherwise(F.lit("Specialist"))
    df = df.withColumn(t + "suf", F.coalesce(fd, _c(suffix)))
    df = df.withColumn(t + "out", sanitize_label(title_case_keep_acronyms(F.concat(h, F.lit(" "), F.col(t + "suf")))))
    o = F.col(t + "out")
    df = df.withColumn(t + "w", F.split(o, " "))
    words = F.col(t + "w")
    cap = MAX_LABEL_WORDS
    if compat:
        tail = F.when(o.contains("Suppliers") & o.contains("Distributors"), F.lit(2)).otherwise(F.lit(1))
    else:  # trim the head, keep the whole suffix
        tail = F.size(F.split(F.col(t + "suf"), " "))
    cut = F.array_join(F.concat(F.slice(words, 1, F.greatest(F.lit(1), F.lit(cap) - tail)),
                                F.slice(words, -tail, tail)), " ")
    res = F.when(F.size(words) > cap, cut).otherwise(o)
    res = F.regexp_replace(res, r"(?i)\b(Specialist|Specialists)\b\s+\b(Specialist|Specialists)\b", "Specialists")
    return df.withColumn(out, res).drop(*[t + x for x in ("lab", "found", "hp", "h0", "suf", "out", "w")])


def with_fallback_label(df: DataFrame, level: str, head, suffix, texts, out: str, compat: bool = True,
                        rules=BROAD_RULES) -> DataFrame:
    """Rule-only label (no proposer): Broad -> sector of the head; else head + suffix, normalised."""
    if level == "Broad":
        df = with_enforce_umbrella(df, head, texts, f"_{out}_u", rules)
        return df.withColumn(out, title_case_keep_acronyms(f"_{out}_u")).drop(f"_{out}_u")
    return with_force_head_suffix(df, F.concat(_c(head), F.lit(" "), _c(suffix)), level, head, suffix, texts,
                                  out, compat, rules)


# ---------------------------------------------------------------- M11, M12

def role_ratio_strings(role_counts, role_total) -> Column:
    """``sorted(f"{k}:{v:.2f}")`` over the ten roles."""
    order = sorted(range(len(ROLE_KEYS)), key=lambda i: f"{ROLE_KEYS[i]}:")
    rc = _c(role_counts)
    return F.array(*[F.concat(F.lit(ROLE_KEYS[i] + ":"), fmt_ratio2(rc[i], _c(role_total))) for i in order])


def cache_key(level: str, cid, parent) -> Column:
    """The label-cache key of a profile row: the original's list prefixes, then a digest of the full lists."""
    return F.concat_ws("|", F.lit(CACHE_VERSION), F.lit(level), _c(cid).cast("string"),
                       F.coalesce(_c(parent), F.lit("")), F.col("size").cast("string"),
                       F.array_join(F.slice("top_keywords", 1, 12), ","),
                       F.array_join(F.slice("company_names", 1, 6), ","),
                       F.array_join(F.slice("industries", 1, 6), ","),
                       F.array_join(F.slice("services", 1, 6), ","),
                       F.array_join(role_ratio_strings("role_counts", "role_total"), ","),
                       F.sha2(F.concat_ws("|", *[F.array_join(c, ",") for c in ("top_keywords", "company_names", "industries", "services")]), 256))


def context_text(level: str, parent) -> Column:
    """The labelling context for a proposer."""
    p = _c(parent)
    first = F.concat(F.lit(f"Level: {level}"),
                     F.when(F.coalesce(p, F.lit("")) != "", F.concat(F.lit(" (child of '"), p, F.lit("')")))
                      .otherwise(F.lit("")))
    rc = F.col("role_counts")
    ranked = F.array_sort(F.array(*[F.struct((-rc[i]).alias("nc"), F.lit(i).alias("i"),
                                             F.concat(F.lit(ROLE_KEYS[i] + ":"),
                                                      fmt_percent0(rc[i], F.col("role_total"))).alias("s"))
                                    for i in range(len(ROLE_KEYS))]))
    parts = [first, F.concat(F.lit("Size: "), F.col("size").cast("string")),
             F.when(F.size("company_names") > 0, F.concat(F.lit("Examples: "), F.array_join("company_names", ", "))),
             F.when(F.size("services") > 0, F.concat(F.lit("Services: "), F.array_join("services", "; "))),
             F.when(F.size("top_keywords") > 0,
                    F.concat(F.lit("Key terms: "), F.array_join(F.slice("top_keywords", 1, 16), ", "))),
             F.concat(F.lit("Role mix: "), F.array_join(F.transform(F.slice(ranked, 1, 6), lambda s: s["s"]), ", "))]
    return F.concat_ws("\n", *parts)


# ---------------------------------------------------------------- R10

def sibling_dedupe(labels: DataFrame, prof: DataFrame, parent_col: str, cid_col: str,
                   label_col: str = "label") -> DataFrame:
    """Siblings (same parent) sharing a label get `` (Gram)``: the longest, then
    alphabetically first 2-/3-gram of their services + summaries + keywords that no other
    sibling with that label has. Only duplicated labels are touched; the gram sets are built
    only for those clusters."""
    w = Window.partitionBy(parent_col, label_col)
    lab = labels.withColumn("_dup", F.count(F.lit(1)).over(w) > 1)
    dups = lab.where("_dup").select(parent_col, cid_col, label_col)
    blob = F.array_join(F.concat("services", "summaries", "top_keywords"), " ")
    t = (prof.select(cid_col, "services", "summaries", "top_keywords").join(dups, cid_col)
           .select(parent_col, label_col, cid_col, tokens(blob).alias("_t")))
    grams = (t.select(parent_col, label_col, cid_col,
                      F.explode(F.array_distinct(F.concat(ngrams("_t", 2), ngrams("_t", 3)))).alias("gram"))
              .where(F.size(drop_banned_grams(F.array("gram"))) > 0))
    own = grams.groupBy(parent_col, label_col, "gram").agg(F.countDistinct(cid_col).alias("_nc"),
                                                           F.min(cid_col).alias("_cid"))
    uniq = own.where(F.col("_nc") == 1).select(parent_col, label_col, F.col("_cid").alias(cid_col), "gram")
    best = (uniq.groupBy(parent_col, label_col, cid_col)
                .agg(F.min(F.struct((-F.size(F.split("gram", " "))).alias("nw"), "gram")).alias("b"))
                .select(cid_col, F.array_join(F.transform(F.split("b.gram", " "), lambda x: py_title(x)), " ")
                        .alias("_spec")))
    out = lab.join(best, cid_col, "left")
    new = F.when(F.col("_dup") & F.col("_spec").isNotNull() & (F.col("_spec") != ""),
                 sanitize_label(F.concat(F.col(label_col), F.lit(" ("), F.col("_spec"), F.lit(")"))))
    return out.select(*[c for c in labels.columns if c != label_col],
                      F.coalesce(new, F.col(label_col)).alias(label_col))
