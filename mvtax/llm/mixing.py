"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Targets. Sources weigh ``WEIGHTS`` in turn (code-point order, null last) and share ``share`` times
all words; a target stops at ``CAP`` times its source's words and the excess goes to the others by
weight. That fixed point is a water level: targets are ``least(CAP * size, weight * level)``, and
the level comes from running sums over the sources ordered by the level at which each one stops.

Rates. Among all rates within ``0 < r <= CAP`` that give a source its target, the rates
``r_d = least(CAP, exp(lambda_s * x_d))`` (``x_d``: words over the source's mean) are nearest to 1
in relative entropy. ``lambda_s`` solves the convex dual, one unknown a source; all sources take
their Newton step in one aggregation a round (on the logarithm of the words, kept inside a
shrinking bracket). Input of a round is the table of (source, size) counts, not the documents.

Copies. A document gets ``floor(r)`` copies and one more with probability ``r - floor(r)``. Large
documents (over ``LARGE`` means) decide by their own hash; the small ones are taken in the order of
hash over probability up to the words still missing, so a source misses its target by about half a
small document. The cut is found from sums over hash buckets and one window inside the cut bucket.

Scale: one pass over the texts makes ``(doc_id, source, size)``; all else is narrow. Per-source
tables are broadcast after a count, else joined by shuffle. No window holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mvtax.llm.common import WORD, checkpoint, small_side

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
LARGE = 4.0
BUCKETS = 1024
TOLERANCE = 1e-9
MAX_ROUNDS = 60


def word_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: size is the number of words, null text has none."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, n_docs, target)``, one row a source. Windows here run over sources, not documents."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.count(F.when(F.col("size") > 0, 1)).alias("n_docs"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    src = src.withColumn("stops_at", cap * F.col("source_size") / F.col("weight"))
    whole = W.partitionBy()
    before = W.orderBy("stops_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    left_words = share * F.sum("source_size").over(whole) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    src = src.withColumn("level", left_words / left_weight)
    # the first source that would stop above the level of those not yet stopped fixes the level
    level = F.min(F.when(F.col("stops_at") >= F.col("level"), F.struct("stops_at", "level"))).over(whole)["level"]
    top = cap * F.col("source_size").cast("double")
    return src.select("source", "source_size", "n_docs",
                      F.coalesce(F.least(top, F.col("weight") * level), top).alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    return F.exp(F.least(lam * x, F.lit(math.log(cap))))


def tilts(sizes: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``targets`` with ``lam``: the dual solution; null where the target is at the cap (rate = cap)."""
    counts = checkpoint(sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    mean = F.try_divide("source_size", "n_docs")  # null for a source without words
    state = targets.withColumn("mean", mean).withColumn(
        "lam", F.when((F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12)), F.lit(0.0)))
    state = checkpoint(state.withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
                       .withColumn("gap", F.when(F.col("lam").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))))
    n_sources = state.count()
    for _ in range(MAX_ROUNDS):
        if state.filter(F.col("gap") > TOLERANCE).isEmpty():
            return state
        step = small_side(state.filter(F.col("gap") > TOLERANCE).select(F.col("source").alias("s"), "lam", "mean"), n_sources)
        rows = counts.join(step, counts["source"].eqNullSafe(step["s"]))
        x = F.try_divide("size", "mean")
        r = _rate(F.col("lam"), x, cap)
        words = F.col("n") * F.col("size") * r
        sums = rows.groupBy("s").agg(F.sum(words).alias("f"), F.sum(F.when(F.col("lam") * x < math.log(cap), words * x)).alias("g"))
        sums = small_side(sums, n_sources)
        t = state.join(sums, state["source"].eqNullSafe(sums["s"]), "left").drop("s")
        above = F.col("f") > F.col("target")
        t = (t.withColumn("hi", F.when(above, F.col("lam")).otherwise(F.col("hi")))
              .withColumn("lo", F.when(above, F.col("lo")).otherwise(F.coalesce(F.col("lam"), F.col("lo")))))
        newton = F.col("lam") + F.log(F.try_divide("target", "f")) * F.try_divide("f", "g")
        inside = F.coalesce(newton > F.col("lo"), F.col("lo").isNull()) & F.coalesce(newton < F.col("hi"), F.col("hi").isNull())
        middle = (F.when(F.col("lo").isNull(), F.col("hi") * 2 - 1).when(F.col("hi").isNull(), F.col("lo") * 2 + 1)
                  .otherwise((F.col("lo") + F.col("hi")) / 2))
        gap = F.coalesce(F.abs(F.log(F.try_divide("f", "target"))), F.lit(1.0))
        bracketed = F.coalesce((F.col("hi") - F.col("lo")) < 1e-14, F.lit(False))
        state = checkpoint(
            t.withColumn("gap", F.when(F.col("f").isNull() | bracketed, F.lit(0.0)).otherwise(gap))
             .withColumn("lam", F.when(F.col("f").isNull() | (F.col("gap") <= TOLERANCE), F.col("lam"))
                         .when(F.coalesce(inside & ~F.isnan(newton), F.lit(False)), newton).otherwise(middle))
             .drop("f", "g"))
    raise RuntimeError(f"the dual did not converge in {MAX_ROUNDS} rounds")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    Null and empty texts have size 0, rate 1 and one copy of no words. Null is a source of its own,
    the last. Rows that repeat a doc_id draw the same hash and so get equal copies, but at the cut,
    where each row counts. A source without words has target 0. Empty table: empty result.
    """
    sizes = checkpoint(word_sizes(docs))
    src = tilts(sizes, checkpoint(source_targets(sizes, weights, share, cap)), cap)
    n_sources = src.count()
    src = src.select(F.col("source").alias("s"), "source_size", "target", "mean", F.round("lam", 12).alias("lam"))
    side = small_side(src, n_sources)
    rows = sizes.join(side, sizes["source"].eqNullSafe(side["s"])).drop("s")
    x = F.try_divide("size", "mean")
    rate = (F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(float(cap)))
            .otherwise(F.least(_rate(F.col("lam"), x, cap), F.lit(float(cap)))))
    rows = rows.withColumn("rate", rate).withColumn("base", F.floor("rate")).withColumn("part", F.col("rate") - F.col("base"))
    draw = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    rows = rows.withColumn("v", F.when((F.col("part") > 1e-9) & (F.col("size") > 0), draw / F.col("part")))
    large = F.col("size") > LARGE * F.col("mean")
    rows = rows.withColumn("extra", F.when(F.col("v").isNull(), F.lit(False)).when(large, F.col("v") < 1))
    rows = rows.withColumn("bucket", F.when(F.col("extra").isNull(), F.floor(F.least(F.col("v"), F.lit(8.0)) * BUCKETS)))

    sums = rows.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"),
        F.sum(F.col("size") * F.col("base") + F.when(F.col("extra"), F.col("size")).otherwise(F.lit(0))).alias("sure"),
        F.first("target").alias("target"))
    per = W.partitionBy("source")
    sums = (sums.withColumn("missing", F.col("target") - F.sum("sure").over(per)).filter("bucket is not null")
            .withColumn("upto", F.sum("words").over(per.orderBy("bucket"))))
    cut = (sums.filter(F.col("upto") - F.col("words") < F.col("missing")).groupBy("source")
           .agg(F.max(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "missing")).alias("c"))
           .select(F.col("source").alias("s"), F.col("c.bucket").alias("cut"), F.col("c.before").alias("before"), F.col("c.missing").alias("missing")))
    cut = small_side(checkpoint(cut), n_sources)
    rows = rows.join(cut, rows["source"].eqNullSafe(cut["s"]), "left").drop("s")
    inner = W.partitionBy("source").orderBy("v", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    at_cut = F.coalesce(F.col("extra").isNull() & (F.col("bucket") == F.col("cut")), F.lit(False))
    edge = (rows.filter(at_cut).withColumn("upto", F.sum("size").over(inner) + F.col("before"))
            .withColumn("extra", F.col("upto") - F.col("size") / 2 <= F.col("missing")).drop("upto"))
    rest = rows.filter(~at_cut).withColumn("extra", F.coalesce(F.col("extra"), F.col("bucket") < F.col("cut"), F.lit(False)))
    out = rest.unionByName(edge)
    copies = (F.col("base") + F.col("extra").cast("long")).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
                      (F.col("size") * copies).alias("taken"))


def take_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``docs`` as the mix takes them: a row for each copy, none for rate 0; all columns kept.

    Rows are matched to their decision by doc_id and source; rows that repeat both share one decision
    (the largest)."""
    got = (mix(docs, weights, share, cap).groupBy(F.col("doc_id").alias("_llm_id"), F.col("source").alias("_llm_source"))
           .agg(F.max("copies").alias("_llm_copies")))
    got = checkpoint(got)
    got = small_side(got, got.count())
    same = (F.col("doc_id").cast("long").eqNullSafe(got["_llm_id"])) & (F.col("source").cast("string").eqNullSafe(got["_llm_source"]))
    out = docs.join(got, same).filter("_llm_copies > 0")
    return out.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_llm_copies")))).select(docs.columns)
