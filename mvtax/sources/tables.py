"""Readers for the driver's parquet tables and the two fixtures built from them.

* :func:`records` maps the TPC-H-ish tables onto the 14-column company schema
  (one row per document; customer, nation, part and pages are left-joined by key).
* :func:`embedding_views` turns ``embeddings.embedding`` into six weighted "views"
  (contiguous slices, each L2-normalised) in the long ``(id, view, vec)`` layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vector import as_double_array, l2_normalize, vec_slice


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Role words attached to each market segment / part type, so role rules have data to match.
SEGMENT_ROLES = {
    "AUTOMOBILE": "manufacturer",
    "BUILDING": "contractor; installer",
    "FURNITURE": "supplier",
    "HOUSEHOLD": "distributor, retail",
    "MACHINERY": "integrator",
}
TYPE_MODELS = {
    "ECONOMY": "service",
    "LARGE": "manufacturer",
    "MEDIUM": "platform",
    "PROMO": "consultant",
    "SMALL": "supplier",
    "STANDARD": "association",
}


def _case(col: str, mapping: dict):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    g = table(spark, sf_dir, "pages").select("page_id", "url")
    j = (d.join(c, d.doc_id == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
          .join(p, d.doc_id == p.p_partkey, "left")
          .join(g, d.doc_id == g.page_id, "left"))
    return j.select(
        F.col("doc_id").alias("id"),
        F.col("c_name").alias("company_name"),
        F.col("url").alias("website_url"),
        F.col("text").alias("ai_summary"),
        F.col("c_mktsegment").alias("industry"),
        F.concat_ws("; ", "p_name", "p_brand").alias("services"),
        F.col("lang").alias("market_focus"),
        _case("c_mktsegment", SEGMENT_ROLES).alias("roles"),
        F.col("p_type").alias("product_categories"),
        F.col("c_mktsegment").alias("customers_segments"),
        _case("p_type", TYPE_MODELS).alias("business_model"),
        F.col("source").alias("certifications"),
        F.when(F.col("p_name").isNotNull(),
               F.concat(F.lit("['"), F.col("p_name"), F.lit("', '"), F.lower("p_type"), F.lit("']")))
         .alias("keywords"),
        F.col("n_name").alias("location"),
    )


# view -> (start, length) inside the 64-wide test embedding
VIEW_SLICES = {"v1": (0, 24), "v2": (24, 12), "v3": (36, 8), "v5": (44, 8), "v4": (52, 6), "vloc": (58, 6)}


def embedding_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), as_double_array("embedding").alias("vec"), "label")


def embedding_views(spark: SparkSession, sf_dir: str, slices: dict | None = None) -> DataFrame:
    """Long view table ``(id, view, vec)``, one row per (record, view)."""
    slices = slices or VIEW_SLICES
    m = embedding_matrix(spark, sf_dir)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(v).alias("view"), l2_normalize(vec_slice("vec", s, ln)).alias("vec"))
        for v, (s, ln) in slices.items()]))
    return m.select("id", stacked.alias("x")).select("id", "x.view", "x.vec")
