"""Corpus pipeline: quality filter, exact dedup, near dedup, source mixing, sequence packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``. A null text is judged,
compared, counted and packed as the empty one; a null id is a document like any other; rows that repeat are one after
the second stage; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mvtax.llm import exact_dedup, mixing, packing, quality, simhash
from mvtax.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier is fitted on the given documents; those it rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    return mixing.take_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their places in sequences; ``row`` tells the copies of a document apart."""
    return packing.best_fit_pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, the tilts and the packing are not expressible in SQL; tests/llm/test_pipeline.py compares ``run()`` with a
#: plain pipeline: scores from the definition, copies and near groups by brute force, pieces by the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables lie in the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
