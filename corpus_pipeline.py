"""A training corpus from raw documents: classify, drop near-duplicates, cut repeats, pack.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which ``run`` writes and reads again before the next stage.  All but the last
return the columns of ``documents``.

Nulls, empty texts, repeated rows, extra columns and empty tables pass through every stage;
each stage's operator says in its docstring what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadlake.llm import chunk_dedup, packing, quality, simhash
from roadlake.llm.shared import drop, ship, stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled rows outside its held-out part."""
    ship(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rows=~quality.held_out())
    return quality.keep_accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at most three bits apart."""
    ship(spark)
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in the document that holds them first; ``n_chars`` follows the text."""
    ship(spark)
    return chunk_dedup.cut_repeats(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 2048, with their ids."""
    ship(spark)
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("packing", pack),
]

#: No stage but the last could be written in SQL; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        following = stored(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            drop(docs)
        docs = following
    return docs
