"""One query per operator of this package over its whole table, with production parameters.

Each takes ``(spark, sf_dir)``.  ``oracle_sql`` has the DuckDB statement where SQL can
express the whole result; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bitslice, chunk_dedup, cover_tree, huffman, license_scan, packing, periodic, quality, sharding, simhash, sp_codec, spelling,
               subword_lm)
from .shared import id_crc, ship

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword_lm.score(_table(spark, sf_dir, "documents"), id_crc("doc_id") % 10 != 0, PIECES)


def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sp_codec.digests(docs, PIECES)


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.id_digests(_table(spark, sf_dir, "documents"), WORD_BPE)


def op7_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORD_BPE).drop("ids")


def op8_template_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op9_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality.train(docs, labels, rows=~quality.held_out())
    return quality.score(docs, model).withColumn("held_out", quality.held_out())


def op10_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` in which one document of ten repeats a stretch of its words to its end."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = docs.withColumn("h", id_crc("doc_id")).select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), (F.col("h") % 10 == 0).alias("hit"))
    split = parts.select("doc_id", "text", "g", F.when(F.col("hit"), words).alias("w"))
    placed = split.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.when(F.col("n") > 0, 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))))
    at = F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)
    index = F.transform(at, lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    repeated = F.array_join(F.transform(index, lambda i: F.get("w", i.cast("int"))), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(made_periodic(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("runs")
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
                    F.col("best.period").alias("period"), F.expr("(-1000 * best.less) div best.period").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), spoiled=spelling.SPOILED)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_subword_lattice, op2_sentencepiece_codec, op3_cover_tree, op4_content_chunks, op5_bit_sliced_topk, op6_huffman_ids,
              op7_concat_and_cut, op8_template_licenses, op9_subword_quality, op10_simhash_tiles, op11_minimax_shards, op12_periodic_runs, op13_spelling_variants,
              pipeline)
}


# Equal rank, score and ties for every query row; the integer inner product is exact in BIGINT.
_TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Links by plain cosine, components by a recursive walk.
_LINKS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CASE WHEN label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS v
  FROM embeddings
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), walk AS (
  SELECT vec_id AS node, vec_id AS seen FROM vectors
  UNION
  SELECT w.node, l.b FROM walk w JOIN links l ON l.a = w.seen
), least AS (
  SELECT node, min(seen) AS component_id FROM walk GROUP BY node
), degree AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM vectors v JOIN least l ON l.node = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id
"""

ORACLE_SQL: dict[str, str] = {"op3_cover_tree": _LINKS, "op5_bit_sliced_topk": _TOPK}
