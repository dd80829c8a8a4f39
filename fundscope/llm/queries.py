"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.llm import alignment, ann, bpe, langid
from fundscope.llm import line_dedup as ld
from fundscope.llm import minhash, mixing
from fundscope.llm import quality_classifier as qc
from fundscope.llm import quality_rules as qr
from fundscope.llm import runs
from fundscope.llm import sharding as sh
from fundscope.llm import suffix_dedup as sd
from fundscope.llm import topk
from fundscope.llm.common import documents, stored, work_path

SHARDS = 8


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", "lang", langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    model = langid.train(docs.where(~F.col("held_out")))
    return (langid.predict(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ld.line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    kept = ld.kept_text(F.col("text"), F.col("keep_runs"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class, and whether it stands for the class."""
    out = minhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir)).select(
        "doc_id", "source", "lang", "topic", "n_tokens", "factor", "prob", "sampled")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 100 == 0)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sd.suffix_dedup(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = langid.held_out(F.col("doc_id"), 3, 1)
    weights = qc.train(docs, labels.where(~held))
    scored = qc.score(docs.withColumn("held_out", held), weights)
    return scored.select("doc_id", "held_out", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(bpe.ids_text().cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qr.judged(documents(spark, sf_dir)).select(
        "doc_id", *qr.FEATURES, "base_failed", "kept", "log_ppl", "lower", "upper")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sh.sized(documents(spark, sf_dir))
    totals = stored(sh.cell_totals(records), "slot-totals")
    path = work_path(spark, "slot-map")
    sh.write_map(sh.first_map(spark, SHARDS), path)
    sh.write_map(sh.grown_map(sh.read_map(spark, path, 1), SHARDS), path)
    grown = sh.read_map(spark, path, 2).select("vslot", F.col("shard").alias("grown_shard"))
    out = sh.assign(records, totals, sh.read_map(spark, path, 1))
    return (out.join(F.broadcast(grown), "vslot")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                    "grown_shard", "vslot", "vslot_bytes"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return alignment.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = runs.detect(docs, checksum=F.crc32(F.col("doc_id").cast("string").cast("binary")),
                      digests=True)
    return out.withColumnsRenamed({"runs_text": "runs_sha256", "collapsed": "collapsed_sha256"})


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_mixing": op4_mixing,
    "op5_neighbours": op5_neighbours,
    "op6_repeats": op6_repeats,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_top_products": op13_top_products,
}

ORACLE = {
    "op2_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, text, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
            FROM (SELECT doc_id, coalesce(text, '') AS text,
                         string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines),
        shared AS (
            SELECT k FROM keyed WHERE length(k) >= 1
            GROUP BY k HAVING count(DISTINCT (doc_id, text)) >= 10),
        marked AS (
            SELECT keyed.*, shared.k IS NOT NULL AS dropped
            FROM keyed LEFT JOIN shared ON keyed.k = shared.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
                   AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op13_top_products": """
        WITH whole AS (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT query_id, row_number() OVER (
                       PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
