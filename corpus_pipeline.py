"""A training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the columns
of ``documents``. Cases (nulls, empty texts, ties, repeated rows, empty tables, extra
columns) are those of the operators; extra columns pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.llm import bpe, line_dedup, minhash, mixing, quality_rules
from fundscope.llm.common import documents, fresh, stored

VOCABULARY = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or leave their language's perplexity band go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``n_chars`` follows the text.

    A document that loses all its lines stays with an empty text.
    """
    runs = fresh(docs, "keep_runs")
    marked = line_dedup.line_dedup(docs)
    text = line_dedup.kept_text(F.col("text"), F.col(runs))
    out = marked.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, its least id."""
    return minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by raked weights of source, language and topic."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and digests of the ids and of their decoded text."""
    ids, decoded = fresh(docs, "ids"), fresh(docs, "decoded")
    out = bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", "lang", "source", F.size(ids).cast("long").alias("n_tokens"),
                      F.sha2(bpe.ids_text(ids).cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
                      F.col(ids).alias("ids"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("mixing", mix), ("encoding", encode)]
# Trained scores, sketches and token ids have no SQL form; tests compare the stages with
# plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the last one's rows."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
