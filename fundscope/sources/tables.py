"""Driver tables and the ``campaigns`` stand-in built from them.

The reference's crawl is not available, so a campaign table is derived from the
TPC-H-like tables (orders, customer, nation, documents). The derivation is one
declarative plan of equi-joins, all row-local otherwise. A campaign's blurb is the
whole text of document ``id % (number of documents)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Fixed values of the stand-in (must match the oracle SQL).
NULL_BLURB_EVERY = 50
URL_BASE = "https://c.example/"
HOME_COUNTRY = "NATION_0"
CATEGORY = "machinery"
CUTOFF = "1996-01-01"
# Sub-categories of the stand-in kept by name (the rest becomes "Other").
KEEP_STANDIN = ("URGENT", "HIGH", "MEDIUM")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat campaign table (17 columns; no stand-in for converted_pledged_amount)."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    documents = load(spark, sf_dir, "documents")
    n_docs = documents.select(F.count(F.lit(1))).scalar()
    docs = documents.select(F.col("doc_id").alias("d_doc_id"), F.col("text").alias("d_text"))

    key = F.col("o_orderkey")
    created = F.col("o_orderdate").cast("date")
    joined = (orders
              .join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(docs, F.col("d_doc_id") == F.try_mod(key, n_docs), "left"))
    return joined.select(
        key.alias("id"),
        F.concat(F.col("c_name"), F.lit(" #"), (key % 5).cast("string")).alias("name"),
        F.when(key % NULL_BLURB_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("d_text")).alias("blurb"),
        F.col("o_totalprice").alias("goal"),
        F.when(F.col("o_orderstatus") == "F", "successful")
         .when(F.col("o_orderstatus") == "P", "failed")
         .when(key % 3 == 0, "live")
         .when(key % 3 == 1, "canceled")
         .otherwise("suspended").alias("state"),
        F.col("n_name").alias("country"),
        F.lit("USD").alias("currency"),
        (F.col("o_orderpriority") == "1-URGENT").alias("staff_pick"),
        created.alias("created_at"),
        F.date_add(created, (key % 90).cast("int")).alias("launched_at"),
        F.date_add(created, (key % 90 + 1 + F.col("o_custkey") % 60).cast("int"))
         .alias("deadline"),
        F.lower("c_mktsegment").alias("mainCategory"),
        F.substring("o_orderpriority", 3, 1 << 20).alias("subCategory"),
        F.concat(F.lit(URL_BASE), F.floor(key / 2).cast("bigint").cast("string")).alias("url"),
        F.col("c_custkey").alias("creatorID"),
        (F.col("o_custkey") % 400).alias("backers_count"),
        F.col("o_totalprice").alias("usd_pledged"),
    )


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in re-nested into the raw crawl shape (``data`` struct, epoch dates).

    Lets the flatten step (S2, P2, E8, E9) run on driver data.
    """
    c = campaigns(spark, sf_dir)
    epoch = lambda d: (F.unix_date(d).cast("long") * 86400 + 43200)  # noon UTC
    return c.select(F.struct(
        F.col("id"), F.col("name"), F.col("blurb"), F.col("goal"), F.col("state"),
        F.col("country"), F.col("currency"),
        epoch(F.col("created_at")).alias("created_at"),
        epoch(F.col("launched_at")).alias("launched_at"),
        epoch(F.col("deadline")).alias("deadline"),
        F.col("staff_pick"), F.col("backers_count"),
        F.lit(None).cast("long").alias("converted_pledged_amount"),
        F.col("usd_pledged").cast("string").alias("usd_pledged"),
        F.struct(F.concat(F.col("mainCategory"), F.lit("/"),
                          F.lower(F.regexp_replace("subCategory", " ", "-"))).alias("slug"),
                 F.col("subCategory").alias("name")).alias("category"),
        F.struct(F.col("creatorID").alias("id")).alias("creator"),
        F.struct(F.struct(F.col("url").alias("project")).alias("web")).alias("urls"),
    ).alias("data"))
