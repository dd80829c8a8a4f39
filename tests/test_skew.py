"""One key holding a third of all rows: results stay whole and exact."""
import pandas as pd
from pyspark.sql import functions as F

from fundscope.operators import metrics, shape, stats


def _skewed(spark, n=6000):
    # a third of the rows share id 0, url "hot" and text "same"
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"),
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("u"), (F.col("id") % 50).cast("string"))).alias("url"),
        F.concat(F.lit("n"), (F.col("id") % 7).cast("string")).alias("name"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(
            F.concat(F.lit("t"), (F.col("id") % 400).cast("string"))).alias("text"),
        F.lit(None).cast("date").alias("launched_at"))


def test_dedupe_hot_key(spark):
    df = _skewed(spark).repartition(8)
    pdf = df.toPandas()
    got = shape.dedupe_by_key(df, ["id"], order=["pos"]).toPandas()
    want = pdf.sort_values("pos").groupby("id", as_index=False).first()
    assert len(got) == pdf["id"].nunique()
    m = got.merge(want, on="id", suffixes=("", "_w"))
    assert (m["pos"] == m["pos_w"]).all()


def test_same_url_conflicts_hot_url(spark):
    df = _skewed(spark).repartition(8)
    pdf = df.toPandas()
    got = shape.same_url_conflicts(df, carry=("pos",)).toPandas()
    names = pdf.groupby("url")["name"].nunique()
    want = pdf[pdf["url"].map(names) > 1]
    assert sorted(got["pos"]) == sorted(want["pos"])
    assert (got["name"] != got["other_name"]).all()


def test_later_duplicates_hot_text(spark):
    df = _skewed(spark).repartition(8)
    pdf = df.toPandas()
    got = shape.later_duplicates(df.select("pos", "text"), "text", "pos").toPandas()
    first = pdf.groupby("text")["pos"].transform("min")
    want = pdf[pdf["pos"] > first]
    assert sorted(got["pos"]) == sorted(want["pos"])


def test_share_and_auc_hot_value(spark):
    df = _skewed(spark).select((F.col("url") == "hot").cast("int").alias("label"),
                               (F.col("pos") % 5).cast("double").alias("score"))
    shares = {r.label: r.share for r in stats.share_by(df, "label").collect()}
    assert abs(shares[1] - 1 / 3) < 1e-12
    pdf = df.toPandas()
    pos = pdf[pdf.label == 1].score.values
    neg = pdf[pdf.label == 0].score.values
    ser = pd.Series(list(pos) + list(neg)).rank()
    u = ser[:len(pos)].sum() - len(pos) * (len(pos) + 1) / 2
    assert abs(metrics.auc_score(df).first()[0] - u / (len(pos) * len(neg))) < 1e-12


def _largest_share(spark, df, hot):
    """Largest share of the hot rows that one task of the last stage holds."""
    rows = df.where(hot).groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in rows) / sum(r["count"] for r in rows)


def test_no_task_holds_a_hot_key_whole(spark):
    from fundscope.operators import keywords
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = _skewed(spark).repartition(8)
        urls = shape.same_url_conflicts(df, carry=("pos",))
        assert _largest_share(spark, urls, "url = 'hot'") < 0.5
        later = shape.later_duplicates(df.select("pos", "text"), "text", "pos")
        assert _largest_share(spark, later, "text = 'same'") < 0.5
        docs = spark.range(400).selectExpr("id as doc_id", "concat('every w', id) as text")
        per_doc = keywords.top_keywords(docs, k=2)
        assert "join_salt" in per_doc._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
