"""Model pipeline properties and the streaming ingest."""
import json
import os

import pytest
from pyspark.sql import functions as F

from fundscope.operators import metrics
from fundscope.plans import models
from fundscope.plans.features import campaign_features
from fundscope.streaming import ingest


def _planted(spark, n=1500):
    """Feature rows whose label depends on goalBin and staff_pick (planted signal)."""
    df = spark.range(n).select(
        F.col("id"),
        (F.col("id") % 2).cast("int").alias("staff_pick"),
        (F.col("id") % 37 + 20).cast("int").alias("blurblen"),
        (F.col("id") % 23 + 5).cast("int").alias("namelen"),
        (F.col("id") % 3 == 0).cast("int").alias("countryUS"),
        (F.col("id") % 29 + 10).cast("int").alias("campaignlen"),
        (F.col("id") % 31).cast("int").alias("preparelen"),
        F.element_at(F.array(*[F.lit(s) for s in ("Apps", "Web", "Other", "Gadgets")]),
                     (F.col("id") % 4 + 1).cast("int")).alias("newsubCategory"),
        (F.col("id") % 12 + 1).cast("int").alias("monthdead"),
        ((F.col("id") + 5) % 12 + 1).cast("int").alias("monthLaunched"),
        (F.col("id") % 4 + 1).cast("int").alias("goalBin"))
    noise = (F.abs(F.hash("id")) % 100) < 15
    signal = (F.col("goalBin") <= 2) & (F.col("staff_pick") == 1)
    return df.withColumn("label", F.when(signal != noise, 1).otherwise(0))


def test_feature_width_and_constant_slots(spark):
    f = _planted(spark)
    pipe = models.encoder_stages(scale=False, output="featuresAssem").fit(f)
    row = pipe.transform(f).select("featuresAssem").first()[0]
    # 1 + 1 + 3 (4 categories) + 12 + 12 + 4 one-hot slots (drop last) + 4 numbers
    assert row.size == 1 + 1 + 3 + 12 + 12 + 4 + 4
    keep = models.encoder_stages(scale=False, output="featuresAssem", unseen="keep").fit(f)
    assert keep.transform(f).select("featuresAssem").first()[0].size == 37 + 7


def test_model_beats_chance_and_is_repeatable(spark):
    f = _planted(spark)
    p = models.prepare(f, oversample=100, per_class=400, folds=3)
    m = models.fit_plain(p, "logistic")
    pred = models.predict(m, p.test)
    auc1 = metrics.auc_hard(pred).first()[0]
    assert auc1 > 0.7
    p2 = models.prepare(f.repartition(3), oversample=100, per_class=400, folds=3)
    pred2 = models.predict(models.fit_plain(p2, "logistic"), p2.test)
    assert metrics.auc_hard(pred2).first()[0] == pytest.approx(auc1)


def test_search_small_grid(spark):
    f = _planted(spark)
    p = models.prepare(f, oversample=100, per_class=400, folds=3)
    best, res = models.search(p, "tree", {"maxDepth": [2, 4]}, folds=3, parallelism=2)
    rows = res.collect()
    assert len(rows) == 2 and all(0.5 < r.mean_auc <= 1.0 for r in rows)
    pred = models.predict(best.bestModel, p.test)
    assert set(pred.columns) == {"id", "label", "prediction", "score"}


@pytest.mark.parametrize("kind, grid", [("logistic", {"regParam": [0.01, 1.0]}),
                                         ("tree", {"maxDepth": [2]}),
                                         ("forest", {"numTrees": [5], "maxDepth": [3]}),
                                         ("svm", {"regParam": [0.01, 0.1]})])
def test_every_kind_searches_and_predicts(spark, kind, grid):
    p = models.prepare(_planted(spark, 600), oversample=50, per_class=150, folds=3)
    best, res = models.search(p, kind, grid, folds=3)
    assert all(0.5 < r.mean_auc <= 1 for r in res.collect())
    for data in (p.train, p.test):
        for r in models.predict(best.bestModel, data).collect():
            assert r.prediction == int(r.score > models.THRESHOLDS[kind])


def test_sql_metrics_agree_with_mllib(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics
    f = _planted(spark)
    p = models.prepare(f, oversample=100, per_class=400, folds=3)
    pred = models.predict(models.fit_plain(p, "logistic"), p.test)
    mm = MulticlassMetrics(pred.select(F.col("prediction").cast("double"),
                                       F.col("label").cast("double")).rdd.map(tuple))
    ours = {r.label: r for r in metrics.prf_by_label(pred).collect()}
    for lab in (0, 1):
        assert ours[lab].precision == pytest.approx(mm.precision(float(lab)))
        assert ours[lab].recall == pytest.approx(mm.recall(float(lab)))
        assert ours[lab].f1 == pytest.approx(mm.fMeasure(float(lab)))
    assert metrics.accuracy(pred).first()[0] == pytest.approx(mm.accuracy)


def test_streaming_ingest_matches_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    recs = []
    for i in range(20):
        recs.append({"data": {
            "id": i, "name": f"n{i}", "blurb": "b" * i, "goal": 1000.0 * i * i,
            "state": ["successful", "failed", "live", "canceled"][i % 4], "country": "US",
            "currency": "USD", "created_at": 1451606400 + 86400 * i,
            "launched_at": 1451606400 + 86400 * (i + 3), "deadline": 1451606400 + 86400 * (i + 40),
            "staff_pick": i % 3 == 0, "category": {"slug": "technology/apps", "name": "Apps"},
            "creator": {"id": 1}, "urls": {"web": {"project": f"u{i}"}}}})
    with open(os.path.join(src, "part1.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    out = os.path.join(scratch, "out")
    q = ingest.land(ingest.feature_stream(spark, src), out, "features_test",
                    checkpoint=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    landed = spark.read.parquet(out)
    from fundscope.sources.files import read_campaigns
    batch = campaign_features(read_campaigns(spark, src))
    assert landed.count() == batch.count() == 15
    assert landed.exceptAll(batch.select(*landed.columns)).count() == 0


def test_campaign_study_end_to_end(spark, sf, scratch):
    from fundscope.plans.study import campaign_study
    from fundscope.sources import tables
    camp = tables.campaigns(spark, sf)
    out = campaign_study(camp, kinds=("logistic", "tree"),
                         grids={"logistic": {"regParam": [0.0, 0.1]}, "tree": {"maxDepth": [3]}},
                         folds=3, out_dir=f"{scratch}/study", cutoff=tables.CUTOFF,
                         category=tables.CATEGORY, home=tables.HOME_COUNTRY,
                         keep=tables.KEEP_STANDIN)
    assert out["search"].count() == 3
    ev = out["evaluation"].collect()
    assert len(ev) == 6 and all(0.0 <= r.value <= 1.0 for r in ev)
    assert spark.read.parquet(f"{scratch}/study/prf").count() == 4
    assert out["features"].count() == 227


def test_stream_resumes_from_checkpoint(spark, scratch):
    """A restarted ingest picks up only files it has not processed."""
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(src)

    def write(name, ids):
        rows = [{"data": {"id": i, "name": f"n{i}", "state": "failed", "goal": 1.0,
                          "created_at": 1451606400, "launched_at": 1451606400,
                          "deadline": 1451606400 + 86400,
                          "category": {"slug": "technology/apps", "name": "Apps"}}}
                for i in ids]
        with open(os.path.join(src, name), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))

    write("a.json", range(0, 5))
    ingest.land(ingest.campaign_stream(spark, src), out, "resume_a", checkpoint=ckpt
                ).awaitTermination(120)
    write("b.json", range(5, 8))
    ingest.land(ingest.campaign_stream(spark, src), out, "resume_b", checkpoint=ckpt
                ).awaitTermination(120)
    ids = sorted(r.id for r in spark.read.parquet(out).select("id").collect())
    assert ids == list(range(8))          # each file once, nothing repeated
