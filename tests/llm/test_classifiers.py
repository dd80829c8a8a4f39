import zlib

import numpy as np
from pyspark.sql import functions as F

from fundscope.llm import ftrl, langid, queries
from fundscope.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) >= 0.97


def test_language_odd_rows(make_docs, odd_rows, clashing):
    docs = clashing(make_docs(odd_rows))
    langs, w = langid.train(docs)
    assert langs == ["de", "en", "fr"] and np.isfinite(w).all()
    rows = langid.predict(docs, (langs, w)).collect()
    assert len(rows) == len(odd_rows)
    assert {r.lang_pred for r in rows} == {"own lang_pred"}
    empty = [r for r in rows if r.n_chars in (None, 0, 6, 13) and r.lang_pred_ == "und"]
    assert len(empty) == 5 and all(r.score_ == 0 for r in empty)
    assert all(r.lang_pred_ in langs for r in rows if r not in empty)
    none = langid.train(make_docs([]))
    assert none[0] == []
    assert {r.lang_pred for r in langid.predict(make_docs(odd_rows), none).collect()} == {"und"}
    one = langid.train(make_docs([(1, "only one", "xx", "s")]))
    assert [r.lang_pred for r in langid.predict(make_docs([(2, "some text")]), one).collect()] == ["xx"]


def test_labels_come_from_learning_rows_only(spark, make_docs):
    """Other languages on held-out rows change no prediction."""
    rows = [(i, t, lang, "s") for i in range(60)
            for t, lang in [("der die das und nicht", "de") if i % 2 else ("the and of with", "en")]]
    docs = make_docs(rows).withColumn("held", langid.held_out(F.col("doc_id"), 4, 2))
    wrong = docs.withColumn("lang", F.when(F.col("held"), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (langid.train(d.where(~F.col("held"))) for d in (docs, wrong))
    assert a[0] == b[0] and (a[1] == b[1]).all()


def test_quality_held_out(spark):
    got = queries.op7_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = got.where("held_out").join(labels, "doc_id").collect()
    good = [r.score for r in held if r.quality == 1]
    bad = [r.score for r in held if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.95
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_quality_odd_rows(spark, make_docs, odd_rows, clashing):
    labels = spark.createDataFrame([(1, 1), (4, 1), (6, 1), (9, 0), (9, 1), (8, None), (77, 0),
                                    (None, 0)], "doc_id long, quality int")
    docs = clashing(make_docs(odd_rows))
    w = qc.train(docs, labels)
    rows = qc.score(docs, w).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score_ <= 1 for r in rows)
    same = {r.score_ for r in rows if r.doc_id == 4}
    assert len(same) == 1
    assert set(qc.train(make_docs([]), labels.limit(0))) == {0.0}
    assert {r.score for r in qc.score(make_docs(odd_rows), np.zeros(qc.FEATURES + 1)).collect()} == {0.5}


def test_ftrl_finds_a_sparse_signal():
    rng = np.random.default_rng(0)
    examples, targets = [], []
    for _ in range(600):
        at = np.sort(rng.choice(200, 10, replace=False))
        examples.append((at, np.ones(10)))
        targets.append(float((at < 20).sum() > (at >= 180).sum()))
    def fitted(l1):
        return ftrl.Ftrl(200, l1=l1).fit(examples, np.array(targets)[:, None], 5).weights()[:-1, 0]

    w = fitted(1.0)
    assert w[:20].mean() > 0.3 and w[180:].mean() < -0.3
    zeros = [(fitted(l1)[20:180] == 0).mean() for l1 in (0.0, 1.0, 8.0)]
    assert zeros[0] < zeros[1] < zeros[2] and zeros[2] > 0.5   # the L1 part leaves exact zeros


def test_temperature_softens_overconfident_margins():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3))
    p = ftrl.probabilities(true)
    classes = np.array([rng.choice(3, p=q) for q in p])
    assert abs(ftrl.best_temperature(4 * true, classes) - 4) < 0.4
    assert ftrl.best_temperature(np.empty((0, 3)), np.empty(0, int)) == 1.0
