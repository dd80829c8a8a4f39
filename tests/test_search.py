"""The ledger search equals Spark's cross-validator, goes on after a stop, and reloads its model."""
import threading

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from fundscope.plans import models, search

GRID = {"maxDepth": [1, 4], "minInstancesPerNode": [1, 20]}


@pytest.fixture(scope="module")
def prepared(spark):
    rows = spark.range(240).select(
        "id", (F.col("id") * 7 % 10 < 4).cast("int").alias("label"), (F.col("id") * 13 % 17).alias("a"),
        (F.col("id") % 5).alias("b"))
    rows = rows.withColumn("a", F.col("a") + 3 * F.col("label") + F.pmod("id", F.lit(4)))
    rows = rows.select("id", "label", array_to_vector(F.array("a", "b").cast("array<double>")).alias("features"),
                       (F.col("id") % 3).cast("int").alias("fold"), F.col("label").cast("double").alias("y"))

    class NoEncoder:
        """Stands in for a fitted pipeline."""
        def write(self):
            return self

        def overwrite(self):
            return self

        def save(self, path):
            pass
    return models.Prepared(NoEncoder(), rows.persist(), rows)


def test_equals_the_cross_validator(spark, prepared, scratch):
    ledger = search.run(prepared, "tree", GRID, f"{scratch}/ledger", folds=3)
    got = {r.params: r for r in search.results(ledger, 3).collect()}
    cv, want = models.search(prepared, "tree", GRID, folds=3)
    want = {r.params: r.mean_auc for r in want.collect()}
    assert got.keys() == want.keys() and len(got) == 4
    assert all(abs(got[p].mean_auc - want[p]) < 1e-12 for p in want)
    best = [p for p in got if got[p].is_best]
    assert len(best) == 1 and got[best[0]].mean_auc == max(r.mean_auc for r in got.values())


class Waiting(DecisionTreeClassifier):
    """The first fit ends when five fits have begun, or fails."""
    lock, begun = threading.Condition(), 0

    def _fit(self, dataset):
        with Waiting.lock:
            Waiting.begun += 1
            Waiting.lock.notify_all()
            if Waiting.begun == 1 and not Waiting.lock.wait_for(lambda: Waiting.begun > 4, 30):
                raise TimeoutError("other folds wait for this fit")
        return super()._fit(dataset)


@pytest.mark.parametrize("how", ["ledger", "search"])
def test_a_long_fit_does_not_hold_up_other_folds(spark, prepared, scratch, monkeypatch, how):
    """Four settings: a fifth fit is one of another fold."""
    monkeypatch.setitem(models.ESTIMATORS, "tree", Waiting)
    monkeypatch.setattr(Waiting, "begun", 0)
    if how == "ledger":
        assert search.run(prepared, "tree", GRID, f"{scratch}/ledger", folds=3, parallelism=2).count() == 12
    else:
        assert models.search(prepared, "tree", GRID, folds=3, parallelism=2)[1].count() == 4


@pytest.mark.parametrize("kind,grid", [("tree", GRID), ("forest", {"numTrees": [3, 7], "maxDepth": [2, 12]})])
def test_equals_sparks_cross_validator(spark, prepared, kind, grid):
    est = models.ESTIMATORS[kind](featuresCol="features", labelCol="y", seed=101)
    assert not est.getCacheNodeIds()
    maps = models.build_grid(est, grid)
    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction", numBins=0)
    want = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=area, numFolds=3,
                          foldCol="fold").fit(prepared.train.coalesce(1))
    cv, table = models.search(prepared, kind, grid, folds=3)
    assert cv.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-12)
    assert cv.stdMetrics == pytest.approx(want.stdMetrics, abs=1e-12)
    assert cv.bestModel.toDebugString.split("\n")[1:] == want.bestModel.toDebugString.split("\n")[1:]
    assert [r.mean_auc for r in table.orderBy("setting").collect()] == cv.avgMetrics
    assert cv.getNumFolds() == 3 and len(cv.getEstimatorParamMaps()) == 4


def test_a_stopped_search_goes_on(spark, prepared, scratch):
    path = f"{scratch}/ledger"
    assert search.read_ledger(spark, path).count() == 0
    part = search.run(prepared, "tree", GRID, path, folds=3, parallelism=1, stop=lambda done: done >= 4)
    first = {(r.setting, r.fold): r.auc for r in part.collect()}
    assert 4 <= len(first) < 12
    assert search.results(part, 3).where("is_best").count() <= 1
    assert len(search.unfinished(spark, "tree", GRID, 3, path)) == 12 - len(first)
    whole = search.run(prepared, "tree", GRID, path, folds=3)
    rows = [((r.setting, r.fold), r.auc) for r in whole.collect()]
    assert len(rows) == 12 == len(dict(rows)) and first.items() <= dict(rows).items()
    assert search.run(prepared, "tree", GRID, path, folds=3).count() == 12      # nothing left to fit
    with pytest.raises(ValueError, match="another search"):
        search.run(prepared, "tree", {"maxDepth": [9]}, path, folds=3)


def test_the_saved_model_predicts_the_same(spark, prepared, scratch):
    ledger = search.run(prepared, "tree", GRID, f"{scratch}/ledger", folds=3)
    model = search.finish(prepared, "tree", GRID, ledger, scratch, 3)
    again = search.MODELS["tree"].load(f"{scratch}/model")
    best = search.results(ledger, 3).where("is_best").first()
    assert search.params_text({k: again.getOrDefault(k) for k in GRID}) == best.params
    a, b = (sorted(map(tuple, models.predict(m, prepared.test).collect())) for m in (model, again))
    assert a == b and len(a) == 240
    with pytest.raises(ValueError, match="all its folds"):
        search.finish(prepared, "tree", GRID, ledger.where("fold > 0"), scratch, 3)


def test_margin_fits_end_without_a_reset(spark, prepared):
    model = search.estimator("svm", {"regParam": 0.1}).fit(prepared.train)
    history = model.summary().objectiveHistory
    assert len(history) <= models.LIMITS["svm"]["maxIter"] + 3 and history[-1] == history[-1]
    assert history[-1] <= history[0]


def test_depths_share_one_fit_and_equal_fits_of_their_own(spark, scratch, monkeypatch):
    """every depth was fitted anew; now one tree a fold and other setting, each depth's area as fitted alone."""
    rows = spark.range(400).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(7)) < 3).cast("int").alias("label"),
        *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(30)).alias(f"x{i}") for i in range(3)])
    rows = rows.withColumn("x0", F.col("x0") + 5 * F.col("label")).select(
        "id", "label", array_to_vector(F.array("x0", "x1", "x2").cast("array<double>")).alias("features"),
        (F.col("id") % 2).cast("int").alias("fold"), F.col("label").cast("double").alias("y"))
    grid = {"maxDepth": [0, 1, 3, 6, 12], "minInstancesPerNode": [2, 9], "impurity": ["gini", "entropy"]}
    fitted = []

    class Counted(DecisionTreeClassifier):
        def _fit(self, dataset):
            fitted.append(self.getMaxDepth())
            return super()._fit(dataset)

    area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction", numBins=0)
    rows = rows.persist()
    with monkeypatch.context() as patch:
        patch.setitem(models.ESTIMATORS, "tree", Counted)
        prepared = models.Prepared(None, rows, rows)
        got = search.run(prepared, "tree", grid, f"{scratch}/ledger", folds=2).collect()
    assert len(got) == 40 and sorted(fitted) == [12] * 8
    whole = search.settings(grid)
    for r in got:
        model = search.estimator("tree", whole[r.setting]).fit(rows.where(F.col("fold") != r.fold).coalesce(1))
        assert r.auc == pytest.approx(area.evaluate(model.transform(rows.where(F.col("fold") == r.fold))), abs=1e-12)
    assert len({round(r.auc, 6) for r in got}) > 15
    # what a stopped search left is shared in the same way, by fold and other settings; forests share nothing
    left = [(0, 0), (0, 4), (0, 5), (1, 8)]
    assert search.shared_fits(left, "tree", whole) == [(0, [4, 0]), (0, [5]), (1, [8])]
    assert search.shared_fits(left, "forest", whole) == [(0, [0]), (0, [4]), (0, [5]), (1, [8])]
