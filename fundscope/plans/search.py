"""Resumable model search (M13-M15): a ledger of fits, the best setting, the stored model.

A unit of work is one setting on one fold; units of all folds share one pool, the next one starting
as soon as one has ended. Each unit's area under ROC is appended to a ledger table as fits end; a search that was stopped goes on with the units that the ledger lacks
(an anti-join). The best setting is the one with the largest mean over all folds (ties: the
first of the grid), taken over the whole grid. It is fitted on all training rows and saved
beside the encoder; predictions read both back, apart from training.

A tree is grown level by level, and its splits do not depend on how deep it may become. So settings that
differ in ``maxDepth`` only share one fit, the deepest; the others are the same tree cut off at their depth,
with two leaves of one parent that predict the same made one, as Spark does. Their areas are computed
from counts of rows by leaf. Forests draw features by node, so theirs are fitted one by one.

The rows of a training set are bounded (rebalanced, see ``models.prepare``). They are dealt over few
partitions of ``ROWS_PER_PARTITION``: an optimizer runs a job for every iteration, and many
small partitions cost more than the arithmetic. They are read from a stored table: a cached partition
would draw all fits to the executor that holds it.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.plans import models
from fundscope.session import stored_table

LEDGER = "model string, setting int, fold int, params string, auc double"
ROWS_PER_PARTITION = 50_000
MODELS = {"logistic": LogisticRegressionModel, "tree": DecisionTreeClassificationModel,
          "forest": RandomForestClassificationModel, "svm": LinearSVCModel}


def settings(grid: dict[str, list]) -> list[dict]:
    """All settings of a grid, in the order of its values."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def params_text(setting: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(setting.items()))


def estimator(kind: str, setting: dict, seed: int = 101):
    fixed = models.LIMITS.get(kind, {}) | models.RUNNING.get(kind, {})
    est = models.ESTIMATORS[kind](featuresCol="features", labelCol="y", **fixed | setting)
    return est.setSeed(seed) if hasattr(est, "setSeed") else est


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows, none if nothing was written yet."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm_path)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def unfinished(spark: SparkSession, kind: str, grid: dict, folds: int, path: str) -> list[tuple[int, int]]:
    """Units (fold, setting) without a ledger row; raises if the ledger is of another grid."""
    whole = settings(grid)
    units = spark.createDataFrame(
        [(kind, i, f, params_text(s)) for i, s in enumerate(whole) for f in range(folds)],
        "model string, setting int, fold int, params string")
    done = read_ledger(spark, path)
    if done.join(units, ["model", "setting", "fold", "params"], "left_anti").take(1):
        raise ValueError(f"{path} holds another search")
    left = units.join(done, ["setting", "fold"], "left_anti")
    return sorted((r.fold, r.setting) for r in left.collect())          # at most settings x folds


def _compact(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(max(1, -(-rows // ROWS_PER_PARTITION)))


def area_under_roc(score: np.ndarray, counts: np.ndarray) -> float:
    """Area of rows with ``score``; ``counts`` are how many of them are negative and positive."""
    steps, at = np.unique(-score, return_inverse=True)
    sums = np.zeros((len(steps), 2))
    np.add.at(sums, at, counts)
    false, true = (np.cumsum(sums, 0) / np.maximum(sums.sum(0), 1)).T
    return float(np.trapezoid([0, *true, 1], [0, *false, 1]))


def _nodes(lines: Iterator[str], leaves: Iterator[int]) -> int | tuple:
    """A tree as nested pairs of its leaves' numbers, from its printed form."""
    if next(lines).lstrip().startswith("Predict"):
        return next(leaves)
    left = _nodes(lines, leaves)
    next(lines)                                            # the other side of the condition
    return left, _nodes(lines, leaves)


def _cut_off(node: int | tuple, counts: np.ndarray, depth: int) -> list[np.ndarray]:
    """Counts of the leaves of a tree of at most ``depth`` levels, from those of the grown tree's."""
    if isinstance(node, int):
        return [counts[node]]
    left, right = (_cut_off(side, counts, max(depth - 1, 0)) for side in node)
    whole = [sum(left + right)]
    if depth == 0 or len(left) == len(right) == 1 and left[0][0].argmax() == right[0][0].argmax():
        return whole                                       # Spark makes such leaves one
    return left + right


def tree_areas(model: DecisionTreeClassificationModel, data: DataFrame, fold: int, depths: list[int]
               ) -> list[float]:
    """Areas under ROC on ``fold`` of the tree, fitted on the other rows, cut off at each of ``depths``.

    A row's score is what Spark's evaluator takes: its leaf's number of positive training rows.
    """
    held = (F.col("fold") == fold).cast("int").alias("held")
    rows = (model.setLeafCol("leaf").transform(data).groupBy(F.col("leaf").cast("int").alias("leaf"), held,
                                                             F.col("y").cast("int").alias("y"))
            .count().where("held IS NOT NULL").collect())  # at most four for each leaf
    lines = model.toDebugString.rstrip().split("\n")[1:]
    numbers = itertools.count()
    tree = _nodes(iter(lines), numbers)
    counts = np.zeros((next(numbers), 2, model.numClasses), np.int64)
    for r in rows:
        counts[r.leaf, r.held, r.y] = r["count"]
    found = (np.array(_cut_off(tree, counts, depth)) for depth in depths)
    return [area_under_roc(leaves[:, 0, 1], leaves[:, 1]) for leaves in found]


def shared_fits(units: list[tuple[int, int]], kind: str, whole: list[dict]) -> list[tuple[int, list[int]]]:
    """Units (fold, setting) by fit: a fold and its settings, the one that is fitted first."""
    fits = defaultdict(list)
    for fold, i in units:
        own = {k: v for k, v in whole[i].items() if k != "maxDepth"} if kind == "tree" else whole[i]
        fits[fold, params_text(own)].append(i)
    return [(fold, sorted(own, key=lambda i: -whole[i].get("maxDepth", 0))) for (fold, _), own in fits.items()]


def run(prepared: models.Prepared, kind: str, grid: dict[str, list], path: str,
        folds: int = models.REFERENCE_FOLDS, parallelism: int | None = None, seed: int = 101,
        stop: Callable[[int], bool] = lambda units: False) -> DataFrame:
    """Fits what the ledger at ``path`` lacks and returns it.

    ``stop`` is asked with the number of units done so far and ends the run early.
    """
    spark = prepared.train.sparkSession
    parallelism = parallelism or spark.sparkContext.defaultParallelism
    whole = settings(grid)
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC", numBins=0)
    todo = models.longest_first(unfinished(spark, kind, grid, folds, path), whole)
    rows = prepared.train.count()
    data = stored_table(_compact(prepared.train.withColumn("fold", F.col("fold") % folds), rows), "search-rows")
    done, found = 0, []

    def fit(of: tuple[int, list[int]]) -> list[tuple]:
        fold, of_fit = of
        model = estimator(kind, whole[of_fit[0]], seed).fit(data.where(F.col("fold") != fold))
        if kind == "tree" and "maxDepth" in grid:
            areas = tree_areas(model, data, fold, [whole[i]["maxDepth"] for i in of_fit])
        else:
            areas = [evaluator.evaluate(model.transform(data.where(F.col("fold") == fold)))]
        return [(kind, i, fold, params_text(whole[i]), float(a)) for i, a in zip(of_fit, areas, strict=True)]

    def write() -> None:
        spark.createDataFrame(found, LEDGER).coalesce(1).write.mode("append").parquet(path)
        found.clear()

    try:
        for units in models.as_done(fit, shared_fits(todo, kind, whole), parallelism, lambda: stop(done)):
            found += units
            done += len(units)
            if len(found) >= parallelism:
                write()
    finally:
        if found:
            write()
    return read_ledger(spark, path)


def results(ledger: DataFrame, folds: int = models.REFERENCE_FOLDS) -> DataFrame:
    """``model, setting, params, mean_auc, is_best``: complete settings, one of them the best."""
    means = (ledger.groupBy("model", "setting", "params")
             .agg(F.avg("auc").alias("mean_auc"), F.count("*").alias("n")).where(F.col("n") == folds))
    best = means.agg(F.max_by("setting", F.struct("mean_auc", -F.col("setting")))).scalar()
    return means.select("model", "setting", "params", "mean_auc", (F.col("setting") == best).alias("is_best"))


def finish(prepared: models.Prepared, kind: str, grid: dict[str, list], ledger: DataFrame, path: str,
           folds: int = models.REFERENCE_FOLDS, seed: int = 101):
    """Fits the best setting on all training rows; saves it and the encoder under ``path``."""
    best = results(ledger, folds).where("is_best").first()
    if best is None:
        raise ValueError("no setting has all its folds")
    train = _compact(prepared.train, prepared.train.count())
    model = estimator(kind, settings(grid)[best.setting], seed).fit(train)
    model.write().overwrite().save(f"{path}/model")
    prepared.pipeline.write().overwrite().save(f"{path}/encoder")
    return model


def load(kind: str, path: str) -> tuple[PipelineModel, object]:
    """The saved encoder and model."""
    return PipelineModel.load(f"{path}/encoder"), MODELS[kind].load(f"{path}/model")


def predict(kind: str, path: str, features: DataFrame, key: str = "id") -> DataFrame:
    """Predictions of the saved search for features that are not encoded yet."""
    encoder, model = load(kind, path)
    return models.predict(model, encoder.transform(features), key)
