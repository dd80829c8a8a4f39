"""Feature encoding, model search and prediction (M1-M15) on Spark ML.

Differences from the reference, all deliberate:
- the pipeline is fitted on the training side only (``fit_before_split=True``
  restores the reference's order, which leaks test statistics into scaling);
- folds come from the key hash (``foldCol``), so copies of an oversampled row
  stay in one fold;
- the training set is checkpointed once before the search (reliable storage
  in ``spark.checkpoint.dir``), so hundreds of fits do not re-run its lineage;
- the evaluator computes the exact area (``numBins=0``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from itertools import islice
from statistics import pstdev

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.operators.sampling import fold_column, keyed_split, rebalance
from fundscope.session import ensure_checkpoint_dir

# Fixed values of the reference's encoding stage.
CATEGORICAL = ("staff_pick", "countryUS", "subCategoryIndex", "monthdead", "monthLaunched",
               "goalBin")
NUMERIC = ("blurblen", "namelen", "campaignlen", "preparelen")
REFERENCE_FOLDS = 10

# Reference search grids (as data). Keys are estimator param names.
REFERENCE_GRIDS: dict[str, dict[str, list]] = {
    "logistic": {
        "regParam": [0.01, 0.05, 0.1, 0.5, 0.0, 1.0, 10.0, 100.0, 1000.0],
        "elasticNetParam": [0.0, 0.2, 0.4, 0.6, 0.8, 1.0],
    },
    "tree": {
        "impurity": ["entropy", "gini"],
        "maxDepth": [5, 10, 15, 20],
        "maxBins": [10, 20],
        "minInstancesPerNode": [10, 25, 50, 100],
    },
    "forest": {
        "numTrees": [50, 100, 150],
        "maxDepth": [5, 10, 20],
    },
    "svm": {
        "regParam": [0.001, 0.01, 0.1, 0.0, 1.0, 10.0, 100.0],
    },
}

# Bounds of a fit, beside the searched settings. The margin loss has no curvature: at Spark's
# default tolerance a fit takes up to 100 iterations, each a job, for the sixth digit of the objective.
LIMITS = {"svm": {"tol": 1e-4, "maxIter": 50}}

# How a searched fit runs, not what it finds. Each row's node in each tree is cached between levels; by
# default every level sends all trees grown so far (MB by the level) and walks each row down them. For
# a single tree the default is faster: the cache takes more jobs than it saves.
RUNNING = {"forest": {"cacheNodeIds": True}}

ESTIMATORS = {
    "logistic": LogisticRegression,
    "tree": DecisionTreeClassifier,
    "forest": RandomForestClassifier,
    "svm": LinearSVC,
}


def encoder_stages(categorical: Sequence[str] = CATEGORICAL,
                     numeric: Sequence[str] = NUMERIC, category_col: str = "newsubCategory",
                     handle_invalid: str = "skip", scale: bool = True,
                     output: str = "features", unseen: str = "error") -> Pipeline:
    """M1-M5: index -> one-hot (drop last) -> assemble -> standardize.

    ``handle_invalid`` is an explicit choice for null numbers (the reference's
    default, "error", fails on a null blurb length): "skip" drops such rows,
    "keep" passes NaN on. ``unseen`` is the encoders' policy for categories not
    seen in fitting: "error" (the reference's default, and its vector width) or
    "keep" (one extra slot per categorical input).
    """
    stages = [StringIndexer(inputCol=category_col, outputCol="subCategoryIndex",
                            handleInvalid=unseen)]
    vec = [f"{c}Vec" for c in categorical]
    stages.append(OneHotEncoder(inputCols=list(categorical), outputCols=vec, dropLast=True,
                                handleInvalid=unseen))
    assembled = "featuresAssem" if scale else output
    stages.append(VectorAssembler(inputCols=vec + list(numeric), outputCol=assembled,
                                  handleInvalid=handle_invalid))
    if scale:
        stages.append(StandardScaler(inputCol=assembled, outputCol=output, withMean=True,
                                     withStd=True))
    return Pipeline(stages=stages)


def numeric_scaler(numeric: Sequence[str] = NUMERIC,
                             output: str = "scaledFeaturesVec",
                             handle_invalid: str = "skip") -> Pipeline:
    """M6: assemble and standardize the numeric features only."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(numeric), outputCol="featuresAssem",
                        handleInvalid=handle_invalid),
        StandardScaler(inputCol="featuresAssem", outputCol=output, withMean=True,
                       withStd=True)])


def vector_indexer(input_col: str = "features", output_col: str = "indexFeatures",
                   max_categories: int = 20) -> VectorIndexer:
    """M7: detect categorical slots inside a vector."""
    return VectorIndexer(inputCol=input_col, outputCol=output_col,
                         maxCategories=max_categories)


@dataclass
class Prepared:
    pipeline: PipelineModel
    train: DataFrame      # rebalanced, encoded, checkpointed
    test: DataFrame       # encoded


def prepare(features: DataFrame, key: str = "id", seed: int = 101, rebalanced: bool = True,
            oversample: int = 2000, per_class: int = 4700, folds: int = REFERENCE_FOLDS,
            fit_before_split: bool = False, handle_invalid: str = "skip",
            unseen: str = "error") -> Prepared:
    """Split, rebalance, encode; add ``fold`` for cross-validation; cut lineage once."""
    pipe = encoder_stages(handle_invalid=handle_invalid, unseen=unseen)
    train, test = keyed_split(features, key, seed=seed)
    ensure_checkpoint_dir(features.sparkSession)
    if rebalanced:
        # Sampled rows are bounded (2 * per_class); materialize them once so the
        # encoder fits and the encoding below do not re-run the sampling plan.
        train = rebalance(train, key=key, oversample=oversample, per_class=per_class,
                          seed=seed).checkpoint(eager=True)
    model = pipe.fit(features if fit_before_split else train)
    enc_train = model.transform(train).withColumn("fold", fold_column(key, folds, seed))
    enc_train = enc_train.select(key, "label", "features", "fold",
                                 F.col("label").cast("double").alias("y"))
    enc_train = enc_train.checkpoint(eager=True)
    enc_test = model.transform(test).select(key, F.col("label").cast("double").alias("y"),
                                            "label", "features")
    return Prepared(model, enc_train, enc_test)


def build_grid(estimator, grid: dict[str, list]):
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), values)
    return b.build()


def longest_first(units: Iterable[tuple[int, int]], settings: Sequence[dict]) -> list[tuple[int, int]]:
    """Units (fold, setting) by fold, those that grow most levels of trees first."""
    def levels(setting: dict) -> int:
        return setting.get("numTrees", 1) * setting.get("maxDepth", 1)
    return sorted(units, key=lambda u: (u[0], -levels(settings[u[1]]), u[1]))


def as_done(run: Callable, units: Iterable, parallelism: int,
            stop: Callable[[], bool] = lambda: False) -> Iterator:
    """``run(unit)`` of each unit as it ends; a unit starts as soon as another has ended.

    ``stop`` is asked before units are started; those that run then still end.
    """
    left, running, stopped = iter(units), set(), False
    with ThreadPoolExecutor(parallelism) as pool:
        while True:
            stopped = stopped or stop()
            free = 0 if stopped else parallelism - len(running)
            running |= {pool.submit(run, u) for u in islice(left, free)}
            if not running:
                return
            ended, running = wait(running, return_when=FIRST_COMPLETED)
            for one in ended:
                yield one.result()


def search(prepared: Prepared, kind: str, grid: dict[str, list] | None = None,
           folds: int = REFERENCE_FOLDS, parallelism: int | None = None, seed: int = 101):
    """Cross-validated grid search; returns (best model, results DataFrame).

    Results: one row per setting with its mean area under ROC on scores. The fits are those of
    Spark's cross-validator, which ends all settings of a fold before the next one starts; here
    settings and folds share one pool, so that a fold's longest fit does not hold up the others. As many
    fits run at once as the session has cores, unless ``parallelism`` says otherwise.
    """
    parallelism = parallelism or prepared.train.sparkSession.sparkContext.defaultParallelism
    est = ESTIMATORS[kind](featuresCol="features", labelCol="y", **LIMITS.get(kind, {}), **RUNNING.get(kind, {}))
    if hasattr(est, "setSeed"):
        est = est.setSeed(seed)
    maps = build_grid(est, grid if grid is not None else REFERENCE_GRIDS[kind])
    settings = [{p.name: v for p, v in m.items()} for m in maps]
    evaluator = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC", numBins=0)
    data = prepared.train.withColumn("fold", F.col("fold") % folds)
    held = {r.fold: r["count"] for r in data.groupBy("fold").count().collect()}         # at most ``folds``
    rows = sum(held.values())
    for fold in range(folds):
        if held.get(fold, 0) in (0, rows):
            raise ValueError(f"no rows to {'fit' if held.get(fold) else 'judge'} at fold {fold}")
    # bounded rows: an iteration is a job, so few partitions (as in plans/search.py)
    train = data.coalesce(max(1, -(-rows // 50_000))).persist()

    def unit(of: tuple[int, int]) -> tuple[int, int, float]:
        fold, i = of
        model = est.fit(train.where(F.col("fold") != fold), maps[i])
        return fold, i, evaluator.evaluate(model.transform(train.where(F.col("fold") == fold)))

    areas = [[0.0] * folds for _ in maps]
    try:
        units = longest_first(((f, i) for f in range(folds) for i in range(len(maps))), settings)
        for fold, i, area in as_done(unit, units, parallelism):
            areas[i][fold] = area
        means = [sum(a) / folds for a in areas]
        best = est.fit(train, maps[int(np.argmax(means))])
    finally:
        train.unpersist()
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=folds, parallelism=parallelism, foldCol="fold", seed=seed)
    cv_model = cv._copyValues(CrossValidatorModel(best, means, [], [pstdev(a) for a in areas]))
    spark = prepared.train.sparkSession
    rows = [(kind, i, ", ".join(f"{n}={v}" for n, v in sorted(s.items())), float(mean))
            for i, (s, mean) in enumerate(zip(settings, means, strict=True))]
    results = spark.createDataFrame(rows, "model string, setting int, params string, "
                                          "mean_auc double")
    return cv_model, results


def fit_plain(prepared: Prepared, kind: str = "logistic", **params):
    """M8: one fit with given params (no search)."""
    est = ESTIMATORS[kind](featuresCol="features", labelCol="y", **params)
    return est.fit(prepared.train)


# Where a prediction turns to 1: positive probability, or margin.
THRESHOLDS = {"logistic": 0.5, "tree": 0.5, "forest": 0.5, "svm": 0.0}


def logistic_gradient(model, data: DataFrame) -> tuple[float, float]:
    """Mean gradient of the log loss at the fitted coefficients: (intercept, largest slope)."""
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability")[1]
    rows = model.transform(data).select((p - F.col("y")).alias("e"),
                                        vector_to_array("features").alias("x"))
    slots = rows.select("e", F.posexplode("x").alias("slot", "v"))
    slopes = slots.groupBy("slot").agg(F.abs(F.avg(F.col("e") * F.col("v"))).alias("g"))
    return rows.agg(F.avg("e")).first()[0], slopes.agg(F.max("g")).first()[0]


def predict(model, data: DataFrame, key: str = "id") -> DataFrame:
    """``id, label, prediction, score`` (score = margin or positive probability)."""
    out = model.transform(data)
    from pyspark.ml.functions import vector_to_array
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = vector_to_array("rawPrediction")[1]
    return out.select(key, F.col("label").cast("int").alias("label"),
                      F.col("prediction").cast("int").alias("prediction"),
                      score.alias("score"))
