"""The whole campaign study in one call (the reference's run order, L-2).

campaign table -> de-duplicate by id -> features -> keyed split -> rebalance
-> encode (fitted on the training side) -> cross-validated search per model
-> predictions on the test side -> evaluation tables. Every step is one of the
library's DataFrame functions; results are DataFrames, optionally written as
parquet under ``out_dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.operators import metrics, shape
from fundscope.operators.sampling import union_all
from fundscope.plans import features as feat
from fundscope.plans import models


def campaign_study(campaigns: DataFrame, kinds: Sequence[str] = ("logistic", "tree", "forest",
                                                                  "svm"),
                   grids: dict[str, dict[str, list]] | None = None,
                   folds: int = models.REFERENCE_FOLDS, out_dir: str | None = None,
                   **feature_args) -> dict[str, DataFrame]:
    """Run the study; returns ``features``, ``search``, ``evaluation``, ``confusion``,
    ``prf`` and ``predictions`` (the last four keyed by model in a ``model`` column)."""
    deduped = shape.dedupe_by_key(campaigns, ["id"], order=["launched_at", "name"])
    features = feat.campaign_features(deduped, **feature_args)
    prepared = models.prepare(features, folds=folds)
    searches, evaluations, confusions, prfs, preds = [], [], [], [], []
    for kind in kinds:
        grid = (grids or {}).get(kind)
        best, table = models.search(prepared, kind, grid, folds=folds)
        pred = models.predict(best.bestModel, prepared.test).withColumn("model", F.lit(kind))
        searches.append(table)
        preds.append(pred)
        parts = [metrics.auc_hard(pred), metrics.auc_score(pred), metrics.accuracy(pred)]
        evaluations.append(union_all([
            p.select(F.lit(kind).alias("model"), F.lit(p.columns[0]).alias("metric"),
                     F.col(p.columns[0]).alias("value")) for p in parts]))
        confusions.append(metrics.confusion(pred).withColumn("model", F.lit(kind)))
        prfs.append(metrics.prf_by_label(pred).withColumn("model", F.lit(kind)))
    out = {"features": features, "search": union_all(searches),
           "evaluation": union_all(evaluations), "confusion": union_all(confusions),
           "prf": union_all(prfs), "predictions": union_all(preds)}
    if out_dir is not None:
        for name, df in out.items():
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return out
