"""Classification metrics as DataFrames (V1-V6).

Input: a DataFrame with a 0/1 ``label``, a 0/1 ``prediction`` and optionally a
numeric ``score``. Confusion-based metrics come from one grouped count (at most
k*k rows). Score-based metrics first reduce to one row per distinct score, then
take running sums with a two-level prefix (over score ranges, then within
each range), so no window ever runs over all scores in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.session import ensure_checkpoint_dir

def auc_hard(df: DataFrame, label: str = "label", prediction: str = "prediction"
             ) -> DataFrame:
    """V1: area under ROC of hard 0/1 predictions = (TPR + TNR) / 2.

    This is what the reference reports as "area under ROC" (evaluator with
    ``rawPredictionCol = prediction``): balanced accuracy.
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    tpr = F.avg(F.when(y == 1, p))
    tnr = F.avg(F.when(y == 0, 1 - p))
    return df.agg(((tpr + tnr) / 2).alias("auc_hard"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              classes=(0, 1)) -> DataFrame:
    """V3: rows = actual class, columns ``pred_<c>`` = predicted counts (0 if none)."""
    pivot = (df.groupBy(F.col(label).cast("int").alias("label"))
             .pivot(prediction if isinstance(prediction, str) else prediction,
                    list(classes)).count())
    return pivot.select("label", *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long")
                                   .alias(f"pred_{c}") for c in classes])


def _pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return (df.groupBy(F.col(label).cast("int").alias("y"),
                       F.col(prediction).cast("int").alias("p"))
            .agg(F.count(F.lit(1)).alias("n")))


def prf_by_label(df: DataFrame, label: str = "label", prediction: str = "prediction"
                 ) -> DataFrame:
    """V4: precision, recall and F1 for each class (0 when a denominator is 0)."""
    pc = _pair_counts(df, label, prediction)
    per_class = (pc.select(F.col("y").alias("c"), "n", (F.col("y") == F.col("p")).alias("hit"),
                           F.lit(True).alias("actual"))
                 .unionByName(pc.select(F.col("p").alias("c"), "n",
                                        F.lit(False).alias("hit"),
                                        F.lit(False).alias("actual"))))
    sums = per_class.groupBy("c").agg(
        F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("actual"), F.col("n")).otherwise(0)).alias("n_actual"),
        F.sum(F.when(~F.col("actual"), F.col("n")).otherwise(0)).alias("n_predicted"))
    prec = F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted")).otherwise(0.0)
    rec = F.when(F.col("n_actual") > 0, F.col("tp") / F.col("n_actual")).otherwise(0.0)
    out = sums.select(F.col("c").alias("label"), prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return out.withColumn("f1", f1).orderBy("label")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction"
             ) -> DataFrame:
    """V5: share of correct predictions (the reference's no-argument precision/recall/F)."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    return df.agg(F.avg(hit).alias("accuracy"))


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label).cast("int")
    return (df.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(y == 1, 0).otherwise(1)).cast("long").alias("neg")))


def _running(counts: DataFrame, cols: list[str], descending: bool) -> DataFrame:
    """Add ``<c>_before`` (sum of ``c`` over all rows strictly earlier in score order) and
    ``<c>_all`` (sum over all rows).

    Two levels. The distinct scores are range-partitioned in order, as many ranges as the
    session has shuffle partitions, and written to the checkpoint folder, so a score keeps
    its range. Range totals (one row per partition, broadcast) are prefixed first, then
    each range on its own.
    """
    order = F.col("score").desc() if descending else F.col("score").asc()
    ensure_checkpoint_dir(counts.sparkSession)
    keyed = (counts.repartitionByRange(order).withColumn("_b", F.spark_partition_id())
             .checkpoint())
    totals = keyed.groupBy("_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wb = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    wa = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("_b", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0))
                                   .alias(f"_bb_{c}") for c in cols],
                           *[F.sum(f"_t_{c}").over(wa).alias(f"{c}_all") for c in cols])
    wi = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = keyed.join(F.broadcast(totals), "_b")
    return joined.select(
        "score", *[c for c in counts.columns if c != "score"], *[f"{c}_all" for c in cols],
        *[(F.col(f"_bb_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0))).alias(f"{c}_before")
          for c in cols])


def auc_score(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """V2: exact area under ROC on scores (Mann-Whitney U, ties count one half).

    Equals ``BinaryClassificationEvaluator(numBins=0)``; the evaluator's default
    of 1000 bins is an approximation. Null if a class has no rows.
    """
    counts = _score_counts(df, label, score)
    run = _running(counts, ["neg"], descending=False)
    u = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + 0.5 * F.col("neg")))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return run.agg(F.try_divide(u, pairs).alias("auc_score"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """V6: one ROC/PR point per distinct score threshold (predict 1 when score >= t).

    ``threshold, tp, fp, tpr, fpr, precision``.
    """
    counts = _score_counts(df, label, score)
    run = _running(counts, ["pos", "neg"], descending=True)
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    P, N = F.col("pos_all"), F.col("neg_all")
    return run.select(
        F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
        F.when(P > 0, tp / P).alias("tpr"), F.when(N > 0, fp / N).alias("fpr"),
        (tp / (tp + fp)).alias("precision")).orderBy(F.col("threshold").desc())
