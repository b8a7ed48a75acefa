"""Cross-validation over one fold-tagged, persisted frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import metrics
from tabloom.session import together

Fit = Callable[[DataFrame, int], PipelineModel]


def score_column(df: DataFrame) -> DataFrame:
    """``score``: probability of class 1 where there is one, else margin, else the prediction."""
    if "probability" in df.columns:
        return df.withColumn("score", vector_to_array("probability")[1])
    if "rawPrediction" in df.columns:
        return df.withColumn("score", vector_to_array("rawPrediction")[1])
    return df.withColumn("score", F.col("prediction"))


def fold_models(df: DataFrame, fit: Fit, folds: int) -> list[PipelineModel]:
    """One model per fold, fitted concurrently on the other folds."""
    return together(*[lambda i=i: fit(df.where(F.col("fold") != i), i) for i in range(folds)])


def fold_predictions(
    df: DataFrame, models: Sequence[PipelineModel], keys: Sequence[str] = (), with_train: bool = False
) -> DataFrame:
    """Predictions of every fold model as one frame: ``fold, part, keys, label, prediction, score``."""
    out = None
    for i, m in enumerate(models):
        rows = df if with_train else df.where(F.col("fold") == i)
        tagged = rows.withColumn("part", F.when(F.col("fold") == i, "test").otherwise("train"))
        scored = score_column(m.transform(tagged)).select(
            F.lit(i).alias("fold"), "part", *keys, F.col("label").cast("double").alias("label"), "prediction", "score"
        )
        out = scored if out is None else out.unionAll(scored)
    return out


def fold_metrics(predictions: DataFrame, problem: str, auc: bool = True) -> DataFrame:
    """Metrics per (fold, part) from one grouped aggregation (plus one for the area under the curve)."""
    by = ["fold", "part"]
    if problem == "regression":
        return metrics.regression(predictions, "label", "prediction", by)
    out = metrics.classification(predictions, "label", "prediction", by)
    return out.join(metrics.roc_auc_by(predictions, "label", "score", by), by) if auc else out


def average_metrics(per_fold: DataFrame) -> dict[str, float]:
    """``{"test_f1": ..., "train_f1": ...}``: the mean over folds."""
    names = [c for c in per_fold.columns if c not in ("fold", "part")]
    rows = per_fold.groupBy("part").agg(*[F.avg(c).alias(c) for c in names]).collect()
    return {f"{r['part']}_{c}": r[c] for r in rows for c in names}


def cross_validate(
    df: DataFrame, fit: Fit, folds: int, problem: str = "classification", with_train: bool = True, auc: bool = True
) -> dict[str, float]:
    """Mean train and test metrics over the folds of a frame with ``label`` and ``fold``."""
    if problem == "classification":
        metrics.check_binary(df, "label")
    models = fold_models(df, fit, folds)
    predictions = fold_predictions(df, models, with_train=with_train)
    return average_metrics(fold_metrics(predictions, problem, auc))


def out_of_fold(df: DataFrame, fit: Fit, folds: int, keys: Sequence[str]) -> DataFrame:
    """Every row scored by the model that did not see it."""
    return fold_predictions(df, fold_models(df, fit, folds), keys)


def evaluate_threshold(df: DataFrame, fit: Fit, folds: int, threshold: float) -> DataFrame:
    """Macro metrics of out-of-fold probabilities cut at ``threshold``."""
    oof = fold_predictions(df, fold_models(df, fit, folds))
    hard = oof.withColumn("prediction", (F.col("score") >= F.lit(float(threshold))).cast("double"))
    return metrics.macro(hard, "label", "prediction")
