"""Voting and stacking built from library models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import models
from tabloom.operators.selectors import with_inner_folds
from tabloom.operators.transformers import ScoreCombiner
from tabloom.session import together

STACK_FOLDS = 5


def _bases(train: DataFrame, specs: Sequence[models.ModelSpec], names: Sequence[str]) -> list[PipelineModel]:
    return together(*[lambda i=i, s=s: models.fit(s, train, names, suffix=f"_m{i}") for i, s in enumerate(specs)])


def _shared(bases: Sequence[PipelineModel]) -> list:
    """One assembler, then the estimators of all base pipelines."""
    return [bases[0].stages[0], *[stage for b in bases for stage in b.stages[1:]]]


def fit_voting(train: DataFrame, specs: Sequence[models.ModelSpec], names: Sequence[str], problem: str) -> PipelineModel:
    """Soft vote when every base has probabilities, else hard; mean for regression."""
    bases = _bases(train, specs, names)
    ids = range(len(specs))
    if problem == "regression":
        vote = ScoreCombiner(inputCols=[f"prediction_m{i}" for i in ids], outputCol="prediction", op="mean")
    elif all(s.probabilistic for s in specs):
        vote = ScoreCombiner(inputCols=[f"probability_m{i}" for i in ids], outputCol="probability", op="mean_probability")
    else:
        vote = ScoreCombiner(inputCols=[f"prediction_m{i}" for i in ids], outputCol="prediction", op="majority")
    return PipelineModel([*_shared(bases), vote])


def _meta_inputs(specs: Sequence[models.ModelSpec], problem: str) -> tuple[list[ScoreCombiner], list[str]]:
    steps, cols = [], []
    for i, s in enumerate(specs):
        if problem == "classification" and s.probabilistic:
            steps.append(ScoreCombiner(inputCols=[f"probability_m{i}"], outputCol=f"_meta{i}", op="positive"))
        else:
            steps.append(ScoreCombiner(inputCols=[f"prediction_m{i}"], outputCol=f"_meta{i}", op="mean"))
        cols.append(f"_meta{i}")
    return steps, cols


def fit_stacking(
    train: DataFrame, specs: Sequence[models.ModelSpec], names: Sequence[str], problem: str, folds: int = STACK_FOLDS
) -> PipelineModel:
    """Out-of-fold base outputs train a logistic (ridge for regression) meta-model; bases refit on all rows."""
    tagged = with_inner_folds(train, folds)
    steps, cols = _meta_inputs(specs, problem)
    fold_bases = together(*[lambda i=i: _bases(tagged.where(F.col("rfe_fold") != i), specs, names) for i in range(folds)])
    oof = None
    for i, bases in enumerate(fold_bases):
        part = PipelineModel([*_shared(bases), *steps]).transform(tagged.where(F.col("rfe_fold") == i)).select("label", *cols)
        oof = part if oof is None else oof.unionAll(part)
    packed = VectorAssembler(inputCols=cols, outputCol="_meta")
    shape = models.training_shape(train)
    if problem == "classification":
        meta = LogisticRegression(featuresCol="_meta", labelCol="label", regParam=1.0 / max(shape.n, 1), standardization=False)
    else:
        reg, mix = models.linear_penalty(1.0, 0.0, shape.n, shape.y_std, ridge_sum=True)
        meta = LinearRegression(featuresCol="_meta", labelCol="label", regParam=reg, elasticNetParam=mix, standardization=False, solver="auto")
    fitted = meta.fit(packed.transform(oof))
    return PipelineModel([*_shared(_bases(train, specs, names)), *steps, packed, fitted])
