"""Persistable transformers: user functions, score combination, random features."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasInputCols, HasLabelCol, HasOutputCol, HasSeed
from pyspark.ml.pipeline import Pipeline, PipelineModel
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.margin import MarginMachine

Columns = Callable[[Column], Column]
FUNCTIONS: dict[str, Columns] = {
    "log": lambda c: F.when(c > 0, F.ln(c)),
    "log1p": lambda c: F.when(c > -1, F.log1p(c)),
    "sqrt": lambda c: F.when(c >= 0, F.sqrt(c)),
    "to_int": lambda c: c.cast("int"),
}


def register_function(name: str, fn: Columns) -> None:
    """Make a ``Column -> Column`` function usable by :class:`FunctionTransformer`."""
    FUNCTIONS[name] = fn


class FunctionTransformer(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Applies a registered function to every input column."""

    function = Param(Params._dummy(), "function", "registered function name", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, function=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        fn = FUNCTIONS[self.getOrDefault("function")]
        return df.withColumns({c: fn(F.col(f"`{c}`")) for c in self.getInputCols()})


class ScoreCombiner(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Row-wise combination of model outputs.

    mean_probability  average of probability vectors, plus the arg-max label in ``prediction``
    majority          most frequent label, ties to the smallest label
    mean              average of predictions
    positive          probability of class 1 as a number
    """

    op = Param(Params._dummy(), "op", "mean_probability, majority, mean or positive", TypeConverters.toString)
    labelOut = Param(Params._dummy(), "labelOut", "label column of mean_probability", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, op=None, labelOut="prediction"):
        super().__init__()
        self._setDefault(labelOut="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        op, ins, out = self.getOrDefault("op"), self.getInputCols(), self.getOutputCol()
        if op == "mean_probability":
            return mean_probability(df, ins, out, self.getOrDefault("labelOut"))
        if op == "majority":
            return df.withColumn(out, majority([F.col(c) for c in ins]))
        if op == "mean":
            return df.withColumn(out, mean_of([F.col(c) for c in ins]))
        return df.withColumn(out, vector_to_array(ins[0])[1])


def mean_of(cols: list[Column]) -> Column:
    return sum(cols[1:], cols[0]) / F.lit(len(cols))


def majority(cols: list[Column]) -> Column:
    votes = F.array(*[c.cast("double") for c in cols])
    tally = F.transform(F.array_distinct(votes), lambda v: F.struct((-F.size(F.filter(votes, lambda x: x == v))).alias("n"), v.alias("v")))
    return F.array_min(tally)["v"]


def mean_probability(df: DataFrame, vectors: list[str], out: str, label: str) -> DataFrame:
    arrays = [vector_to_array(c) for c in vectors]
    total = arrays[0]
    for a in arrays[1:]:
        total = F.zip_with(total, a, lambda x, y: x + y)
    mean = F.transform(total, lambda x: x / F.lit(float(len(vectors))))
    tmp = df.withColumn("_mean", mean)
    return tmp.withColumns(
        {out: array_to_vector("_mean"), label: (F.array_position("_mean", F.array_max("_mean")) - 1).cast("double")}
    ).drop("_mean")


def forests_of(model: PipelineModel) -> list:
    """The forest models inside a fitted pipeline."""
    out = []
    for s in model.stages:
        if isinstance(s, PipelineModel):
            out += forests_of(s)
        elif hasattr(s, "featureImportances"):
            out.append(s)
    return out


def importances(model: PipelineModel) -> np.ndarray:
    """Mean feature importance over the forests of a fitted pipeline."""
    return np.mean([m.featureImportances.toArray() for m in forests_of(model)], axis=0)


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """cos(W x + b) features whose inner products approximate the RBF kernel."""

    components = Param(Params._dummy(), "components", "number of random features", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "input dimension", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, components=200, size=None, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(components=200, gamma=1.0, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        size, comps = self.getOrDefault("size"), self.getOrDefault("components")
        gamma, seed = self.getOrDefault("gamma"), self.getSeed()

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            rng = np.random.default_rng(seed)
            w = rng.normal(scale=math.sqrt(2 * gamma), size=(size, comps))
            b = rng.uniform(0, 2 * math.pi, size=comps)
            if not len(x):
                return pd.Series([], dtype=object)
            z = math.sqrt(2.0 / comps) * np.cos(np.stack(x.to_numpy()) @ w + b)
            return pd.Series(list(z))

        return df.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(self.getInputCol()))))


class RbfSvm(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """RBF support vector machine on random Fourier features.

    Classification: linear SVM plus a logistic calibration of its margin.  Regression:
    the epsilon-insensitive loss on the same features.
    """

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    problem = Param(Params._dummy(), "problem", "classification or regression", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)
    components = Param(Params._dummy(), "components", "number of random features", TypeConverters.toInt)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube without loss", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", C=1.0, problem="classification", suffix="", components=200, epsilon=0.1, seed=42
    ):
        super().__init__()
        self._setDefault(C=1.0, problem="classification", suffix="", components=200, epsilon=0.1, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        x, sfx = self.getFeaturesCol(), self.getOrDefault("suffix")
        s = df.select(Summarizer.metrics("count", "mean", "variance").summary(F.col(x)).alias("s")).select("s.*").first()
        n, mean, var = s[0], s[1].toArray(), s[2].toArray() * (s[0] - 1) / max(s[0], 1)
        spread = float(np.mean(var) + np.mean(mean**2) - np.mean(mean) ** 2)
        gamma = 1.0 / (len(mean) * spread) if spread > 0 else 1.0
        rff = RandomFourierFeatures(
            inputCol=x, outputCol=f"_rff{sfx}", components=self.getOrDefault("components"), size=len(mean), gamma=gamma, seed=self.getSeed()
        )
        reg = 1.0 / (self.getOrDefault("C") * n)
        if self.getOrDefault("problem") == "regression":
            tube = MarginMachine(
                featuresCol=f"_rff{sfx}", labelCol=self.getLabelCol(), loss="epsilon", l2=reg, epsilon=self.getOrDefault("epsilon"), suffix=sfx
            )
            return Pipeline(stages=[rff, tube]).fit(df)
        svc = LinearSVC(
            featuresCol=f"_rff{sfx}", labelCol=self.getLabelCol(), predictionCol=f"prediction{sfx}", rawPredictionCol=f"_margin{sfx}",
            regParam=reg, standardization=False, tol=1e-4,
        )
        margin = VectorSlicer(inputCol=f"_margin{sfx}", outputCol=f"_margin1{sfx}", indices=[1])
        platt = LogisticRegression(
            featuresCol=f"_margin1{sfx}", labelCol=self.getLabelCol(), predictionCol=f"_platt{sfx}", rawPredictionCol=f"_prattraw{sfx}",
            probabilityCol=f"probability{sfx}",
        )
        return Pipeline(stages=[rff, svc, margin, platt]).fit(df)
