"""Gaussian Bayes: one grouped aggregation fits it, column expressions score it."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_VARIANCE = 1e-300  # of features that are constant everywhere, where smoothing adds nothing


class _Settings(HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)


class GaussianBayes(Estimator, _Settings):
    """Normal densities per class and feature.  ``varSmoothing`` times the largest variance of any feature over
    all rows is added to every variance.  Labels are 0, 1, ...; rows without a label are left out."""

    varSmoothing = Param(Params._dummy(), "varSmoothing", "share of the largest variance added to all", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", varSmoothing=1e-9, suffix=""):
        super().__init__()
        self._setDefault(varSmoothing=1e-9, suffix="")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GaussianBayesModel:
        y, x = self.getLabelCol(), self.getFeaturesCol()
        stats = df.where(F.col(y).isNotNull()).groupBy(F.col(y).cast("int").alias("y")).agg(Summarizer.metrics("count", "mean", "variance").summary(F.col(x)).alias("s"))
        rows = stats.select("y", "s.*").collect()
        if not rows:
            raise ValueError("Gaussian Bayes needs labelled rows")
        n = np.array([r["count"] for r in rows], float)
        mean = np.array([r["mean"].toArray() for r in rows])
        var = np.array([r["variance"].toArray() for r in rows]) * ((n - 1) / n)[:, None]  # of the class, not of a sample
        share = (n / n.sum())[:, None]
        overall = (share * var).sum(0) + (share * (mean - (share * mean).sum(0)) ** 2).sum(0)
        var = np.maximum(var + self.getOrDefault("varSmoothing") * overall.max(initial=0.0), LEAST_VARIANCE)
        learned = {
            "labels": [r["y"] for r in rows], "prior": np.log(n / n.sum()).tolist(), "mean": mean.tolist(), "variance": var.tolist(),
        }
        return GaussianBayesModel(featuresCol=x, suffix=self.getOrDefault("suffix"), learned=json.dumps(learned))


class GaussianBayesModel(Transformer, _Settings):
    """Adds ``rawPrediction`` (log of the joint density per label; minus infinity for a label not seen), ``probability`` and ``prediction``."""

    learned = Param(Params._dummy(), "learned", "labels, log priors, means and variances as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", suffix="", learned=None):
        super().__init__()
        self._setDefault(suffix="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        m, sfx = json.loads(self.getOrDefault("learned")), self.getOrDefault("suffix")
        joint = [F.lit(-math.inf)] * (max(m["labels"]) + 1)
        for label, prior, mean, variance in zip(m["labels"], m["prior"], m["mean"], m["variance"]):
            gaps = F.zip_with(F.col("_x"), F.lit(mean).cast("array<double>"), lambda a, b: (a - b) * (a - b))
            parts = F.zip_with(gaps, F.lit(variance).cast("array<double>"), lambda g, v: g / v)
            base = prior - 0.5 * sum(math.log(2 * math.pi * v) for v in variance)
            joint[label] = F.lit(base) - 0.5 * F.aggregate(parts, F.lit(0.0), lambda s, p: s + p)
        out = df.withColumn("_x", vector_to_array(self.getFeaturesCol())).withColumn("_joint", F.array(*joint))
        # relative to the best label, so that the largest term of the sum is one
        terms = F.transform("_joint", lambda j: F.exp(j - F.array_max("_joint")))
        out = out.withColumn("_terms", terms).withColumn("_sum", F.aggregate("_terms", F.lit(0.0), lambda s, t: s + t))
        return out.withColumns({
            f"rawPrediction{sfx}": array_to_vector("_joint"),
            f"probability{sfx}": array_to_vector(F.transform("_terms", lambda t: t / F.col("_sum"))),
            f"prediction{sfx}": (F.array_position("_joint", F.array_max("_joint")) - 1).cast("double"),
        }).drop("_x", "_joint", "_terms", "_sum")
