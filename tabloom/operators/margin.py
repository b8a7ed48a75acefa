"""Linear models with a hinge or an epsilon-insensitive loss under l1 and l2 penalties.

Minimises mean loss(w x + b) + l1 |w| + l2 |w|^2 / 2; the intercept b carries no penalty.  The kink of the loss is
rounded off by a parabola of width ``mu``, and ``mu`` shrinks from level to level.  On each level proximal Newton
steps are taken: one pass sums loss, gradient and curvature per partition, the driver solves the feature-sized
problem (coordinate descent gives exact zeros under l1), and where a full step does not descend one more pass tries
ten shorter ones.  The rounded loss is at most ``mu / 2`` below the true one, which bounds the error of the optimum.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.sums import matrix, sum_over
from tabloom.session import keep

SHRINK = 5.0  # of the rounding from level to level
STEPS_PER_LEVEL = 12
SHORTER = 0.5 ** np.arange(1, 11)
DAMPING = 1e-6
TOLERANCE = 1e-4  # descent that ends a level, in units of the rounding


def hinge(m: np.ndarray, y: np.ndarray, mu: float, _epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rounded loss, its slope and curvature in the margin ``m``; labels are 0 and 1."""
    sign = 2.0 * y - 1.0
    loss, slope, curve = _rounded(1.0 - sign * m, mu)
    return loss, -sign * slope, curve


def insensitive(m: np.ndarray, y: np.ndarray, mu: float, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    loss, slope, curve = _rounded(np.abs(m - y) - epsilon, mu)
    return loss, np.sign(m - y) * slope, curve


def _rounded(a: np.ndarray, mu: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(a, 0) with a parabola between 0 and ``mu``."""
    inside = (a > 0) & (a < mu)
    loss = np.where(inside, a * a / (2 * mu), np.maximum(a - mu / 2, 0.0))
    return loss, np.clip(a / mu, 0.0, 1.0), inside / mu


LOSSES: dict[str, Callable] = {"hinge": hinge, "epsilon": insensitive}


def _sum_over(rows: DataFrame, one: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``one(x, y)`` over batches, a column of ones behind the features."""
    return sum_over(rows, lambda p: one(np.column_stack([matrix(p["x"]), np.ones(len(p))]), p["y"].to_numpy()), size)


def proximal_step(w: np.ndarray, grad: np.ndarray, curve: np.ndarray, l1: float) -> np.ndarray:
    """The minimiser of the quadratic model around ``w`` plus l1 on all but the last coordinate."""
    if not l1:
        return w - np.linalg.solve(curve, grad)
    new, slope = w.copy(), grad.copy()  # slope of the quadratic at ``new``
    for _ in range(1000):
        moved = 0.0
        for j in range(len(w)):
            at = new[j] - slope[j] / curve[j, j]
            cut = l1 / curve[j, j] if j < len(w) - 1 else 0.0
            goal = np.sign(at) * max(abs(at) - cut, 0.0)
            if goal != new[j]:
                delta = goal - new[j]
                slope += curve[:, j] * delta
                new[j] = goal
                moved = max(moved, abs(delta) * np.sqrt(curve[j, j]))
        if moved < 1e-10:
            break
    return new


def minimise(
    rows: DataFrame, loss: str, size: int, l1: float, l2: float, epsilon: float, scale: float, start: float, smoothing: float
) -> tuple[np.ndarray, float, int]:
    """(weights with the intercept last, rounded objective, passes) over rows of ``x array<double>, y double``."""
    of, d = LOSSES[loss], size + 1
    n, squares = np.split(_sum_over(rows, lambda x, y: np.concatenate([[len(y)], (x * x).sum(0)]), d + 1), [1])
    n, passes = float(n[0]), 1

    def penalty(w: np.ndarray) -> float:
        return float(l1 * np.abs(w[:-1]).sum() + 0.5 * l2 * (w[:-1] ** 2).sum())

    def measure(w: np.ndarray, mu: float) -> tuple[float, np.ndarray, np.ndarray]:
        def one(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            v, slope, curve = of(x @ w, y, mu, epsilon)
            near = curve > 0
            return np.concatenate([[v.sum()], x.T @ slope, ((x[near] * curve[near, None]).T @ x[near]).ravel()])

        got = _sum_over(rows, one, 1 + d + d * d) / n
        ridge = np.append(np.full(size, l2), 0.0)
        damp = DAMPING * (squares / n + squares.max() / n * 1e-6 + 1e-12) / mu
        return float(got[0]) + penalty(w), got[1 : d + 1] + ridge * w, got[d + 1 :].reshape(d, d) + np.diag(ridge + damp)

    def shorter(w: np.ndarray, step: np.ndarray, mu: float) -> tuple[float, np.ndarray]:
        trials = w[None, :] + SHORTER[:, None] * step[None, :]
        got = _sum_over(rows, lambda x, y: np.array([of(x @ t, y, mu, epsilon)[0].sum() for t in trials]), len(trials)) / n
        total = got + np.array([penalty(t) for t in trials])
        return float(total.min()), trials[int(total.argmin())]

    w, mu, least = np.append(np.zeros(size), start), 2.0 * scale, smoothing * scale
    value = np.inf
    while True:
        value, grad, curve = measure(w, mu)
        passes += 1
        for _ in range(STEPS_PER_LEVEL):
            before, goal = value, proximal_step(w, grad, curve, l1)
            trial = measure(goal, mu)
            passes += 1
            if trial[0] < before:
                w, (value, grad, curve) = goal, trial
            else:
                found, at = shorter(w, goal - w, mu)
                passes += 1
                if found >= before:
                    break
                w = at
                value, grad, curve = measure(w, mu)
                passes += 1
            if before - value <= TOLERANCE * mu:
                break
        if mu <= least:
            return w, value, passes
        mu = max(mu / SHRINK, least)


class _Settings(HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    loss = Param(Params._dummy(), "loss", "hinge (labels 0 and 1) or epsilon", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)


class MarginMachine(Estimator, _Settings):
    """Fits the loss of this module; rows without a label are left out, a table without any raises ``ValueError``."""

    l1 = Param(Params._dummy(), "l1", "weight of the absolute penalty", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "weight of half the squared penalty", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half width of the tube without loss", TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "last rounding of the kink, in units of the label's spread", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", loss="hinge", l1=0.0, l2=0.0, epsilon=0.1, smoothing=1e-3, suffix=""):
        super().__init__()
        self._setDefault(loss="hinge", l1=0.0, l2=0.0, epsilon=0.1, smoothing=1e-3, suffix="")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MarginModel:
        p = self.getOrDefault
        if p("loss") not in LOSSES:
            raise ValueError(f"no loss named {p('loss')!r}")
        rows = keep(
            df.where(F.col(self.getLabelCol()).isNotNull())
            .select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        )
        shape = rows.agg(F.max(F.size("x")), F.avg("y"), F.stddev_pop("y")).first()
        if shape[0] is None:
            raise ValueError("a margin model needs labelled rows")
        hinged = p("loss") == "hinge"
        try:
            w, value, passes = minimise(
                rows, p("loss"), shape[0], p("l1"), p("l2"), p("epsilon"), 1.0 if hinged else (shape[2] or 1.0),
                0.0 if hinged else (shape[1] or 0.0), p("smoothing"),
            )
        finally:
            rows.unpersist()
        learned = {"weights": w[:-1].tolist(), "intercept": float(w[-1]), "objective": value, "passes": passes}
        return MarginModel(featuresCol=self.getFeaturesCol(), loss=p("loss"), suffix=p("suffix"), learned=json.dumps(learned))


class MarginModel(Transformer, _Settings):
    """Adds ``prediction``: the margin itself, or for the hinge its side (1 above 0) next to ``rawPrediction`` (minus and plus the margin)."""

    learned = Param(Params._dummy(), "learned", "weights, intercept and objective as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", loss="hinge", suffix="", learned=None):
        super().__init__()
        self._setDefault(loss="hinge", suffix="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(json.loads(self.getOrDefault("learned"))["weights"])

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault("learned"))["intercept"]

    @property
    def objective(self) -> float:
        return json.loads(self.getOrDefault("learned"))["objective"]

    def _transform(self, df: DataFrame) -> DataFrame:
        sfx = self.getOrDefault("suffix")
        products = F.zip_with(vector_to_array(self.getFeaturesCol()), F.lit(self.coefficients.toArray().tolist()).cast("array<double>"), lambda a, b: a * b)
        margin = F.aggregate(products, F.lit(self.intercept), lambda s, v: s + v)
        if self.getOrDefault("loss") != "hinge":
            return df.withColumn(f"prediction{sfx}", margin)
        out = df.withColumn("_margin", margin)
        return out.withColumns({
            f"rawPrediction{sfx}": array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
            f"prediction{sfx}": (F.col("_margin") > 0).cast("double"),
        }).drop("_margin")
