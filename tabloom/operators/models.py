"""Model bank: named specs that build library estimators.

A spec's ``build`` receives the training shape, because penalties given per sample in
the usual (C, alpha) form map to per-objective penalties that depend on n and the
label's spread.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.bayes import GaussianBayes
from tabloom.operators.deep_tree import DeepTree
from tabloom.operators.margin import MarginMachine
from tabloom.operators.transformers import RbfSvm
from tabloom.operators.trees import Forest, LeafwiseBoosting, Prepared

LABEL, FEATURES, SEED = "label", "features", 42
BOOST_MIN_ROWS, BOOST_MIN_FEATURES = 1000, 10
MLLIB_MAX_DEPTH = 30


@dataclass(frozen=True)
class Shape:
    """What a fit needs to know about its training data."""

    n: int
    y_std: float = 1.0
    suffix: str = ""
    classes: int = 2


Builder = Callable[[Shape, Mapping], Estimator]


@dataclass(frozen=True)
class ModelSpec:
    name: str
    spec_type: str  # linear or non_linear
    model_based: str  # linear, tree or svm: the family that ranking diversifies over
    build: Builder
    params: Mapping = field(default_factory=dict)
    tuning: str | None = None  # name of its search space
    probabilistic: bool = True

    def with_params(self, **params) -> ModelSpec:
        return ModelSpec(
            self.name, self.spec_type, self.model_based, self.build, {**self.params, **params}, self.tuning, self.probabilistic
        )


def _out(est, s: Shape, proba: bool = True):
    est = est.setFeaturesCol(FEATURES).setLabelCol(LABEL).setPredictionCol(f"prediction{s.suffix}")
    if proba:
        est = est.setProbabilityCol(f"probability{s.suffix}").setRawPredictionCol(f"rawPrediction{s.suffix}")
    return est


def _logistic(s: Shape, p: Mapping) -> Estimator:
    est = LogisticRegression(
        regParam=1.0 / (p.get("C", 1.0) * max(s.n, 1)), elasticNetParam=p.get("l1_ratio", 0.0), standardization=False,
        maxIter=p.get("max_iter", 100),
    )
    return _out(est, s)


def linear_penalty(alpha: float, l1_ratio: float, n: int, y_std: float, ridge_sum: bool = False) -> tuple[float, float]:
    """(regParam, elasticNetParam) for a squared loss penalised per sample (or per sum for ridge).

    The library's objective is scaled by the label's spread for its quadratic part.
    """
    if ridge_sum:
        return alpha * y_std / max(n, 1), 0.0
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * y_std
    total = l1 + l2
    return total, (l1 / total if total else 0.0)


def _linear(kind: str) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        alpha = p.get("alpha", 1.0)
        ratio = {"ridge": 0.0, "lasso": 1.0, "elasticnet": p.get("l1_ratio", 0.5)}[kind]
        reg, mix = linear_penalty(alpha, ratio, s.n, s.y_std, ridge_sum=kind == "ridge")
        est = LinearRegression(regParam=reg, elasticNetParam=mix, standardization=False, solver="auto")
        return _out(est, s, proba=False)

    return build


def _depth(p: Mapping, default: int) -> int:
    d = p.get("max_depth", default)
    return MLLIB_MAX_DEPTH if d is None else min(int(d), MLLIB_MAX_DEPTH)


def binding(p: Mapping) -> bool:
    """Whether ``min_samples_split`` forbids a split that the rows per leaf allow; the library's trees know only the latter."""
    return int(p.get("min_samples_split", 2)) > 2 * int(p.get("min_samples_leaf", 1))


def _grown(p: Mapping, problem: str, s: Shape, trees: int, depth: int, subset: str, splitter: str, bootstrap: bool = False) -> Estimator:
    return Forest(
        numTrees=int(p.get("n_estimators", trees)), maxDepth=_depth(p, depth), minSamplesSplit=int(p.get("min_samples_split", 2)),
        minSamplesLeaf=int(p.get("min_samples_leaf", 1)), maxFeatures=subset, splitter=splitter, bootstrap=bootstrap, problem=problem,
        suffix=s.suffix, seed=SEED,
    )


def _forest(problem: str) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        subset = p.get("max_features", "sqrt" if problem == "classification" else "all")
        if binding(p):
            return _grown(p, problem, s, 100, 10, subset, "best", bootstrap=True)
        cls = RandomForestClassifier if problem == "classification" else RandomForestRegressor
        # a row's node of every tree is kept from level to level: no walk from the roots in each pass
        est = cls(
            numTrees=int(p.get("n_estimators", 100)), maxDepth=_depth(p, 10), minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            featureSubsetStrategy=subset, seed=SEED, cacheNodeIds=True,
        )
        return _out(est, s, problem == "classification")

    return build


def _extra(problem: str) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        subset = p.get("max_features", "sqrt" if problem == "classification" else "all")
        return _grown(p, problem, s, 100, 10, subset, "random")

    return build


def _svm(problem: str) -> Builder:
    return lambda s, p: RbfSvm(C=float(p.get("C", 1.0)), problem=problem, suffix=s.suffix, seed=SEED)


def _gbt(problem: str, defaults: Mapping) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        q = {**defaults, **p}
        cls = GBTClassifier if problem == "classification" else GBTRegressor
        est = cls(
            maxIter=int(q["n_estimators"]), maxDepth=_depth(q, 6), stepSize=float(q["learning_rate"]),
            subsamplingRate=float(q["subsample"]), featureSubsetStrategy=str(q.get("colsample", "all")), seed=SEED,
        )
        est = est.setFeaturesCol(FEATURES).setLabelCol(LABEL).setPredictionCol(f"prediction{s.suffix}")
        if problem == "classification":
            # the Python wrapper has no setter for these two shared output columns
            est = est.copy({est.probabilityCol: f"probability{s.suffix}", est.rawPredictionCol: f"rawPrediction{s.suffix}"})
        return est

    return build


def _leafwise(problem: str) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        q = {**_XGB, **p}
        settings = {
            "rounds": int(q["n_estimators"]), "rate": float(q["learning_rate"]), "max_depth": _depth(q, 6), "subsample": float(q["subsample"]),
            "colsample": float(q["colsample"]), "leaves": int(q.get("num_leaves", 31)), "min_samples_leaf": int(q.get("min_child_samples", 20)),
        }
        return LeafwiseBoosting(settings=json.dumps(settings), problem=problem, suffix=s.suffix, seed=SEED)

    return build


def _tree(problem: str) -> Builder:
    def build(s: Shape, p: Mapping) -> Estimator:
        if binding(p):
            return _grown({**p, "n_estimators": 1}, problem, s, 1, MLLIB_MAX_DEPTH, "all", "best")
        return DeepTree(maxDepth=_depth(p, MLLIB_MAX_DEPTH), minSamplesLeaf=int(p.get("min_samples_leaf", 1)), problem=problem, suffix=s.suffix)

    return build


def _naive_bayes(s: Shape, p: Mapping) -> Estimator:
    return GaussianBayes(varSmoothing=float(p.get("var_smoothing", 1e-9)), suffix=s.suffix)


def _ridge_classifier(s: Shape, p: Mapping) -> Estimator:
    """Ridge on labels 0/1 predicts the score; the sign of the +-1 form is score >= 0.5."""
    from pyspark.ml.feature import Binarizer

    reg, mix = linear_penalty(p.get("alpha", 1.0), 0.0, s.n, s.y_std, ridge_sum=True)
    score = LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol=f"_score{s.suffix}", regParam=reg, elasticNetParam=mix,
        standardization=False, solver="auto",
    )
    return Pipeline(stages=[score, Binarizer(inputCol=f"_score{s.suffix}", outputCol=f"prediction{s.suffix}", threshold=0.5)])


def _sgd(s: Shape, p: Mapping) -> Estimator:
    """Hinge or log loss with the per-sample penalty alpha."""
    alpha, loss = p.get("alpha", 1e-4), p.get("loss", "hinge")
    if loss == "log_loss":
        mix = 1.0 if p.get("penalty") == "l1" else 0.0
        return _out(LogisticRegression(regParam=alpha, elasticNetParam=mix, standardization=False), s)
    if p.get("penalty") == "l1":
        return MarginMachine(featuresCol=FEATURES, labelCol=LABEL, loss="hinge", l1=float(alpha), suffix=s.suffix)
    svc = LinearSVC(regParam=alpha, standardization=False).setFeaturesCol(FEATURES).setLabelCol(LABEL)
    return svc.setPredictionCol(f"prediction{s.suffix}").setRawPredictionCol(f"rawPrediction{s.suffix}")


_XGB = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "subsample": 0.8, "colsample": "0.8"}
_GB = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0}
C, R = "classification", "regression"

REGISTRY: dict[tuple[str, str], ModelSpec] = {}


def register(problem: str, spec: ModelSpec) -> None:
    """Add or replace a model; custom specs plug in here."""
    REGISTRY[(problem, spec.name)] = spec


for _spec in (
    ModelSpec("LogisticRegression", "linear", "linear", _logistic, tuning="logistic_regression"),
    ModelSpec("RandomForestClassifier", "non_linear", "tree", _extra(C), {"n_estimators": 50}, "extra_trees"),
    ModelSpec("logistic_l2", "linear", "linear", _logistic, tuning="logistic_regression"),
    ModelSpec("logistic_elasticnet", "linear", "linear", _logistic, {"l1_ratio": 0.5, "max_iter": 1000}, "logistic_regression"),
    ModelSpec("random_forest", "non_linear", "tree", _forest(C), tuning="random_forest"),
    ModelSpec("extra_trees", "non_linear", "tree", _extra(C), tuning="extra_trees"),
    ModelSpec("svm", "non_linear", "svm", _svm(C), tuning=None),
    ModelSpec("xgboost", "non_linear", "tree", _gbt(C, _XGB), tuning="gradient_boosting"),
    ModelSpec("lightgbm", "non_linear", "tree", _leafwise(C), tuning="gradient_boosting"),
    ModelSpec("decision_tree", "non_linear", "tree", _tree(C), tuning="decision_tree"),
    ModelSpec("gradient_boosting", "non_linear", "tree", _gbt(C, _GB), tuning="gradient_boosting"),
    ModelSpec("gaussian_nb", "non_linear", "bayes", _naive_bayes, tuning="gaussian_nb"),
    ModelSpec("ridge_classifier", "linear", "linear", _ridge_classifier, tuning="ridge_classifier", probabilistic=False),
    ModelSpec("sgd_classifier", "linear", "linear", _sgd, tuning="sgd_classifier", probabilistic=False),
):
    register(C, _spec)
for _spec in (
    ModelSpec("ridge", "linear", "linear", _linear("ridge")),
    ModelSpec("lasso", "linear", "linear", _linear("lasso")),
    ModelSpec("elasticnet_regressor", "linear", "linear", _linear("elasticnet")),
    ModelSpec("LinearRegression", "linear", "linear", _linear("ridge"), {"alpha": 0.0}),
    ModelSpec("ExtraTreesRegressor", "non_linear", "tree", _extra(R), {"n_estimators": 50}),
    ModelSpec("random_forest", "non_linear", "tree", _forest(R), tuning="random_forest"),
    ModelSpec("extra_trees", "non_linear", "tree", _extra(R), tuning="random_forest"),
    ModelSpec("svm", "non_linear", "svm", _svm(R)),
    ModelSpec("xgboost", "non_linear", "tree", _gbt(R, _XGB), tuning="gradient_boosting"),
    ModelSpec("lightgbm", "non_linear", "tree", _leafwise(R), tuning="gradient_boosting"),
    ModelSpec("decision_tree", "non_linear", "tree", _tree(R), tuning="decision_tree"),
    ModelSpec("gradient_boosting", "non_linear", "tree", _gbt(R, _GB), tuning="gradient_boosting"),
):
    register(R, _spec)


def get(name: str, problem: str = C) -> ModelSpec:
    try:
        return REGISTRY[(problem, name)]
    except KeyError:
        raise ValueError(f"no {problem} model named {name!r}") from None


def candidate_pool(problem: str, model_type: str, model_based: str, n_rows: int, n_features: int) -> list[ModelSpec]:
    """Models worth trying after feature selection."""
    if model_type == "linear":
        names = ["logistic_l2", "logistic_elasticnet"] if problem == C else ["ridge", "lasso", "elasticnet_regressor"]
    else:
        names = ["random_forest", "extra_trees"]
        if model_based != "tree":
            names.append("svm")
        elif n_rows > BOOST_MIN_ROWS and n_features > BOOST_MIN_FEATURES:
            names += ["xgboost", "lightgbm"]
    return [get(n, problem) for n in names]


def training_shape(train: DataFrame, suffix: str = "") -> Shape:
    row = train.agg(F.count(LABEL), F.stddev_pop(LABEL)).first()
    return Shape(row[0], row[1] or 1.0, suffix)


def stages(spec: ModelSpec, names: Sequence[str], shape: Shape, params: Mapping | None = None) -> list:
    assembler = VectorAssembler(inputCols=list(names), outputCol=FEATURES, handleInvalid="error")
    return [assembler, spec.build(shape, {**spec.params, **(params or {})})]


class Training:
    """One training frame for the fits of many candidates: its shape and its rows for trees are worked out once.

    Call ``done`` after the last fit.
    """

    def __init__(self, train: DataFrame, names: Sequence[str]):
        self.train, self.names = train, list(names)
        assembled = VectorAssembler(inputCols=self.names, outputCol=FEATURES, handleInvalid="error").transform(train)
        self.rows = Prepared(assembled, FEATURES, LABEL, shared=True)

    @property
    def shape(self) -> Shape:
        return self.rows.once("shape", lambda: training_shape(self.train))

    def fit(self, spec: ModelSpec, params: Mapping | None = None, names: Sequence[str] | None = None) -> PipelineModel:
        """A fit on all features, or on some of them in their order."""
        live = self.names if names is None else list(names)
        assembler, est = stages(spec, live, self.shape, params)
        if not hasattr(est, "fit_prepared"):
            return Pipeline(stages=[assembler, est]).fit(self.train)
        if live == self.names:
            return PipelineModel([assembler, est.fit_prepared(self.rows)])
        rows = self.rows.narrowed(assembler.transform(self.train), [self.names.index(n) for n in live])
        model = PipelineModel([assembler, est.fit_prepared(rows)])
        rows.done()
        return model

    def done(self) -> None:
        self.rows.done()


def fit(spec: ModelSpec, train: DataFrame, names: Sequence[str], params: Mapping | None = None, suffix: str = "") -> PipelineModel:
    """Fit one spec on the named feature columns of a frame with a ``label``."""
    return Pipeline(stages=stages(spec, names, training_shape(train, suffix), params)).fit(train)
