"""Hyper-parameter search: full grid or seeded random trials, scored by cross-validation."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from tabloom.operators import cv, metrics, models
from tabloom.session import together

FOLDS, TRIALS, SEED = 3, 30, 42


@dataclass(frozen=True)
class Domain:
    """Values a parameter can take: the grid walks through them, a trial draws among them or between their ends."""

    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


class WholeRange(Domain):
    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.values[0], self.values[-1])


class RealRange(Domain):
    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.values[0], self.values[-1])


def choice(*values) -> Domain:
    return Domain(values)


def whole(*values: int) -> Domain:
    return WholeRange(values)


def real(*values: float) -> Domain:
    return RealRange(values)


# Search spaces per problem and model.
SPACES: dict[tuple[str, str], dict[str, Domain]] = {
    ("classification", "logistic_regression"): {"C": choice(0.01, 0.1, 1, 10), "penalty": choice("l2"), "solver": choice("lbfgs", "saga")},
    ("classification", "ridge_classifier"): {"alpha": real(0.1, 1.0, 10.0)},
    ("classification", "sgd_classifier"): {
        "alpha": real(1e-4, 1e-3, 1e-2),
        "loss": choice("hinge", "log_loss"),
        "penalty": choice("l2", "l1"),
    },
    ("classification", "random_forest"): {
        "n_estimators": whole(100, 200, 300),
        "max_depth": choice(10, 15, 20, None),
        "min_samples_split": whole(2, 5, 10),
        "min_samples_leaf": whole(1, 2, 4),
        "max_features": choice("sqrt", "log2"),
    },
    ("classification", "gradient_boosting"): {
        "n_estimators": whole(100, 200),
        "learning_rate": real(0.01, 0.1, 0.2),
        "max_depth": whole(3, 5, 7),
        "subsample": real(0.8, 1.0),
    },
    ("classification", "extra_trees"): {
        "n_estimators": whole(100, 150, 300),
        "max_depth": choice(10, 15, 20, None),
        "min_samples_split": whole(2, 5, 10),
        "min_samples_leaf": whole(1, 2, 4),
    },
    ("classification", "decision_tree"): {
        "max_depth": choice(5, 10, 20, None),
        "min_samples_split": whole(2, 10, 20),
        "min_samples_leaf": whole(1, 2, 5),
    },
    ("classification", "kneighbors"): {
        "n_neighbors": whole(3, 5, 7, 11),
        "weights": choice("uniform", "distance"),
        "metric": choice("minkowski", "euclidean", "manhattan"),
    },
    ("classification", "gaussian_nb"): {"var_smoothing": real(1e-9, 1e-8, 1e-7)},
    ("regression", "random_forest"): {
        "n_estimators": whole(100, 200, 300),
        "max_depth": choice(10, 20, None),
        "min_samples_split": whole(2, 5, 10),
    },
    ("regression", "gradient_boosting"): {"n_estimators": whole(100, 200), "learning_rate": real(0.01, 0.1), "max_depth": whole(3, 5)},
    ("regression", "decision_tree"): {"max_depth": choice(5, 10, None), "min_samples_split": whole(2, 10)},
    ("regression", "kneighbors"): {"n_neighbors": whole(3, 5, 7), "weights": choice("uniform", "distance")},
}
GRID_MODELS = ("logistic_regression", "ridge_classifier", "sgd_classifier")
# parameters of the spaces that no library estimator distinguishes: equal candidates are fitted once
INERT = ("solver",)


def space(model: str, problem: str) -> dict[str, Domain]:
    try:
        return SPACES[(problem, model)]
    except KeyError:
        raise ValueError(f"no search space for {problem} model {model!r}") from None


def strategy(space_name: str) -> str:
    return "grid" if space_name in GRID_MODELS else "random"


def grid(space_: Mapping[str, Domain]) -> list[dict]:
    return [dict(zip(space_, v)) for v in itertools.product(*[d.values for d in space_.values()])]


def draws(space_: Mapping[str, Domain], trials: int = TRIALS, seed: int = SEED) -> list[dict]:
    """Seeded trials: each parameter draws from its declared domain."""
    rng = random.Random(seed)
    return [{name: domain.draw(rng) for name, domain in space_.items()} for _ in range(trials)]


@dataclass
class Tuned:
    spec: models.ModelSpec
    params: dict
    score: float
    trials: list[tuple[dict, float]]

    def refit(self, train: DataFrame, names: Sequence[str]) -> PipelineModel:
        return models.fit(self.spec, train, names, self.params)


def tune(
    df: DataFrame, spec: models.ModelSpec, names: Sequence[str], problem: str, candidates: Sequence[Mapping], folds: int = FOLDS
) -> Tuned:
    """Best candidate by the primary metric over the frame's ``fold`` column (``folds`` values).

    Candidates run concurrently and share what depends on a fold only; each scores its folds in one grouped aggregation.
    """
    metric = metrics.PRIMARY[problem]
    fit_key = lambda c: tuple(sorted((k, str(v)) for k, v in c.items() if k not in INERT))
    distinct: dict[tuple, dict] = {}
    for c in candidates:
        distinct.setdefault(fit_key(c), dict(c))

    trainings = [models.Training(df.where(df.fold != i), names) for i in range(folds)]

    def score(params: Mapping) -> float:
        ms = [t.fit(spec, params) for t in trainings]
        return cv.average_metrics(cv.fold_metrics(cv.fold_predictions(df, ms), problem, auc=False))[f"test_{metric}"]

    unique = list(distinct.values())
    try:
        scores = together(*[lambda p=p: score(p) for p in unique])
    finally:
        for t in trainings:
            t.done()
    lower = metric in metrics.LOWER_IS_BETTER
    best = min(range(len(unique)), key=lambda i: (scores[i] if lower else -scores[i], i))
    by_key = dict(zip(distinct, scores))  # every candidate is a trial, with the score of the fit it shares
    return Tuned(spec, unique[best], scores[best], [(dict(c), by_key[fit_key(c)]) for c in candidates])


def tune_by_name(df: DataFrame, model: str, names: Sequence[str], problem: str, folds: int = FOLDS, trials: int = TRIALS) -> Tuned:
    """Grid for the linear classifiers, seeded random trials otherwise; pool names map to the nearest space."""
    spec = models.get(model, problem)
    if spec.tuning is None:
        raise ValueError(f"no search space for {problem} model {model!r}")
    sp = space(spec.tuning, problem)
    return tune(df, spec, names, problem, grid(sp) if strategy(spec.tuning) == "grid" else draws(sp, trials), folds)
