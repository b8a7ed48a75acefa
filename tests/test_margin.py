import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import models
from tabloom.operators.margin import MarginMachine, hinge, insensitive, proximal_step
from tabloom.sources import store

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] - 0.4 * x[:, 1] + 0.5 * rng.normal(size=400) > 0.2).astype(float)
    z = 3.0 + 2.0 * x[:, 0] - x[:, 2] + 0.3 * rng.standard_t(2, size=400)
    rows = [(i, *map(float, r), float(t), float(u)) for i, (r, t, u) in enumerate(zip(x, y, z))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, z double").repartition(5).cache(), x, y, z


def assembled(df, label):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df.withColumn("label", F.col(label)))


@pytest.mark.parametrize("of", [hinge, insensitive])
def test_slopes_and_curvatures_are_derivatives(of):
    m, y, h = np.linspace(-3, 3, 211) + 0.0007, np.tile([0.0, 1.0], 106)[:211], 1e-6
    _v, slope, curve = of(m, y, 0.3, 0.1)
    np.testing.assert_allclose(slope, (of(m + h, y, 0.3, 0.1)[0] - of(m - h, y, 0.3, 0.1)[0]) / (2 * h), atol=1e-5)
    np.testing.assert_allclose(curve, (of(m + h, y, 0.3, 0.1)[1] - of(m - h, y, 0.3, 0.1)[1]) / (2 * h), atol=1e-4)


def test_proximal_step_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    root = rng.normal(size=(6, 6))
    curve, grad, w = root @ root.T + 0.1 * np.eye(6), rng.normal(size=6), rng.normal(size=6)
    new = proximal_step(w, grad, curve, 0.7)
    slope = grad + curve @ (new - w)
    assert abs(slope[-1]) < 1e-7
    for j in range(5):
        assert abs(slope[j] + 0.7 * np.sign(new[j])) < 1e-7 if new[j] else abs(slope[j]) <= 0.7 + 1e-7


@pytest.mark.parametrize("l1", [0.02, 0.1])
def test_hinge_with_l1_reaches_its_dual_and_has_exact_zeros(points, l1):
    """Any a in [0, 1] with sum of a * sign = 0 and |mean(a sign x)| <= l1 bounds the objective from below by mean(a)."""
    df, x, y, _z = points
    m = MarginMachine(loss="hinge", l1=l1).fit(assembled(df, "y"))
    w, b, sign = m.coefficients.toArray(), m.intercept, 2 * y - 1
    primal = np.maximum(1 - sign * (x @ w + b), 0).mean() + l1 * np.abs(w).sum()
    a = np.clip((1 - sign * (x @ w + b)) / 1e-3, 0, 1)
    spare = (a * sign).mean()
    assert abs(spare) < 1e-3
    a *= min(1.0, l1 / max(np.abs(x.T @ (a * sign) / len(y)).max(), 1e-12))
    assert a.mean() - abs(spare) * (abs(b) + 1) <= primal <= a.mean() + 5e-3
    assert (w == 0).any() and w[0] > 0
    assert m.objective == pytest.approx(primal, abs=1e-3)


def test_penalty_beyond_the_largest_slope_leaves_no_feature(points):
    df, *_ = points
    assert not MarginMachine(loss="hinge", l1=5.0).fit(assembled(df, "y")).coefficients.toArray().any()


def test_epsilon_insensitive_reaches_its_dual(points):
    """mean(a z) - eps mean|a| - |mean(a x)|^2 / (2 l2) bounds the objective for a in [-1, 1] that sum to 0."""
    df, x, _y, z = points
    l2, eps = 0.05, 0.1
    m = MarginMachine(loss="epsilon", l2=l2, epsilon=eps).fit(assembled(df, "z"))
    w, b = m.coefficients.toArray(), m.intercept
    r = z - x @ w - b
    primal = np.maximum(np.abs(r) - eps, 0).mean() + 0.5 * l2 * w @ w
    a = np.sign(r) * np.clip((np.abs(r) - eps) / (1e-3 * z.std()), 0, 1)
    assert abs(a.mean()) < 1e-3
    dual = a @ z / len(z) - eps * np.abs(a).mean() - (x.T @ a / len(z)) @ (x.T @ a / len(z)) / (2 * l2)
    assert abs(primal - dual) < 5e-3 and w[0] == pytest.approx(1.9, abs=0.25)


def test_result_depends_on_rows_and_not_on_partitions(points):
    df, *_ = points
    one, many = (MarginMachine(loss="hinge", l1=0.05).fit(assembled(df.repartition(k), "y")) for k in (1, 9))
    np.testing.assert_allclose(one.coefficients.toArray(), many.coefficients.toArray(), atol=1e-3)


def test_registered_models_use_it_and_are_stored(spark, points, tmp_path):
    df, x, y, z = points
    df = df.withColumn("label", F.col("y"))
    m = models.fit(models.get("sgd_classifier"), df, NAMES, {"loss": "hinge", "penalty": "l1", "alpha": 0.05}, "_s")
    got = store.load_model(store.save_model(spark, str(tmp_path), "m", m, {})).transform(df).orderBy("id").collect()
    assert np.mean([r["prediction_s"] == r["y"] for r in got]) > 0.8 and all((r["rawPrediction_s"][1] > 0) == r["prediction_s"] for r in got)
    reg = models.fit(models.get("svm", "regression"), df.withColumn("label", F.col("z")), NAMES).transform(df).orderBy("id").collect()
    assert np.median(np.abs([r["prediction"] - r["z"] for r in reg])) < 0.5


def test_odd_rows(points):
    df, *_ = points
    some = assembled(df.limit(30), "y")
    m = MarginMachine(loss="hinge", l2=0.1).fit(some.withColumn("label", F.when(F.col("id") > -1, 1.0)))  # one class
    assert {r["prediction"] for r in m.transform(some).collect()} == {1.0}
    with pytest.raises(ValueError):
        MarginMachine(loss="hinge").fit(some.limit(0))
    with pytest.raises(ValueError):
        MarginMachine(loss="squared").fit(some)
