import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import cv, ensemble, knn, models, selectors, tune
from tabloom.operators.shap import shap_values
from tabloom.sources import store
from tabloom.sources.tables import with_folds

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] + 0.2 * rng.normal(size=240) > 0).astype(float)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = with_folds(spark.createDataFrame(rows, "id long, a double, b double, c double, label double"), 3, ["id"], "label")
    return df.cache(), x, y


def test_ridge_and_lasso_follow_the_usual_objectives(data):
    df, x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = models.fit(models.get("ridge", "regression"), df, NAMES).stages[-1]
    np.testing.assert_allclose(ridge.coefficients.toArray(), np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc), rtol=1e-6)
    alpha, w = 0.05, np.zeros(3)
    for _ in range(500):
        for j in range(3):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(y))
    got = selectors.linear_coefficients(df, NAMES, alpha, 1.0)
    np.testing.assert_allclose(got, w, atol=1e-5)


@pytest.mark.parametrize("smoothing", [1e-9, 0.1, 2.0])
def test_gaussian_bayes_follows_its_densities(spark, data, smoothing, tmp_path):
    df, x, _y = data
    y = np.array([r["label"] for r in df.orderBy("id").select("label").collect()])
    added = smoothing * x.var(0).max()
    joint = []
    for k in (0, 1):
        part = x[y == k]
        v = part.var(0) + added
        joint.append(np.log(len(part) / len(x)) - 0.5 * (np.log(2 * np.pi * v) + (x - part.mean(0)) ** 2 / v).sum(1))
    want = 1 / (1 + np.exp(joint[0] - joint[1]))
    model = models.fit(models.get("gaussian_nb"), df, NAMES, {"var_smoothing": smoothing}, "_s")
    folder = store.save_model(spark, str(tmp_path), "bayes", model, {})
    for m in (model, store.load_model(folder)):
        rows = m.transform(df).orderBy("id").collect()
        np.testing.assert_allclose([r["probability_s"][1] for r in rows], want, atol=1e-9)
        assert [r["prediction_s"] for r in rows] == (want > 0.5).astype(float).tolist()


def test_gaussian_bayes_of_odd_rows(spark):
    """A constant feature, a class of one row, a label that does not occur, rows without a label."""
    df = spark.createDataFrame([(0.0, 1.0, 5.0), (0.0, 2.0, 5.0), (2.0, 9.0, 5.0), (None, 3.0, 5.0)], "label double, a double, b double")
    rows = models.fit(models.get("gaussian_nb"), df, ["a", "b"]).transform(df).orderBy("a").collect()
    assert [r["prediction"] for r in rows] == [0, 0, 0, 2]
    assert all(r["probability"][1] == 0 and sum(r["probability"]) == pytest.approx(1) for r in rows)
    constant = df.select("label", F.lit(1.0).alias("a"))
    assert models.fit(models.get("gaussian_nb"), constant, ["a"]).transform(constant).first()["probability"].toArray().tolist() == pytest.approx([2 / 3, 0, 1 / 3])
    with pytest.raises(ValueError):
        models.fit(models.get("gaussian_nb"), df.limit(0), ["a"])


def test_shap_adds_up(data):
    df, _x, _y = data
    m = models.fit(models.get("extra_trees"), df, NAMES, {"n_estimators": 6, "max_depth": 5})
    scored = cv.score_column(m.transform(df))
    phi = shap_values(scored, m, "features", 3, ["id"])
    gap = scored.join(phi, "id").select(F.max(F.abs(F.col("score") - F.col("base") - F.aggregate("phi", F.lit(0.0), lambda s, v: s + v))))
    assert gap.first()[0] < 1e-9


def test_out_of_fold_covers_every_row_once(data):
    df, _x, _y = data
    spec = models.get("logistic_l2")
    oof = cv.out_of_fold(df, lambda t, _i: models.fit(spec, t, NAMES), 3, ["id"])
    assert oof.count() == 240 == oof.select("id").distinct().count()


def test_selectors_keep_the_signal(data):
    df, _x, _y = data
    assert "a" in selectors.SELECTORS["elasticnet"].select(df, NAMES, "classification")
    assert "a" in selectors.SELECTORS["rfe_linear"].select(df, NAMES, "classification")
    assert selectors.keep_from_median([0.1, -0.5, 0.3], NAMES) == ["b", "c"]


def test_grid_prefers_the_best_candidate(data):
    df, _x, _y = data
    t = tune.tune(df, models.get("decision_tree"), NAMES, "classification", [{"max_depth": 1}, {"max_depth": 4}])
    assert t.score == max(s for _p, s in t.trials)
    assert len(tune.grid(tune.space("random_forest", "classification"))) == 216
    assert tune.draws(tune.space("extra_trees", "classification")) == tune.draws(tune.space("extra_trees", "classification"))
    with pytest.raises(ValueError):
        tune.space("unknown", "classification")


def test_hard_vote_when_a_base_has_no_probability(data):
    df, _x, _y = data
    hard = ensemble.fit_voting(df, [models.get("ridge_classifier"), models.get("decision_tree")], NAMES, "classification")
    assert "probability" not in hard.transform(df).columns
    soft = ensemble.fit_voting(df, [models.get("logistic_l2"), models.get("decision_tree")], NAMES, "classification")
    assert "probability" in soft.transform(df).columns


def test_pool_rules():
    pick = lambda *a: [s.name for s in models.candidate_pool(*a)]
    assert pick("classification", "linear", "linear", 10, 2) == ["logistic_l2", "logistic_elasticnet"]
    assert pick("regression", "linear", "linear", 10, 2) == ["ridge", "lasso", "elasticnet_regressor"]
    assert pick("classification", "non_linear", "svm", 10, 2) == ["random_forest", "extra_trees", "svm"]
    assert pick("classification", "non_linear", "tree", 1000, 11) == ["random_forest", "extra_trees"]
    assert pick("classification", "non_linear", "tree", 1001, 11) == ["random_forest", "extra_trees", "xgboost", "lightgbm"]


def test_store_round_trip(spark, data, tmp_path):
    df, _x, _y = data
    m = models.fit(models.get("extra_trees"), df, NAMES, {"n_estimators": 4, "max_depth": 3})
    a = store.save_model(spark, str(tmp_path), "m", m, {"accuracy": 0.95}, NAMES)
    assert a != store.save_model(spark, str(tmp_path), "m", m, {"accuracy": 0.95}, NAMES)
    want = m.transform(df).select("id", "prediction").orderBy("id").collect()
    assert store.load_model(a).transform(df).select("id", "prediction").orderBy("id").collect() == want
    meta = store.load_metadata(spark, a).first()
    assert meta["metrics"] == {"accuracy": 0.95} and meta["selected_features"] == NAMES
    with pytest.raises(FileNotFoundError):
        store.load_model(str(tmp_path / "absent"))


def test_neighbours_equal_brute_force_with_a_crowded_point(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)).round(2)
    x[::3] = 0.5  # a third of all rows are copies
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "PIVOTS", 8)
    monkeypatch.setattr(knn, "MERGE_BLOCKS", 2)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    got = {}
    for r in knn.neighbours(df, df, "id", "v", 4, drop_self=True).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    for i in range(300):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        want = np.lexsort((np.arange(300), d))[:4].tolist()
        assert [got[i][k] for k in range(1, 5)] == want


def test_neighbours_of_equal_and_distant_vectors():
    from tabloom.operators import knn

    rng = np.random.default_rng(5)
    t = np.concatenate([rng.normal(size=(60, 3)) + 1e4, np.zeros((40, 3))])
    q = np.concatenate([t[:80], [[np.nan] * 3]])
    same = np.arange(len(q))[:, None] == np.arange(len(t))[None, :]
    qi, ti, d = knn._nearest(q, t, 4, same)
    for i in range(80):
        exact = np.sqrt(((t - q[i]) ** 2).sum(1))
        exact[i] = np.inf
        want = np.argsort(exact, kind="stable")[:4]
        assert ti[qi == i].tolist() == want.tolist() and d[qi == i] == pytest.approx(exact[want])
    assert 80 not in qi


def test_library_forests_keep_the_nodes_of_rows():
    for problem in ("classification", "regression"):
        est = models.get("random_forest", problem).build(models.Shape(100), {})
        assert est.getCacheNodeIds() and est.getNumTrees() == 100


def test_elimination_scores_all_sizes_in_one_reading(spark, monkeypatch):
    df = spark.range(240).select(
        "id", *[(F.xxhash64("id", F.lit(c)) % 100 / 100).alias(c) for c in ("p", "q", "r")], (F.col("id") % 2).cast("double").alias("fold_key")
    ).withColumn("label", (F.col("p") > 0).cast("double")).withColumn("rfe_fold", (F.col("id") % 2).cast("int")).persist()
    scored, real = [], selectors.metrics.classification
    monkeypatch.setattr(selectors.metrics, "classification", lambda d, *a: scored.append(d) or real(d, *a))
    spec = models.get("LogisticRegression")
    names, mean = selectors.rfe_cv(df, ["p", "q", "r"], "classification", spec, {}, 1, 2)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in scored]
    assert len(plans) == 2 and all(p.count("InMemoryRelation") == 1 for p in plans)
    want = {}
    for i in range(2):
        train, test = df.where(F.col("rfe_fold") != i), df.where(F.col("rfe_fold") == i)
        for live, model in selectors.elimination_path(train, ["p", "q", "r"], spec, {}, 1):
            r = model.transform(test).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
            want.setdefault(len(live), []).append(r)
    assert mean == {size: sum(v) / 2 for size, v in want.items()} and "p" in names
