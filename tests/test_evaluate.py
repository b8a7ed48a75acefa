import math

import pytest

from tabloom.operators import metrics, ranking, univariate


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0), (0, 0.0)], "label int, prediction double")


def test_hard_label_scores(four):
    r = metrics.classification(four, "label", "prediction").first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (1.0, 0.5, pytest.approx(2 / 3), 0.75)
    assert metrics.threshold_score(four, "label", "prediction", "recall").first()["score"] == 0.5
    with pytest.raises(ValueError):
        metrics.threshold_score(four, "label", "prediction", "accuracy")


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0.0)], "label int, prediction double")
    assert metrics.classification(df, "label", "prediction").first()["f1"] == 0.0


def test_ties_keep_the_highest_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (0, 0.5), (1, 0.1), (0, 0.1), (0, 0.05)], "label int, score double")
    r = metrics.best_threshold(df, "label", "score", "precision").first()
    assert (r["best_threshold"], r["best_score"]) == (0.9, 1.0)
    none = metrics.best_threshold(df.where("score > 2"), "label", "score").first()
    assert (none["best_threshold"], none["best_score"]) == (0.5, -1.0)


def test_auc_counts_ties_half_and_matches_by_group(spark):
    rows = [(0, 1, 0.8), (0, 0, 0.8), (0, 0, 0.3), (0, 1, 0.9), (1, 1, 0.2), (1, 0, 0.7)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    assert metrics.roc_auc(df.where("g = 0"), "label", "score").first()[0] == pytest.approx(0.875)
    got = {r["g"]: r["roc_auc"] for r in metrics.roc_auc_by(df, "label", "score", ["g"]).collect()}
    assert got == pytest.approx({0: 0.875, 1: 0.0})
    many = {r["g"]: r["roc_auc"] for r in metrics.roc_auc_by(df, "label", "score", ["g"], range_rows=1).collect()}
    assert many == pytest.approx(got)


def test_roc_starts_at_infinity(four):
    rows = metrics.roc_curve(four, "label", "prediction").collect()
    assert max(r["threshold"] for r in rows) == math.inf and max(r["tpr"] for r in rows) == 1.0


def test_families_stay_diverse(spark):
    rows = [("a", "LR", 0.85), ("b", "RF", 0.95), ("c", "RF", 0.90), ("d", "SVM", 0.92), ("e", "GB", 0.94), ("f", "SVM", 0.88), ("g", None, None)]
    df = spark.createDataFrame(rows, "name string, family string, m double")
    top = ranking.top_k_by_group(df, "family", "m", "name").collect()
    assert [(r["family"], r["m"]) for r in top] == [("RF", 0.95), ("GB", 0.94), ("SVM", 0.92)]
    counts = {r["family"]: r["n_results"] for r in ranking.collect_by_group(df, "family", "m", "name").collect()}
    assert counts == {"LR": 1, "RF": 2, "SVM": 2, "GB": 1, "unknown": 1}
    assert [r["name"] for r in ranking.rank_results(df, "m", "name").collect()] == list("bedcfag")
    assert ranking.best_result(df, "m", "name", ascending=True).first()["name"] == "a"
    assert ranking.best_result(df.where("false"), "m", "name").count() == 0


def test_errors_rank_ascending():
    assert ranking.direction("test_mse") and not ranking.direction("test_f1")


def test_anova_equals_textbook(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0), ("b", 6.0)], "y string, x double")
    assert univariate.anova_scores(df, ["x"], "y").first()["score"] == pytest.approx(9.8)


def test_non_binary_labels_are_refused(spark):
    with pytest.raises(ValueError):
        metrics.check_binary(spark.createDataFrame([(2,)], "label int"), "label")
