"""Models, model-based selection, evaluation, tuning, ensembles and the search jobs as named queries."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators import cv, ensemble, knn, metrics, models, selectors, trees, tune
from tabloom.operators.transformers import majority, mean_of
from tabloom.plans import search
from tabloom.plans.frames import DOC_FEATURES, DOCS_SQL, LINES_SQL, doc_features, docs_frame, lines_frame, raw_doc_features, table
from tabloom.plans.registry import query
from tabloom.plans.sqltext import hash_sql
from tabloom.session import keep, shared_folder
from tabloom.sources import store
from tabloom.sources.tables import with_folds

C, R = "classification", "regression"
NAMES = list(DOC_FEATURES)
KEYS = ["doc_id"]
QUERY_SEARCH = search.DEFAULT


def labelled(spark: SparkSession, sf: str, folds: int = 5) -> DataFrame:
    """Documents with standardised features, binary label and stratified folds, persisted."""
    return keep(with_folds(doc_features(spark, sf), folds, KEYS, "label"))


def numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Regression frame: length of every document, labelled or not, from its other text statistics."""
    return doc_features(spark, sf, labelled=False).drop("label").withColumnRenamed("log_chars", "label")


REG_NAMES = [n for n in NAMES if n != "log_chars"]


def _model_query(name: str, model: str, problem: str, keep_score: bool = True) -> None:
    @query(name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        if problem == C:
            df, names = doc_features(spark, sf), NAMES
        else:
            df, names = numbers(spark, sf), REG_NAMES
        df = keep(df)
        scored = cv.score_column(models.fit(models.get(model, problem), df, names).transform(df))
        return scored.select("doc_id", "label", "prediction", F.round("score", 6).alias("score"))


for _name, _model, _problem in (
    ("clf_logistic_base", "LogisticRegression", C),
    ("clf_extra_trees_base", "RandomForestClassifier", C),
    ("clf_logistic_l2", "logistic_l2", C),
    ("clf_logistic_enet", "logistic_elasticnet", C),
    ("clf_random_forest", "random_forest", C),
    ("clf_extra_trees", "extra_trees", C),
    ("clf_svm_rbf", "svm", C),
    ("clf_gbt", "xgboost", C),
    ("clf_gbt_leafwise", "lightgbm", C),
    ("clf_decision_tree", "decision_tree", C),
    ("clf_gradient_boosting", "gradient_boosting", C),
    ("clf_ridge", "ridge_classifier", C),
    ("clf_sgd", "sgd_classifier", C),
    ("reg_lasso", "lasso", R),
    ("reg_elasticnet", "elasticnet_regressor", R),
    ("reg_random_forest", "random_forest", R),
    ("reg_extra_trees", "extra_trees", R),
    ("reg_svm_rbf", "svm", R),
    ("reg_gbt", "xgboost", R),
    ("reg_decision_tree", "decision_tree", R),
):
    _model_query(_name, _model, _problem)


@query("clf_hinge_l1")
def clf_hinge_l1(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of the hinge loss under an absolute penalty; features it does not need have exactly 0."""
    m = models.fit(models.get("sgd_classifier"), keep(doc_features(spark, sf)), NAMES, {"penalty": "l1", "alpha": 0.01}).stages[-1]
    rows = [(n, float(w), bool(w == 0)) for n, w in zip(NAMES, m.coefficients)]
    return spark.createDataFrame(rows, "feature string, weight double, dropped boolean").withColumn("weight", F.round("weight", 6))


@query(
    "reg_ridge",
    sql="""WITH m AS (SELECT count(*)::DOUBLE AS n, avg(l_quantity) AS ma, avg(l_discount) AS mb, avg(l_extendedprice) AS my,
      var_pop(l_quantity) * count(*) AS aa, var_pop(l_discount) * count(*) AS bb, covar_pop(l_quantity, l_discount) * count(*) AS ab,
      covar_pop(l_quantity, l_extendedprice) * count(*) AS ay, covar_pop(l_discount, l_extendedprice) * count(*) AS yb FROM lineitem),
    w AS (SELECT *, (ay * (bb + 1) - yb * ab) / ((aa + 1) * (bb + 1) - ab * ab) AS wa, ((aa + 1) * yb - ab * ay) / ((aa + 1) * (bb + 1) - ab * ab) AS wb FROM m)
    SELECT round(wa, 3) AS w_quantity, round(wb, 3) AS w_discount, round(my - wa * ma - wb * mb, 3) AS intercept FROM w""",
)
def reg_ridge(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge(1.0) of the line price on quantity and discount; checked against the closed form."""
    df = table(spark, sf, "lineitem").select("l_quantity", "l_discount", F.col("l_extendedprice").alias("label"))
    m = models.fit(models.get("ridge", R), df, ["l_quantity", "l_discount"]).stages[-1]
    row = (float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept))
    out = spark.createDataFrame([row], "w_quantity double, w_discount double, intercept double")
    return out.select(*[F.round(c, 3).alias(c) for c in out.columns])


_NB = ("l_quantity", "l_extendedprice", "l_discount")


def _nb_sql(smoothing: float = 1e-9) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _NB)
    eps = f"{smoothing:g}::DOUBLE * greatest(" + ", ".join(f"(SELECT var_pop({c}) FROM t)" for c in _NB) + ")"
    ll = " + ".join(f"-0.5 * ln(2 * pi() * (v_{c} + e)) - 0.5 * pow({c} - m_{c}, 2) / (v_{c} + e)" for c in _NB)
    return f"""WITH t AS ({LINES_SQL}), p AS (SELECT label AS y, count(*)::DOUBLE AS n, {stats} FROM t GROUP BY 1), e AS (SELECT {eps} AS e),
    s AS (SELECT t.*, y, ln(n / (SELECT count(*) FROM t)) + {ll} AS ll FROM t CROSS JOIN p CROSS JOIN e),
    z AS (SELECT l_orderkey, l_linenumber, l_extendedprice, max(CASE WHEN y = 1 THEN ll END) AS l1, max(CASE WHEN y = 0 THEN ll END) AS l0
      FROM s GROUP BY l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount)
    SELECT l_orderkey, l_linenumber, l_extendedprice, round(1 / (1 + exp(l0 - l1)), 6) AS probability FROM z"""


@query("clf_gaussian_nb", sql=_nb_sql())
def clf_gaussian_nb(spark: SparkSession, sf: str) -> DataFrame:
    df = lines_frame(spark, sf)
    m = models.fit(models.get("gaussian_nb"), df, _NB)
    return m.transform(df).select("l_orderkey", "l_linenumber", "l_extendedprice", F.round(vector_to_array("probability")[1], 6).alias("probability"))


_SMOOTHINGS = (1e-9, 1e-3, 0.1)


@query(
    "clf_gaussian_nb_smoothed",
    sql=" UNION ALL ".join(f"SELECT {v:g}::DOUBLE AS var_smoothing, * FROM ({_nb_sql(v)})" for v in _SMOOTHINGS),
)
def clf_gaussian_nb_smoothed(spark: SparkSession, sf: str) -> DataFrame:
    """Every line under three smoothings of the variances."""
    df = keep(lines_frame(spark, sf))
    parts = [
        models.fit(models.get("gaussian_nb"), df, _NB, {"var_smoothing": v}).transform(df)
        .select(F.lit(v).alias("var_smoothing"), "l_orderkey", "l_linenumber", "l_extendedprice", F.round(vector_to_array("probability")[1], 6).alias("probability"))
        for v in _SMOOTHINGS
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


_KNN_SQL = """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rn
  FROM e a JOIN e b ON a.vec_id <> b.vec_id), n AS (SELECT * FROM d WHERE rn <= 5)"""


@query(
    "clf_knn",
    sql=_KNN_SQL + """, c AS (SELECT vec_id, label, count(*) AS k FROM n GROUP BY 1, 2)
    SELECT vec_id, arg_min(label, (-k, label)) AS prediction FROM c GROUP BY 1""",
)
def clf_knn(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return knn.classify(e, e, "vec_id", "embedding", "label", 5, drop_self=True)


@query("reg_knn", sql=_KNN_SQL + " SELECT vec_id, round(avg(label), 6) AS prediction FROM n GROUP BY 1")
def reg_knn(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return knn.regress(e, e, "vec_id", "embedding", "label", 5, drop_self=True).select("vec_id", F.round("prediction", 6).alias("prediction"))


@query(
    "impute_knn",
    sql=f"""WITH t AS (SELECT doc_id, n_chars::DOUBLE AS a, length(text) - length(replace(text, ' ', '')) AS b, quality FROM ({DOCS_SQL})),
    d AS (SELECT g.doc_id, k.quality, row_number() OVER (PARTITION BY g.doc_id ORDER BY sqrt(pow(g.a - k.a, 2) + pow(g.b - k.b, 2)), k.doc_id) AS rn
      FROM t g JOIN t k ON g.quality IS NULL AND k.quality IS NOT NULL)
    SELECT doc_id, round(quality::DOUBLE, 6) AS quality FROM t WHERE quality IS NOT NULL
    UNION ALL SELECT doc_id, round(avg(quality), 6) FROM d WHERE rn <= 5 GROUP BY 1""",
)
def impute_knn(spark: SparkSession, sf: str) -> DataFrame:
    df = docs_frame(spark, sf).select(
        "doc_id", F.col("n_chars").alias("a"), (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("b"), "quality"
    )
    out = knn.impute(keep(df), "doc_id", "quality", ["a", "b"], 5)
    return out.select("doc_id", F.round(F.col("quality").cast("double"), 6).alias("quality"))


# ---- single trees, split by split ------------------------------------------------------------------

_TREE = ("l_quantity", "l_discount", "l_tax")


def _level_sql(source: str, out: str, least: int, weight: str = "1.0", mean: str = "0.0") -> str:
    """CTE ``out``: the best split (f, cut, gain, n) of every node of ``source`` (node, y and the features)."""
    score = lambda n, s: f"pow({s} - {n} * {mean}, 2) / ({n} * {weight})"
    place = " ".join(f"WHEN '{c}' THEN {k}" for k, c in enumerate(_TREE))
    return f"""{out}_v AS (SELECT node, f, v, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM (UNPIVOT {source} ON {", ".join(_TREE)} INTO NAME f VALUE v) GROUP BY node, f, v),
    {out}_c AS (SELECT node, f, v, sum(n) OVER (PARTITION BY node, f ORDER BY v) AS nl, sum(s) OVER (PARTITION BY node, f ORDER BY v) AS sl,
      sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s FROM {out}_v),
    {out}_g AS (SELECT node, f, v AS cut, n, {score("nl", "sl")} + {score("(n - nl)", "(s - sl)")} - {score("n", "s")} AS gain
      FROM {out}_c WHERE nl >= {least} AND n - nl >= {least}),
    {out} AS (SELECT node, f, cut, gain, n FROM {out}_g QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, CASE f {place} END, cut) = 1)"""


def _down_sql(source: str, splits: str, out: str) -> str:
    value = " ".join(f"WHEN '{c}' THEN {c}" for c in _TREE)
    return f"""{out} AS (SELECT s.node || CASE WHEN CASE p.f {value} END <= p.cut THEN 'L' ELSE 'R' END AS node, y, {", ".join(_TREE)}
      FROM {source} s JOIN {splits} p ON s.node = p.node)"""


def _tree_rows(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    lines = lines_frame(spark, sf).select(*_TREE, F.col("label").cast("double").alias("label"))
    return keep(trees.training_rows(VectorAssembler(inputCols=list(_TREE), outputCol="features").transform(lines), "features", "label"))


def _splits(spark: SparkSession, tree: trees.Tree) -> DataFrame:
    rows, stack = [], [(0, "")]
    while stack:
        node, path = stack.pop()
        if tree.feature[node] >= 0:
            rows.append((path, _TREE[tree.feature[node]], tree.threshold[node], int(tree.weight[node]), round(tree.gain[node], 5)))
            stack += [(tree.left[node], path + "L"), (tree.right[node], path + "R")]
    return spark.createDataFrame(rows, "node string, feature string, threshold double, n long, gain double")


_ROOT_SQL = f"r0 AS (SELECT '' AS node, label AS y, {', '.join(_TREE)} FROM ({LINES_SQL}))"
_SPLIT_COLUMNS = "node, f AS feature, cut AS threshold, n::BIGINT AS n, round(gain, 5) AS gain"


@query(
    "tree_splits",
    sql=f"""WITH {_ROOT_SQL}, {_level_sql("r0", "b0", 40)}, {_down_sql("r0", "b0", "r1")}, {_level_sql("r1", "b1", 40)}
    SELECT {_SPLIT_COLUMNS} FROM b0 UNION ALL SELECT {_SPLIT_COLUMNS} FROM b1 WHERE n >= 100""",
)
def tree_splits(spark: SparkSession, sf: str) -> DataFrame:
    """A decision tree of depth 2 over all order lines: every split with its rows and gain."""
    rows = _tree_rows(spark, sf)
    how = trees.Growth(n_trees=1, max_depth=2, min_samples_split=100, min_samples_leaf=40, max_features="all", splitter="best")
    return _splits(spark, trees.grow(rows, len(_TREE), how)[0])


_SLOPES = {"least": 20, "weight": "(SELECT avg(y) * (1 - avg(y)) FROM r0)", "mean": "(SELECT avg(y) FROM r0)"}


@query(
    "gbt_leafwise_splits",
    sql=f"""WITH {_ROOT_SQL}, {_level_sql("r0", "b0", **_SLOPES)}, {_down_sql("r0", "b0", "r1")}, {_level_sql("r1", "b1", **_SLOPES)},
    {_down_sql("r1", "b1", "r2")}, {_level_sql("r2", "b2", **_SLOPES)},
    second AS (SELECT * FROM b1 ORDER BY gain DESC LIMIT 1),
    third AS (SELECT * FROM (SELECT * FROM b1 WHERE node NOT IN (SELECT node FROM second) UNION ALL SELECT * FROM b2 WHERE node[1] IN (SELECT node FROM second))
      ORDER BY gain DESC LIMIT 1)
    SELECT {_SPLIT_COLUMNS} FROM b0 UNION ALL SELECT {_SPLIT_COLUMNS} FROM second UNION ALL SELECT {_SPLIT_COLUMNS} FROM third""",
)
def gbt_leafwise_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The first boosted tree over all order lines with four leaves, best gains first: every split with its rows and gain."""
    rows = _tree_rows(spark, sf)
    how = trees.Boosting(leaves=4, subsample=1.0, colsample=1.0)
    mean = rows.agg(F.avg("y")).first()[0]
    start = math.log(mean / (1 - mean))
    stats = trees.first_slopes(start, how)
    tree = trees.leafwise_tree(rows, len(_TREE), stats, trees.feature_edges(rows, len(_TREE)), np.arange(len(_TREE)), how)
    return _splits(spark, tree)


# ---- model-based selection ------------------------------------------------------------------------


def _names_frame(spark: SparkSession, names) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, feature string")


def _selector_query(name: str, selector: str, **params) -> None:
    @query(name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        s = selectors.SELECTORS[selector]
        chosen = selectors.Selector(s.name, s.type, s.spec_type, s.run, {**s.params, **params})
        return _names_frame(spark, chosen.select(keep(doc_features(spark, sf)), NAMES, C))


_selector_query("sel_elasticnet", "elasticnet")
_selector_query("sel_lasso", "lasso")
_selector_query("sel_tree_importance", "extratrees")
_selector_query("sel_rfecv_linear", "rfe_linear")
_selector_query("sel_rfecv_tree", "rfe_non_linear", n_estimators=QUERY_SEARCH.trees, folds=QUERY_SEARCH.rfe_folds)


@query("sel_shap")
def sel_shap(spark: SparkSession, sf: str) -> DataFrame:
    scores = selectors.shap_importance(keep(doc_features(spark, sf)), NAMES, C, {"n_estimators": 50})
    return scores.orderBy(F.col("importance").desc(), "feature").limit(selectors.SHAP_K)


@query("sel_feature_names")
def sel_feature_names(spark: SparkSession, sf: str) -> DataFrame:
    """Selected features of a raw table, named through its preparation."""
    from tabloom.operators.preprocess import TabularPreprocessor
    from tabloom.plans.frames import orders_frame

    df = keep(orders_frame(spark, sf).withColumn("label", (F.col("o_orderstatus") == "F").cast("double")))
    prep = TabularPreprocessor(inputCols=["o_custkey", "o_orderpriority", "c_acctbal", "order_month", "c_mktsegment", "c_nationkey"], keepCols=["o_orderkey", "label"])
    m = prep.fit(df)
    return _names_frame(spark, selectors.run_chain(m.transform(df), m.feature_names, ["selectkbest", "elasticnet"], C))


@query("sel_search")
def sel_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.select_features(labelled(spark, sf, QUERY_SEARCH.folds), NAMES, C, QUERY_SEARCH).select(
        "name", F.array_join("selectors", ",").alias("selectors"), "model", "family", "priority", F.round("metric", 6).alias("metric"),
        F.array_join("selected_features", ",").alias("selected_features"),
    )


@query("model_search")
def model_search(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf, QUERY_SEARCH.folds)
    board = search.select_models(df, NAMES, C, "non_linear", "svm", QUERY_SEARCH)
    return board.select("name", "model", "family", F.round("metric", 6).alias("metric"))


# ---- evaluation -------------------------------------------------------------------------------------


@query("cv_evaluate")
def cv_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf)
    spec = models.get("LogisticRegression")
    got = cv.cross_validate(df, lambda t, _i: models.fit(spec, t, NAMES), 5)
    return spark.createDataFrame(sorted(got.items()), "metric string, value double")


@query("eval_threshold")
def eval_threshold(spark: SparkSession, sf: str) -> DataFrame:
    spec = models.get("LogisticRegression")
    return cv.evaluate_threshold(labelled(spark, sf), lambda t, _i: models.fit(spec, t, NAMES), 5, 0.5)


@query("final_evaluation")
def final_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf, QUERY_SEARCH.folds)
    tuned = models.get("logistic_l2")
    bases = [models.get("logistic_l2"), models.get("decision_tree")]
    finalists = {
        "tuned_logistic_l2": ("linear", lambda t, _i: models.fit(tuned, t, NAMES, {"C": 10})),
        "voting": ("ensemble", lambda t, _i: ensemble.fit_voting(t, bases, NAMES, C)),
    }
    board = search.evaluate_finalists(df, C, finalists, KEYS, QUERY_SEARCH)
    return board.select("name", "family", F.round("metric", 6).alias("metric"), F.col("params")["threshold"].alias("threshold"))


# ---- tuning -----------------------------------------------------------------------------------------


def _trials(spark: SparkSession, t: tune.Tuned) -> DataFrame:
    rows = [(str(sorted(p.items(), key=str)), float(s), p == t.params) for p, s in t.trials]
    return spark.createDataFrame(rows, "params string, score double, best boolean")


@query("tune_grid")
def tune_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _trials(spark, tune.tune_by_name(labelled(spark, sf, 3), "logistic_l2", NAMES, C))


@query("tune_random")
def tune_random(spark: SparkSession, sf: str) -> DataFrame:
    return _trials(spark, tune.tune_by_name(labelled(spark, sf, 3), "decision_tree", NAMES, C))


@query("tune_search")
def tune_search(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf, QUERY_SEARCH.folds)
    board, _tuned = search.tune_models(df, NAMES, C, ["logistic_l2", "decision_tree", "svm"], KEYS, QUERY_SEARCH)
    return board.select("name", "family", F.round("metric", 6).alias("metric"), F.to_json("params").alias("params"))


# ---- ensembles --------------------------------------------------------------------------------------

_SCORES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50 AS p0, l_discount * 10 AS p1, l_tax * 12.5 AS p2 FROM lineitem"""
_LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _score_columns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        *_LINE_KEYS, (F.col("l_quantity") / 50).alias("p0"), (F.col("l_discount") * 10).alias("p1"), (F.col("l_tax") * 12.5).alias("p2")
    )


@query("ens_vote_soft", sql=f"SELECT * EXCLUDE (p0, p1, p2), round((p0 + p1 + p2) / 3, 6) AS probability, CASE WHEN round((p0 + p1 + p2) / 3, 9) > 0.5 THEN 1 ELSE 0 END AS prediction FROM ({_SCORES_SQL})")
def ens_vote_soft(spark: SparkSession, sf: str) -> DataFrame:
    mean = mean_of([F.col("p0"), F.col("p1"), F.col("p2")])
    return _score_columns(spark, sf).select(*_LINE_KEYS, F.round(mean, 6).alias("probability"), (F.round(mean, 9) > 0.5).cast("int").alias("prediction"))


@query(
    "ens_vote_hard",
    sql=f"""SELECT * EXCLUDE (p0, p1, p2), CASE WHEN (p0 >= 0.5)::INT + (p1 >= 0.5)::INT + (p2 >= 0.5)::INT + (p0 >= 0.7)::INT > 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM ({_SCORES_SQL})""",
)
def ens_vote_hard(spark: SparkSession, sf: str) -> DataFrame:
    votes = [(F.col(c) >= t).cast("int") for c, t in (("p0", 0.5), ("p1", 0.5), ("p2", 0.5), ("p0", 0.7))]
    return _score_columns(spark, sf).select(*_LINE_KEYS, majority(votes).alias("prediction"))


@query("ens_vote_regression", sql=f"SELECT * EXCLUDE (p0, p1, p2), round((p0 + p1) / 2, 6) AS prediction FROM ({_SCORES_SQL})")
def ens_vote_regression(spark: SparkSession, sf: str) -> DataFrame:
    return _score_columns(spark, sf).select(*_LINE_KEYS, F.round(mean_of([F.col("p0"), F.col("p1")]), 6).alias("prediction"))


@query("ens_stack_classifier")
def ens_stack_classifier(spark: SparkSession, sf: str) -> DataFrame:
    df = keep(doc_features(spark, sf))
    m = ensemble.fit_stacking(df, [models.get("logistic_l2"), models.get("decision_tree")], NAMES, C)
    return cv.score_column(m.transform(df)).select("doc_id", "label", "prediction", F.round("score", 6).alias("score"))


@query("ens_stack_regressor")
def ens_stack_regressor(spark: SparkSession, sf: str) -> DataFrame:
    df = keep(numbers(spark, sf))
    m = ensemble.fit_stacking(df, [models.get("ridge", R), models.get("decision_tree", R)], REG_NAMES, R)
    return m.transform(df).select("doc_id", "label", F.round("prediction", 6).alias("prediction"))


@query("ens_search")
def ens_search(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf, QUERY_SEARCH.folds)
    bases = [models.get("logistic_l2"), models.get("decision_tree")]
    board = search.search_ensembles(df, NAMES, C, bases, QUERY_SEARCH)
    return board.select("name", "model", F.round("metric", 6).alias("metric"))


# ---- Bayes over documents: a closed form that SQL can follow through folds, store and scoring ------------

_BAYES = ("log_chars", "upper_share", "digit_share", "punct_share")


def _share_sql(kept: str) -> str:
    return f"coalesce(length(regexp_replace(text, '[^{kept}]', '', 'g'))::DOUBLE / nullif(length(text), 0), 0.0)"


def _bayes_sql(train: str, target: str, folds: int = 1) -> str:
    """CTEs up to ``z`` (i, doc_id, label, fold, score, prediction): model i learns from rows with ``train``, scores those with ``target``."""
    share = {"log_chars": "ln(1 + length(text))", "upper_share": _share_sql("A-Z"), "digit_share": _share_sql("0-9"), "punct_share": _share_sql(".,;:!?")}
    rank = f"CASE WHEN label IS NOT NULL THEN row_number() OVER (PARTITION BY label ORDER BY {hash_sql('doc_id')}) END"
    fold = " + ".join(f"CASE WHEN rn > ({k} * cnt) // 5 THEN 1 ELSE 0 END" for k in range(1, 5))
    stats = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in _BAYES)
    ll = " + ".join(f"-0.5 * ln(2 * pi() * (v_{c} + e)) - 0.5 * pow({c} - m_{c}, 2) / (v_{c} + e)" for c in _BAYES)
    return f"""WITH f0 AS (SELECT doc_id, quality AS label, {", ".join(f"{e} AS {c}" for c, e in share.items())} FROM ({DOCS_SQL})),
    f1 AS (SELECT *, {rank} AS rn, count(*) OVER (PARTITION BY label) AS cnt FROM f0), f AS (SELECT *, {fold} AS fold FROM f1),
    tr AS (SELECT i, f.* FROM f, range({folds}) r(i) WHERE label IS NOT NULL AND {train}),
    p AS (SELECT i, label AS y, count(*)::DOUBLE AS n, {stats} FROM tr GROUP BY i, label),
    e AS (SELECT i, count(*) AS total, 1e-9 * greatest({", ".join(f"var_pop({c})" for c in _BAYES)}) AS e FROM tr GROUP BY i),
    s AS (SELECT p.i, doc_id, label, fold, y, ln(n / total) + {ll} AS ll FROM f JOIN p ON {target} JOIN e ON e.i = p.i),
    w AS (SELECT i, doc_id, any_value(label) AS label, any_value(fold) AS fold, max(CASE WHEN y = 1 THEN ll END) AS l1, max(CASE WHEN y = 0 THEN ll END) AS l0 FROM s GROUP BY i, doc_id),
    z AS (SELECT i, doc_id, label, fold, 1 / (1 + exp(l0 - l1)) AS score, CASE WHEN l1 > l0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM w)"""


_RATES_SQL = """coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
_CELLS_SQL = ", ".join(
    f"count(*) FILTER (WHERE label = {y} AND prediction = {p})::DOUBLE AS {c}" for c, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
)


def bayes_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Plain text shares of every document and its quality label, null where there is none."""
    return keep(raw_doc_features(spark, sf, labelled=False).select("doc_id", "label", *_BAYES))


def _bayes_fit(train: DataFrame, _i: int = 0):
    return models.fit(models.get("gaussian_nb"), train, _BAYES)


def _bayes_folds(spark: SparkSession, sf: str) -> DataFrame:
    return keep(with_folds(bayes_frame(spark, sf).where("label is not null"), 5, KEYS, "label"))


@query(
    "cv_bayes",
    sql=_bayes_sql("fold <> i", "label IS NOT NULL", 5) + f""", parts AS (SELECT *, CASE WHEN fold = i THEN 'test' ELSE 'train' END AS part FROM z),
    c AS (SELECT i, part, {_CELLS_SQL} FROM parts GROUP BY i, part), r AS (SELECT i, part, {_RATES_SQL} FROM c),
    m AS (SELECT part, avg(accuracy) AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM r GROUP BY part)
    SELECT part || '_' || name AS metric, round(value, 8) AS value FROM (UNPIVOT m ON accuracy, precision, recall, f1 INTO NAME name VALUE value)""",
)
def cv_bayes(spark: SparkSession, sf: str) -> DataFrame:
    """Mean train and test metrics over five stratified folds; every fold model has a closed form."""
    got = cv.cross_validate(_bayes_folds(spark, sf), _bayes_fit, 5, auc=False)
    return spark.createDataFrame([(k, round(v, 8)) for k, v in sorted(got.items())], "metric string, value double")


@query("cv_out_of_fold", sql=_bayes_sql("fold <> i", "fold = p.i", 5) + " SELECT doc_id, fold::INT AS fold, label::DOUBLE AS label, prediction, round(score, 6) AS score FROM z WHERE label IS NOT NULL")
def cv_out_of_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Every labelled document scored by the fold model that did not see it."""
    return cv.out_of_fold(_bayes_folds(spark, sf), _bayes_fit, 5, KEYS).select("doc_id", "fold", "label", "prediction", F.round("score", 6).alias("score"))


@query(
    "eval_threshold_bayes",
    sql=_bayes_sql("fold <> i", "fold = p.i", 5) + f""", h AS (SELECT label, CASE WHEN score >= 0.9 THEN 1 ELSE 0 END AS prediction FROM z WHERE label IS NOT NULL),
    c AS (SELECT {_CELLS_SQL} FROM h), k AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
      coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
      coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) AS f0 FROM c)
    SELECT round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy, round((k.f1 + k.f0) / 2, 8) AS f1, round((p1 + p0) / 2, 8) AS precision,
      round((r1 + r0) / 2, 8) AS recall, round((r1 + r0) / 2, 8) AS roc_auc FROM k""",
)
def eval_threshold_bayes(spark: SparkSession, sf: str) -> DataFrame:
    out = cv.evaluate_threshold(_bayes_folds(spark, sf), _bayes_fit, 5, 0.9)
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


# ---- stored models ------------------------------------------------------------------------------------


def _stored(spark: SparkSession, df: DataFrame) -> str:
    model = _bayes_fit(df)
    acc = metrics.classification(model.transform(df), "label", "prediction").first()
    return store.save_model(spark, f"{shared_folder(spark)}/models", "bayes", model, acc.asDict(), _BAYES)


@query(
    "sink_model",
    sql=_bayes_sql("true", "label IS NOT NULL") + f""", c AS (SELECT {_CELLS_SQL} FROM z), r AS (SELECT {_RATES_SQL} FROM c)
    SELECT 'bayes' AS name, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, {len(_BAYES)} AS n_features FROM r""",
)
def sink_model(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of a stored model: the metrics it had on its training rows."""
    folder = _stored(spark, bayes_frame(spark, sf).where("label is not null"))
    m = F.col("metrics")
    return store.load_metadata(spark, folder).select(
        "name", F.round(m["accuracy"], 6).alias("accuracy"), F.round(m["f1"], 6).alias("f1"), F.size("selected_features").alias("n_features")
    )


@query("source_model", sql=_bayes_sql("true", "label IS NOT NULL") + " SELECT doc_id, label::DOUBLE AS label, prediction, round(score, 6) AS probability FROM z")
def source_model(spark: SparkSession, sf: str) -> DataFrame:
    """The model read back from its folder, applied to the rows it learned from."""
    df = bayes_frame(spark, sf).where("label is not null")
    scored = store.score(store.load_model(_stored(spark, df)), df)
    return scored.select("doc_id", "prediction", "label", F.round(vector_to_array("probability")[1], 6).alias("probability"))


@query("score_batch", sql=_bayes_sql("true", "label IS NULL") + " SELECT doc_id, prediction, round(score, 6) AS probability FROM z")
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label, scored by the stored model that learned from the labelled ones."""
    df = bayes_frame(spark, sf)
    known = F.col("label").isNotNull()
    scored = store.score(store.load_model(_stored(spark, df.where(known))), df.where(~known))
    return scored.select("doc_id", "prediction", F.round(vector_to_array("probability")[1], 6).alias("probability"))
