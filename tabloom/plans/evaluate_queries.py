"""Metrics, thresholds, ranking and univariate selection as named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions.scalars import at_least
from tabloom.operators import metrics, ranking, univariate
from tabloom.plans.frames import LINES_SQL, lines_frame, table
from tabloom.plans.registry import query
from tabloom.plans.sqltext import sig

_PRED_SQL = f"SELECT *, CASE WHEN score >= 50 THEN 1 ELSE 0 END AS prediction FROM ({LINES_SQL})"
_CONF = """c AS (SELECT l_linestatus, sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
 sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
 sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn,
 sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn FROM t GROUP BY l_linestatus)"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return lines_frame(spark, sf).withColumn("prediction", at_least(F.col("score"), 50))


def _round(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, *[F.round(c, 8).alias(c) for c in df.columns if c not in keep])


@query(
    "met_classification",
    sql=f"""WITH t AS ({_PRED_SQL}), {_CONF} SELECT l_linestatus, round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1 FROM c""",
)
def met_classification(spark: SparkSession, sf: str) -> DataFrame:
    return _round(metrics.classification(_scored(spark, sf), "label", "prediction", ["l_linestatus"]), ("l_linestatus",))


@query(
    "met_regression",
    sql=f"""WITH t AS (SELECT l_linestatus, l_extendedprice AS y, 1000 * round(l_extendedprice / 1000, 0) + l_quantity AS p FROM lineitem)
    SELECT l_linestatus, {sig('avg((y - p) * (y - p))')} AS mse, round(avg(abs(y - p)), 6) AS mae,
    round(1 - avg((y - p) * (y - p)) / var_pop(y), 8) AS r2 FROM t GROUP BY l_linestatus""",
)
def met_regression(spark: SparkSession, sf: str) -> DataFrame:
    from tabloom.plans.profile_queries import sig_col

    df = table(spark, sf, "lineitem").select(
        "l_linestatus", F.col("l_extendedprice").alias("y"), (1000 * F.round(F.col("l_extendedprice") / 1000, 0) + F.col("l_quantity")).alias("p")
    )
    m = metrics.regression(df, "y", "p", ["l_linestatus"])
    return m.select("l_linestatus", sig_col(F.col("mse")).alias("mse"), F.round("mae", 6).alias("mae"), F.round("r2", 8).alias("r2"))


@query(
    "met_macro",
    sql=f"""WITH t AS ({_PRED_SQL}), {_CONF} SELECT l_linestatus, round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy,
    round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fn + fp)) / 2, 8) AS f1,
    round((tp / (tp + fp) + tn / (tn + fn)) / 2, 8) AS precision, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 8) AS recall,
    round((tp / (tp + fn) + tn / (tn + fp)) / 2, 8) AS roc_auc FROM c""",
)
def met_macro(spark: SparkSession, sf: str) -> DataFrame:
    return _round(metrics.macro(_scored(spark, sf), "label", "prediction", ["l_linestatus"]), ("l_linestatus",))


_CUM = """p AS (SELECT score AS threshold, sum(label) AS pos, count(*) - sum(label) AS neg FROM t GROUP BY 1),
 k AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM p WINDOW w AS (ORDER BY threshold DESC))"""


@query("met_roc_auc", sql=f"WITH t AS ({LINES_SQL}), {_CUM} SELECT round(sum(neg * (tp - pos / 2.0))::DOUBLE / (max(np)::DOUBLE * max(nn)), 8) AS roc_auc FROM k")
def met_roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return _round(metrics.roc_auc(lines_frame(spark, sf), "label", "score"))


@query("roc_curve", sql=f"WITH t AS ({LINES_SQL}), {_CUM} SELECT threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / np::DOUBLE, 8) AS tpr FROM k UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0")
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _round(metrics.roc_curve(lines_frame(spark, sf), "label", "score"), ("threshold",))


_THR = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{m}' AS metric, threshold AS best_threshold, round({e}, 8) AS best_score FROM k ORDER BY {e} DESC, threshold DESC LIMIT 1)"""
    for m, e in (("f1", "2.0 * tp / (tp + fp + np)"), ("precision", "tp::DOUBLE / (tp + fp)"), ("recall", "tp::DOUBLE / np"))
)


@query("thr_optimize", sql=f"WITH t AS ({LINES_SQL}), {_CUM} {_THR}")
def thr_optimize(spark: SparkSession, sf: str) -> DataFrame:
    best = metrics.best_thresholds(lines_frame(spark, sf), "label", "score")
    return best.select("metric", "best_threshold", F.round("best_score", 8).alias("best_score"))


@query(
    "thr_score",
    sql=f"""WITH t AS ({_PRED_SQL}), {_CONF}, s AS (SELECT sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM c)
    SELECT 'f1' AS metric, round(2 * tp / (2 * tp + fp + fn), 8) AS score FROM s UNION ALL SELECT 'precision', round(tp / (tp + fp), 8) FROM s
    UNION ALL SELECT 'recall', round(tp / (tp + fn), 8) FROM s""",
)
def thr_score(spark: SparkSession, sf: str) -> DataFrame:
    df = _scored(spark, sf)
    parts = [metrics.threshold_score(df, "label", "prediction", m).select(F.lit(m).alias("metric"), F.round("score", 8).alias("score")) for m in metrics.THRESHOLD_METRICS]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# ---- ranking ------------------------------------------------------------------------------------

_REV_SQL = "SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_suppkey"


def _revenue(spark: SparkSession, sf: str) -> DataFrame:
    rev = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(rev.alias("revenue"))


@query("rank_results", sql=f"SELECT l_suppkey, revenue, row_number() OVER (ORDER BY revenue DESC, l_suppkey) AS place FROM ({_REV_SQL})")
def rank_results(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers by revenue with their place; places come from range-wise running counts."""
    from tabloom.functions.running import prefix_sums

    order = F.struct((-F.col("revenue")).alias("value"), F.col("l_suppkey").alias("id"))
    ones = _revenue(spark, sf).withColumns({"_k": order, "one": F.lit(1).cast("bigint")})
    placed = prefix_sums(ones, "_k", ["one"])
    return placed.select("l_suppkey", "revenue", F.col("cum_one").alias("place"))


@query("best_result", sql=f"SELECT l_suppkey, revenue FROM ({_REV_SQL}) ORDER BY revenue DESC, l_suppkey LIMIT 1")
def best_result(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.best_result(_revenue(spark, sf), "revenue", "l_suppkey")


@query("top_k_rows", sql=f"SELECT l_suppkey, revenue FROM ({_REV_SQL}) ORDER BY revenue DESC, l_suppkey LIMIT 3")
def top_k_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_k_rows(_revenue(spark, sf), "revenue", "l_suppkey", ["l_suppkey", "revenue"])


@query(
    "top_k_by_group",
    sql="""SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn = 1 ORDER BY o_totalprice DESC, o_orderkey LIMIT 3""",
)
def top_k_by_group(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.top_k_by_group(o, "o_orderpriority", "o_totalprice", "o_orderkey")


@query(
    "collect_by_group",
    sql="""SELECT o_orderpriority, count(*) AS n_results, arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS best_name, max(o_totalprice) AS best_value FROM orders GROUP BY 1""",
)
def collect_by_group(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.collect_by_group(o, "o_orderpriority", "o_totalprice", "o_orderkey")


# ---- univariate selection ---------------------------------------------------------------------------

_FEATS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


def _anova_sql(f: str) -> str:
    return f"""SELECT '{f}' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS score
    FROM (SELECT l_returnflag, count({f}) AS n, avg({f}) AS m, var_pop({f}) AS v FROM lineitem GROUP BY 1), (SELECT avg({f}) AS g FROM lineitem)"""


@query("sel_kbest_classif", sql=" UNION ALL ".join(_anova_sql(f) for f in _FEATS))
def sel_kbest_classif(spark: SparkSession, sf: str) -> DataFrame:
    s = univariate.anova_scores(table(spark, sf, "lineitem"), _FEATS, "l_returnflag")
    return s.select("feature", F.round("score", 6).alias("score"))


_RFEATS = ("l_quantity", "l_discount", "l_tax", "l_linenumber")


@query(
    "sel_kbest_regression",
    sql=" UNION ALL ".join(
        f"""SELECT '{f}' AS feature, round((count(*) - 2) * power(corr({f}, l_extendedprice), 2) / (1 - power(corr({f}, l_extendedprice), 2)), 6) AS score FROM lineitem"""
        for f in _RFEATS
    ),
)
def sel_kbest_regression(spark: SparkSession, sf: str) -> DataFrame:
    s = univariate.regression_scores(table(spark, sf, "lineitem"), _RFEATS, "l_extendedprice")
    return s.select("feature", F.round("score", 6).alias("score"))


@query(
    "topk_features",
    sql=f"SELECT feature, score FROM ({' UNION ALL '.join(_anova_sql(f) for f in _FEATS)}) ORDER BY score DESC, feature LIMIT 3",
)
def topk_features(spark: SparkSession, sf: str) -> DataFrame:
    s = univariate.anova_scores(table(spark, sf, "lineitem"), _FEATS, "l_returnflag")
    return ranking.top_k_features(s.select("feature", F.round("score", 6).alias("score")), 3, "score")
