"""Metrics, ROC curves and decision thresholds over scored frames.

Hard-label metrics are one aggregation with optional grouping (model, fold).  Everything
that needs score order first aggregates to distinct scores and then takes range-wise
prefix sums, so no window ever holds the raw rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import running
from tabloom.functions.running import prefix_sums
from tabloom.functions.scalars import safe_div

# Default metrics per problem type and the metric that ranks.
CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
REGRESSION_METRICS = ("mse", "mae", "r2")
PRIMARY = {"classification": "f1", "regression": "mse"}
LOWER_IS_BETTER = ("mse", "mae")
THRESHOLD_METRICS = ("f1", "precision", "recall")


def _counts(y: Column, p: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((y == 1) & (p == 1)).cast("double"),
        "fp": F.count_if((y == 0) & (p == 1)).cast("double"),
        "fn": F.count_if((y == 1) & (p == 0)).cast("double"),
        "tn": F.count_if((y == 0) & (p == 0)).cast("double"),
    }


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return safe_div(tp, tp + fp), safe_div(tp, tp + fn), safe_div(2 * tp, 2 * tp + fp + fn)


def _grouped(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def check_binary(df: DataFrame, label: str) -> None:
    """Binary metrics are defined for labels 0 and 1 only."""
    if not df.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).isEmpty():
        raise ValueError(f"{label} must hold only 0 and 1 for binary metrics")


def classification(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, f1 of class 1; a zero denominator gives 0."""
    c = _counts(F.col(label), F.col(prediction))
    agg = _grouped(df, by, [v.alias(k) for k, v in c.items()])
    precision, recall, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return agg.select(
        *by, safe_div(F.col("tp") + F.col("tn"), total).alias("accuracy"), precision.alias("precision"),
        recall.alias("recall"), f1.alias("f1"),
    )


def regression(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """mse, mae, r2; the total sum of squares comes from the stable variance aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return _grouped(
        df, by,
        [
            F.avg((y - p) * (y - p)).alias("mse"),
            F.avg(F.abs(y - p)).alias("mae"),
            (1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2"),
        ],
    )


def macro(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """accuracy, macro f1/precision/recall over both classes, and roc_auc of the hard labels."""
    c = _counts(F.col(label), F.col(prediction))
    agg = _grouped(df, by, [v.alias(k) for k, v in c.items()])
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    one, zero = _prf(tp, fp, fn), _prf(tn, fn, fp)
    return agg.select(
        *by,
        safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ((one[2] + zero[2]) / 2).alias("f1"),
        ((one[0] + zero[0]) / 2).alias("precision"),
        ((one[1] + zero[1]) / 2).alias("recall"),
        ((one[1] + safe_div(tn, tn + fp)) / 2).alias("roc_auc"),
    )


def score_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, highest first: counts and running true/false positives."""
    per_score = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return prefix_sums(per_score, "threshold", ["pos", "neg"], descending=True).withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp"}
    )


def _class_totals(df: DataFrame, label: str, score: str) -> tuple[int, int]:
    seen = df.where(F.col(score).isNotNull())
    return tuple(seen.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first())


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """``threshold, fpr, tpr``; the first point is (inf, 0, 0)."""
    table = score_table(df, label, score)
    pos, neg = _class_totals(df, label, score)
    curve = table.select(
        "threshold",
        F.try_divide(F.col("fp").cast("double"), F.lit(neg)).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.lit(pos)).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(math.inf, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return curve.unionAll(start)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half.  One row, ``roc_auc``."""
    table = score_table(df, label, score)
    # each score step adds a trapezoid: neg rows beside the positives strictly above plus half the tied ones
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return table.agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def roc_auc_by(df: DataFrame, label: str, score: str, by: Sequence[str], range_rows: int | None = None) -> DataFrame:
    """ROC AUC per group (fold, model): average ranks inside (group, score-range) windows.

    Counts per (group, score) are summed over score ranges, one per ``range_rows`` rows (4096 at most), whose cut
    points come from a sketch, so a window holds about that many rows whatever the size of its group.
    """
    from pyspark.sql import Window

    s = F.col(score).cast("double")
    per = df.where(s.isNotNull()).groupBy(*by, s.alias("_s")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("pos"), F.count_if(F.col(label) == 0).cast("double").alias("neg")
    )
    ranges = min(running.MAX_RANGES, df.count() // (range_rows or running.RANGE_ROWS) + 1)
    cuts: list[float] = []
    if ranges > 1:
        points = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        cuts = sorted(set(df.agg(F.percentile_approx(s, points, 4 * ranges)).first()[0] or []))
    per = per.withColumn("_r", running.range_id("_s", cuts, "double"))
    sums = per.groupBy(*by, "_r").agg(F.sum("pos").alias("_p"))
    above = Window.partitionBy(*by).orderBy(F.col("_r").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, "_r", F.coalesce(F.sum("_p").over(above), F.lit(0.0)).alias("_off"))
    inside = Window.partitionBy(*by, "_r").orderBy(F.col("_s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = per.join(offsets, [*by, "_r"]).withColumn("tp", F.col("_off") + F.sum("pos").over(inside))
    return _grouped(
        joined, by,
        [F.try_divide(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)), F.sum("pos") * F.sum("neg")).alias("roc_auc")],
    )


def threshold_score(df: DataFrame, label: str, prediction: str, metric: str) -> DataFrame:
    """One of f1, precision, recall of hard labels; any other metric is an error."""
    if metric not in THRESHOLD_METRICS:
        raise ValueError(f"unsupported metric {metric!r} for threshold optimisation")
    return classification(df, label, prediction).select(F.col(metric).alias("score"))


def best_threshold(df: DataFrame, label: str, score: str, metric: str = "f1") -> DataFrame:
    """``best_threshold, best_score``: every distinct score is tried; ties keep the highest threshold.

    With no scored row the default (0.5, -1) is returned.
    """
    if metric not in THRESHOLD_METRICS:
        raise ValueError(f"unsupported metric {metric!r} for threshold optimisation")
    return best_thresholds(df, label, score, [metric]).select("best_threshold", "best_score")


def best_thresholds(df: DataFrame, label: str, score: str, wanted: Sequence[str] = THRESHOLD_METRICS) -> DataFrame:
    """``metric, best_threshold, best_score`` of several metrics from one score table in one aggregation."""
    tp, fp, p = F.col("tp").cast("double"), F.col("fp").cast("double"), F.lit(float(_class_totals(df, label, score)[0]))
    values = dict(zip(("precision", "recall", "f1"), _prf(tp, fp, p - tp)))
    best = score_table(df, label, score).agg(*[F.max(F.struct(values[m].alias("s"), "threshold")).alias(m) for m in wanted])
    rows = best.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("b")) for m in wanted])))
    # the curve starts at an infinite threshold that predicts nothing and scores 0
    b = F.when(F.col("b.s") > 0, F.col("b.threshold")).when(F.col("b").isNotNull(), F.lit(math.inf))
    return rows.select(
        "metric", F.coalesce(b, F.lit(0.5)).alias("best_threshold"), F.coalesce(F.col("b.s"), F.lit(-1.0)).alias("best_score")
    )
