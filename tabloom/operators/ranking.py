"""Ranking of metric tables: sort, best, best per group, groups in rank order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.metrics import LOWER_IS_BETTER


def _value(metric: str, ascending: bool) -> Column:
    """Sort key: a missing metric counts as 0 (as the worst value where low is good)."""
    return F.col(metric).asc_nulls_last() if ascending else F.coalesce(F.col(metric), F.lit(0.0)).desc()


def direction(metric: str) -> bool:
    """True when smaller is better."""
    return metric.removeprefix("test_") in LOWER_IS_BETTER


def rank_results(df: DataFrame, metric: str, name: str, ascending: bool = False) -> DataFrame:
    """All rows ordered best first, ties by name."""
    return df.orderBy(_value(metric, ascending), F.col(name))


def best_result(df: DataFrame, metric: str, name: str, ascending: bool = False) -> DataFrame:
    return rank_results(df, metric, name, ascending).limit(1)


def top_k_rows(df: DataFrame, metric: str, name: str, columns: Sequence[str], k: int = 3, ascending: bool = False) -> DataFrame:
    """First k ranked rows, projected."""
    return rank_results(df, metric, name, ascending).limit(k).select(*columns)


def best_per_group(df: DataFrame, group: str, metric: str, name: str, ascending: bool = False) -> DataFrame:
    """The best row of every group as one aggregation: partial maxima, no sort of a group."""
    value = F.col(metric) if ascending else F.coalesce(F.col(metric), F.lit(0.0))
    g = F.coalesce(F.col(group), F.lit("unknown")).alias(group)
    row = F.struct(*[F.col(c).alias(c) for c in df.columns if c != group])
    best = df.groupBy(g).agg(F.min_by(row, F.struct((value if ascending else -value).alias("v"), F.col(name).alias("n"))).alias("_b"))
    return best.select(group, *[F.col(f"_b.{c}").alias(c) for c in df.columns if c != group])


def top_k_by_group(df: DataFrame, group: str, metric: str, name: str, k: int = 3, ascending: bool = False) -> DataFrame:
    """Best row of each group, the k groups with the best ones in rank order."""
    return rank_results(best_per_group(df, group, metric, name, ascending), metric, name, ascending).limit(k)


def collect_by_group(df: DataFrame, group: str, metric: str, name: str, ascending: bool = False) -> DataFrame:
    """Per group: the number of rows and the best name and value."""
    counts = df.groupBy(F.coalesce(F.col(group), F.lit("unknown")).alias(group)).agg(F.count(F.lit(1)).alias("n_results"))
    best = best_per_group(df, group, metric, name, ascending).select(
        group, F.col(name).alias("best_name"), F.col(metric).alias("best_value")
    )
    return counts.join(best, group)


def grouped_leaderboard(df: DataFrame, group: str, metric: str, name: str, ascending: bool = False) -> DataFrame:
    """Leaderboard rows with their rank inside the group; for small result tables."""
    g = F.coalesce(F.col(group), F.lit("unknown"))
    w = Window.partitionBy(g).orderBy(_value(metric, ascending), F.col(name))
    return df.withColumn(group, g).withColumn("rank_in_group", F.row_number().over(w))


def top_k_features(importances: DataFrame, k: int, value: str = "importance", name: str = "feature") -> DataFrame:
    """The k largest absolute importances."""
    return importances.orderBy(F.abs(value).desc(), F.col(name)).limit(k)
