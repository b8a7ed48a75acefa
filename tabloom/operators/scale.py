"""Scalers: one aggregation learns (center, scale), the transform is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.order_stats import exact_quantiles
from tabloom.operators.profile import ident

SCALERS = ("standard", "robust", "min_max_scaler", "max_abs_scaler")


def learn_scaler(
    df: DataFrame, strategy: str, exprs: Mapping[str, Column], rows: int | None = None
) -> dict[str, tuple[float, float]]:
    """``{name: (center, scale)}`` with a zero scale replaced by 1."""
    names = list(exprs)
    if strategy == "robust":
        q = exact_quantiles(df, exprs, [0.25, 0.5, 0.75], rows)
        return {c: _usable(q[c][1], None if q[c][0] is None else q[c][2] - q[c][0]) for c in names}
    pair = {
        "standard": lambda c: (F.avg(c), F.stddev_pop(c)),
        "min_max_scaler": lambda c: (F.min(c), F.max(c) - F.min(c)),
        "max_abs_scaler": lambda c: (F.lit(0.0), F.max(F.abs(c))),
    }.get(strategy)
    if pair is None:
        raise ValueError(f"unknown scaler {strategy!r}")
    aggs = [e.cast("double") for c in names for e in pair(exprs[c].cast("double"))]
    row = df.agg(*aggs).first()
    return {c: _usable(row[2 * i], row[2 * i + 1]) for i, c in enumerate(names)}


def _usable(center: float | None, scale: float | None) -> tuple[float, float]:
    return (0.0 if center is None else center), (scale if scale else 1.0)


def scaled(c: Column, center: float, scale: float) -> Column:
    return (c.cast("double") - F.lit(center)) / F.lit(scale)


def scale(df: DataFrame, strategy: str, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by their scaled values."""
    learned = learn_scaler(df, strategy, {c: ident(c) for c in columns})
    return df.withColumns({c: scaled(ident(c), *learned[c]) for c in columns})
