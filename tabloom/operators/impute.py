"""Missing-value fills: each fit is one bounded result, each transform a ``coalesce``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.order_stats import exact_quantiles
from tabloom.operators.profile import ident, kinds
from tabloom.session import cut_lineage, keep


def learn_mean(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    row = df.agg(*[F.avg(ident(c)) for c in columns]).first()
    return dict(zip(columns, row))


def learn_median(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, {c: ident(c) for c in columns}, [0.5]).items()}


def learn_mode(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, ties to the smallest.

    Counted per (column, value) in a shuffle, so neither a hot value nor many distinct
    values meet in one aggregation buffer; the typed comparison orders ties as the
    column's own type does.
    """
    out: dict[str, object] = {}
    ks = kinds(df, columns)
    for kind in sorted(set(ks.values())):
        cols = [c for c in columns if ks[c] == kind]
        cast = {"int": "bigint", "float": "double", "bool": "boolean", "string": "string"}.get(kind)
        long = df.select(*[(ident(c).cast(cast) if cast else ident(c)).alias(c) for c in cols]).unpivot(
            [], [f"`{c}`" for c in cols], "column", "value"
        )
        counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        best = counts.groupBy("column").agg(F.max("cnt").alias("cnt"))
        top = counts.join(F.broadcast(best), ["column", "cnt"], "left_semi").groupBy("column").agg(F.min("value").alias("value"))
        out.update({r["column"]: r["value"] for r in top.collect()})
    return {c: out.get(c) for c in columns}


LEARN = {"mean": learn_mean, "median": learn_median, "mode": learn_mode}


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by the given literals."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.coalesce(ident(c), F.lit(v).cast("double" if isinstance(v, float) else types[c]))
            for c, v in values.items()
            if v is not None
        }
    )


def impute(df: DataFrame, strategy: str, columns: Sequence[str], value: object = None) -> DataFrame:
    """mean, median, mode or constant fill of the given columns."""
    if strategy == "constant":
        return fill(df, {c: value for c in columns})
    if strategy not in LEARN:
        raise ValueError(f"unknown imputation strategy {strategy!r}")
    return fill(df, LEARN[strategy](df, columns))


def add_indicators(df: DataFrame, columns: Sequence[str], suffix: str = "_missing") -> DataFrame:
    """0/1 flag per column, set where the value is missing."""
    return df.withColumns({f"{c}{suffix}": ident(c).isNull().cast("int") for c in columns})


def impute_iterative(
    df: DataFrame, columns: Sequence[str], predictors: Sequence[str], keys: Sequence[str], rounds: int = 3
) -> DataFrame:
    """Chained regressions: start at the mean, then re-predict each null-bearing column.

    Every fit is a one-pass normal-equation regression on the rows where the column was
    observed.  Each round ends in a reliable checkpoint, so the plan does not grow.
    """
    start = learn_mean(df, columns)
    base = df.select(*keys, *predictors, *[c for c in columns if c not in predictors])
    state = base.withColumns({f"{c}__gap": ident(c).isNull() for c in columns})
    state = state.withColumns({c: F.coalesce(ident(c).cast("double"), F.lit(start[c])) for c in columns})
    features = list(dict.fromkeys([*columns, *predictors]))
    state = keep(state)
    for _ in range(rounds):
        for c in columns:
            others = [f for f in features if f != c]
            packed = VectorAssembler(inputCols=others, outputCol="_x").transform(state)
            model = LinearRegression(featuresCol="_x", labelCol=c, solver="auto").fit(packed.where(~F.col(f"{c}__gap")))
            guess = F.lit(float(model.intercept))
            for f, w in zip(others, model.coefficients):
                guess = guess + ident(f).cast("double") * F.lit(float(w))
            state = state.withColumn(c, F.when(F.col(f"{c}__gap"), guess).otherwise(ident(c)))
        state = cut_lineage(state)
    return state.drop(*[f"{c}__gap" for c in columns])
