"""Category encoders.

Small category sets (counted, at most LITERAL_CATEGORIES) become literal expressions;
larger learned tables are attached by a size-checked, skew-safe join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.functions.running import dense_codes
from tabloom.functions.scalars import key_hash, trimmed_lower
from tabloom.operators.profile import ident
from tabloom.session import keep, together

LITERAL_CATEGORIES = 1000


def categories(df: DataFrame, columns: Sequence[str], limit: int = LITERAL_CATEGORIES) -> dict[str, list | None]:
    """Sorted distinct values per column, or None where there are more than ``limit``."""

    def one(c: str) -> list | None:
        rows = df.select(ident(c).alias("v")).where(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
        return sorted(r["v"] for r in rows) if len(rows) <= limit else None

    return dict(zip(columns, together(*[lambda c=c: one(c) for c in columns])))


def category_name(column: str, value: object) -> str:
    return f"{column}_{value}"


def onehot_exprs(c: Column, name: str, values: Sequence) -> dict[str, Column]:
    """One 0/1 column per known value; an unseen value gives all zeros."""
    return {category_name(name, v): F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)) for v in values}


def code_expr(c: Column, values: Sequence) -> Column:
    """Position in ``values``; -1 for unseen."""
    if not values:
        return F.lit(-1)
    lookup = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(-1))


def onehot(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """Dense 0/1 columns while the categories fit a projection of literals, else :func:`onehot_vector`."""
    values = categories(df, [column])[column] if values is None else values
    if values is not None:
        return df.withColumns(onehot_exprs(ident(column), column, values))
    return onehot_vector(df, column)


def onehot_vector(df: DataFrame, column: str, to: str | None = None) -> DataFrame:
    """Sparse 0/1 vector over the sorted categories, any number of them; null and unseen are all zeros."""
    codes = dense_codes(df.select(ident(column).alias(column)), column).withColumnRenamed("code", "_code")
    width = codes.count()
    return hot_vector(attach(df, codes, [column], "n"), "_code", width, to or f"{column}_onehot").drop("_code")


def hot_vector(df: DataFrame, code: str, width: int, to: str) -> DataFrame:
    """Sparse vector of ``width`` entries with a 1 at ``code``; all zeros where the code is null."""
    spark = df.sparkSession
    # the encoder learns its size from the largest code; that one, one beyond the categories, is the dropped last
    encoder = OneHotEncoder(inputCol="_hot_code", outputCol=to).fit(spark.createDataFrame([(float(width),)], "_hot_code double"))
    coded = df.withColumn("_hot_code", F.coalesce(F.col(code).cast("double"), F.lit(float(width))))
    return encoder.transform(coded).drop("_hot_code")


def ordinal(df: DataFrame, column: str, to: str | None = None) -> DataFrame:
    """Sorted distinct values numbered from 0; null and unseen give -1."""
    to = to or f"{column}_code"
    values = categories(df, [column])[column]
    if values is not None:
        return df.withColumn(to, code_expr(ident(column), values))
    codes = dense_codes(df.select(ident(column).alias(column)), column).withColumnRenamed("code", "_code")
    return attach(df, codes, [column], "n").withColumn(to, F.coalesce("_code", F.lit(-1)).cast("int")).drop("_code")


def ordinal_ordered(df: DataFrame, column: str, order: Sequence[str], to: str | None = None) -> DataFrame:
    """Codes from an explicit order, compared after lower/trim on both sides."""
    normal = [v.strip().lower() for v in order]
    return df.withColumn(to or f"{column}_code", code_expr(trimmed_lower(ident(column)), normal))


def frequency(df: DataFrame, column: str, to: str | None = None) -> DataFrame:
    """Relative frequency of each row's category among non-null rows."""
    to = to or f"{column}_freq"
    counts = keep(df.where(ident(column).isNotNull()).groupBy(ident(column).alias(column)).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 1
    return attach(df, counts.withColumn(to, F.col("n") / F.lit(float(total))), [column], "n")


def target_oof(df: DataFrame, column: str, label: str, fold: str = "fold", to: str | None = None) -> DataFrame:
    """Out-of-fold target mean: totals minus the row's own fold; the global mean where nothing is left."""
    to = to or f"{column}_target"
    y = ident(label).cast("double")
    cells = keep(df.groupBy(column, fold).agg(F.count(y).alias("n"), F.sum(y).alias("s")))  # read for the map and its size
    # the window runs over (category, fold) cells: at most k rows per category
    w = Window.partitionBy(column)
    enc = cells.select(
        column,
        fold,
        "n",
        F.try_divide(F.sum("s").over(w) - F.coalesce("s", F.lit(0.0)), F.sum("n").over(w) - F.col("n")).alias(to),
    )
    row = df.agg(F.avg(y)).first()
    return attach(df, enc, [column, fold], "n").withColumn(to, F.coalesce(to, F.lit(row[0])))


def leave_one_out(df: DataFrame, column: str, label: str, to: str | None = None) -> DataFrame:
    """(sum - own) / (n - 1) per category; null for a category of one row."""
    to = to or f"{column}_loo"
    y = ident(label).cast("double")
    sums = df.groupBy(column).agg(F.count(y).alias("_n"), F.sum(y).alias("_s")).withColumn("n", F.col("_n"))
    return (
        attach(df, sums, [column], "n")
        .withColumn(to, F.try_divide(F.col("_s") - y, F.col("_n") - 1))
        .drop("_n", "_s")
    )


def hashed(df: DataFrame, column: str, buckets: int = 16, to: str | None = None) -> DataFrame:
    """Bucket of the category's hash: no fit, no state, any number of categories."""
    return df.withColumn(
        to or f"{column}_bucket",
        F.when(ident(column).isNotNull(), F.pmod(key_hash(ident(column), seed=0), F.lit(buckets)).cast("int")),
    )


def binary(df: DataFrame, column: str) -> DataFrame:
    """Bits of the 1-based ordinal code, most significant first; unseen is all zeros."""
    coded = ordinal(df, column, "_code1").withColumn("_code1", F.col("_code1") + 1)
    top = coded.agg(F.max("_code1")).first()[0] or 1
    width = max(1, math.ceil(math.log2(top + 1)))
    bits = {f"{column}_bit{b}": F.shiftright("_code1", width - 1 - b).bitwiseAND(F.lit(1)) for b in range(width)}
    return coded.withColumns(bits).drop("_code1")


def boolean_numeric(c: Column, mode: object) -> Column:
    return F.coalesce(c, F.lit(mode)).cast("int")


def fill_then_code(df: DataFrame, column: str, fill: Mapping[str, object], to: str) -> DataFrame:
    """Mode fill, then lexicographic codes."""
    return ordinal(df.withColumn(column, F.coalesce(ident(column), F.lit(fill[column]))), column, to)
