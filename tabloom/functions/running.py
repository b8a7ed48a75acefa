"""Prefix sums and dense ranks over a large sorted set without a single-task window.

The input is first aggregated to distinct sort keys by the caller.  Cut points (at most
:data:`MAX_RANGES`, literals) split the key domain into ranges; each range is summed in
one small aggregation, range offsets go back as a literal lookup of at most
``MAX_RANGES`` entries, and the window only runs inside a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

RANGE_ROWS = 250_000
MAX_RANGES = 4096


def range_cuts(df: DataFrame, key: str, rows: int, range_rows: int | None = None) -> list:
    """Sorted cut points from a bounded hash sample of the distinct keys."""
    range_rows = range_rows or RANGE_ROWS
    wanted = min(MAX_RANGES, rows // range_rows)
    if wanted < 1:
        return []
    modulus = max(1, rows // (wanted * 16))
    sample = (
        df.where(F.pmod(F.xxhash64(key), F.lit(modulus)) == 0)
        .select(key)
        .orderBy(F.xxhash64(key))
        .limit(wanted * 32)
    )
    values = sorted(r[0] for r in sample.collect())
    step = max(1, len(values) // (wanted + 1))
    return sorted(set(values[step::step]))[:wanted]


def _literal(cut: object, dtype: str) -> Column:
    value = F.struct(*[F.lit(v) for v in cut]) if isinstance(cut, Row) else F.lit(cut)
    return value.cast(dtype)


def range_id(key: str, cuts: Sequence, dtype: str) -> Column:
    """Index of the range a key falls in, as a balanced tree of comparisons; a key may be a struct."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(key) < _literal(cuts[mid], dtype), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    if len(cuts) <= 256:
        return tree(0, len(cuts))
    arr = F.array(*[_literal(c, dtype) for c in cuts])
    return F.size(F.filter(arr, lambda c: c <= F.col(key)))


def prefix_sums(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    descending: bool = False,
    range_rows: int | None = None,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running sum in key order) for every value column.

    ``key`` must be unique and non-null.
    """
    totals = [F.sum(v).alias(v) for v in values]
    rows = df.count()
    cuts = range_cuts(df, key, rows, range_rows)
    order = F.col(key).desc() if descending else F.col(key).asc()
    if not cuts:  # proven small: at most RANGE_ROWS rows in the one window partition
        w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(v).over(w).alias(f"cum_{v}") for v in values])
    tagged = df.withColumn("_range", range_id(key, cuts, dict(df.dtypes)[key]))
    per_range = {r["_range"]: r for r in tagged.groupBy("_range").agg(*totals).collect()}
    offsets: dict[str, list] = {v: [] for v in values}
    acc = {v: 0 for v in values}
    ids = range(len(cuts) + 1)
    for rid in reversed(ids) if descending else ids:
        for v in values:
            offsets[v].append((rid, acc[v]))
            acc[v] += (per_range[rid][v] or 0) if rid in per_range else 0
    spark = df.sparkSession
    table = [(i, *[dict(offsets[v])[i] for v in values]) for i in ids]
    types = dict(df.dtypes)
    schema = "_range int, " + ", ".join(f"`_off_{v}` {'double' if types[v] in ('double', 'float') else 'bigint'}" for v in values)
    off = F.broadcast(spark.createDataFrame(table, schema))
    w = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        tagged.join(off, "_range")
        .select(
            *df.columns,
            *[(F.col(f"_off_{v}") + F.sum(v).over(w)).alias(f"cum_{v}") for v in values],
        )
    )


def dense_codes(df: DataFrame, column: str, range_rows: int | None = None) -> DataFrame:
    """``column, code`` for the distinct non-null values: sorted, numbered from 0."""
    distinct = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ones = distinct.withColumn("one", F.lit(1).cast("bigint"))
    return prefix_sums(ones, column, ["one"], range_rows=range_rows).select(
        column, (F.col("cum_one") - 1).alias("code"), "n"
    )
