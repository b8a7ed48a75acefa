"""Join learned per-key values to a large, possibly skewed table; deal out rows that a scan leaves in few tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20
HOT_KEYS = 1_000
ROWS_OF_TASK = 8_192
GATHERED_ROWS = 1 << 18


def _width(df: DataFrame) -> Column:
    """Bytes of a row, roughly: text by its length, arrays of numbers by their size."""
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.octet_length(F.coalesce(c, F.lit(""))) + 16
        elif isinstance(f.dataType, T.ArrayType):
            width = width + F.greatest(F.size(c), F.lit(0)) * 8 + 16
        else:
            width = width + 8
    return width


def attach(
    df: DataFrame,
    learned: DataFrame,
    keys: Sequence[str],
    weight: str,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Left join ``learned`` (unique on ``keys``) to ``df``.

    A learned table counted at no more than ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes is broadcast.  A
    larger one is split: the ``HOT_KEYS`` heaviest keys by ``weight`` (the fit's row count) are
    broadcast, and their rows get a spread-out join key, so that the remaining shuffle
    join never sees a heavy key.
    """
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    keys = list(keys)
    values = [c for c in learned.columns if c not in keys and c != weight]
    slim = learned.select(*keys, *values)
    rows, size = slim.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(_width(slim))).first()
    if rows <= limit and (size or 0) <= BROADCAST_BYTES:
        return df.join(F.broadcast(slim), keys, "left")
    order = [F.col(weight).desc(), *[F.col(k).asc() for k in keys]]
    hot = learned.orderBy(*order).limit(HOT_KEYS).select(
        *keys, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot")
    )
    first = df.join(F.broadcast(hot), keys, "left")
    join_keys = [f"_k{i}" for i in range(len(keys))]
    # hot rows are resolved already and null keys match nothing: both get null keys plus a
    # row hash, so that neither piles up in one shuffle partition
    settled = F.col("_hot").isNotNull()
    for k in keys:
        settled = settled | F.col(k).isNull()
    spread = first.withColumn("_spread", F.when(settled, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).otherwise(F.lit(0).cast("bigint")))
    for k, j in zip(keys, join_keys):
        spread = spread.withColumn(j, F.when(~settled, F.col(k)))
    cold = slim.select(
        F.lit(0).cast("bigint").alias("_spread"), *[F.col(k).alias(j) for k, j in zip(keys, join_keys)], *values
    )
    joined = spread.join(cold, ["_spread", *join_keys], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)).alias(v) for v in values],
    )


def spread(df: DataFrame, rows_of_task: int = ROWS_OF_TASK) -> DataFrame:
    """``df`` with its rows dealt over tasks of about ``rows_of_task`` rows, if some task of its scan holds over twice as many.

    A file is read by at most as many tasks as it has row groups, however many cores there are, and work per row stays in
    these tasks.  The count reads no column.
    """
    held = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    if (held[0] or 0) <= 2 * rows_of_task:
        return df
    return df.repartition(-(-held[1] // rows_of_task), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def tasks_for(df: DataFrame, n: int, least: int = 1) -> int:
    """Tasks for loops that read ``n`` rows often: one per core, fewer where a task had not ``least`` rows, more where it had over
    ``GATHERED_ROWS``.  What a pass costs beside the rows (starting tasks, sums of every task) does not grow with the scan's tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(max(cores, -(-n // GATHERED_ROWS)), -(-n // least)))


def gathered(df: DataFrame, least: int = 1) -> DataFrame:
    """A persisted frame's rows in ``tasks_for`` them; without a shuffle, and never more tasks than it has."""
    return df.coalesce(tasks_for(df, df.count(), least))
