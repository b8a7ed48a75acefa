"""Scalar column helpers: everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 52  # 13 hex digits: exact in both bigint and double
HASH_SPAN = 1 << HASH_BITS

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Fixed value: strings read as the true side of a two-valued text column.
TRUE_WORDS = ("true", "yes", "si", "1", "y")


def key_hash(*cols: Column | str, seed: int = 42) -> Column:
    """Uniform, engine-independent 52-bit hash of a row key.

    Splits and folds depend on the key only, so they do not move with partitioning,
    retries or added rows.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def trimmed_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def token_array(c: Column) -> Column:
    """Whitespace tokens without the empty token of an empty or padded string."""
    return F.array_remove(F.split(c, r"\s+"), "")


def token_count(c: Column) -> Column:
    return F.size(token_array(c))


def at_least(score: Column, threshold: float | Column) -> Column:
    """Probability to hard label: 1 when ``score >= threshold``."""
    return (score >= threshold).cast("int")


def is_whole(c: Column) -> Column:
    return c == F.floor(c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def safe_div(a: Column, b: Column, default: float | None = 0.0) -> Column:
    q = F.try_divide(a, b)
    return q if default is None else F.coalesce(q, F.lit(default))
