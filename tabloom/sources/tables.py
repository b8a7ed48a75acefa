"""CSV source, validation, and deterministic train/test, stratified and k-fold splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.order_stats import order_statistics
from tabloom.functions.scalars import HASH_SPAN, key_hash, nan_to_null
from tabloom.sources.csv_records import csv_records

# Tokens a CSV reader takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SEED = 42
LARGE_TABLE_ROWS = 1000


class FileIsEmptyException(Exception):
    """The source holds no rows."""


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = True
) -> DataFrame:
    """CSV with header; missing tokens become null; a missing path is FileNotFoundError.

    Quoted line breaks belong to their cell, and a file is still read by as many tasks as it has splits (see ``csv_records``).
    ``multiline=False`` skips the pass that tells where records start, for inputs without such breaks.

    Pass ``schema`` on large inputs: inference costs one extra scan of the text.
    """
    try:
        raw = spark.read.csv(path, header=True, multiLine=multiline, escape='"', nullValue="")
        if multiline and raw.columns:
            names = [*raw.columns[:-1], raw.columns[-1].removesuffix("\r")]
            ddl = T.StructType([T.StructField(c, T.StringType()) for c in names])
            how = {"escape": '"', "nullValue": "", "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
            raw = csv_records(spark, path).select(F.from_csv("record", ddl.toDDL(), how).alias("r")).select("r.*")
        text = raw.select(
            *[F.when(~F.trim(F.col(f"`{c}`")).isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
        )
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err.getCondition()):
            raise FileNotFoundError(path) from err
        raise
    if schema is not None:
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return text.select(*[F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").alias(f.name) for f in wanted])
    return _inferred(text)


def _inferred(text: DataFrame) -> DataFrame:
    """Integer, double, boolean or string per column, decided in one aggregation."""
    kinds = ("bigint", "double")
    aggs = []
    for c in text.columns:
        aggs += [F.bool_and(F.expr(f"`{c}` is null or try_cast(`{c}` as {k}) is not null")) for k in kinds]
        aggs += [F.bool_and(F.col(f"`{c}`").isNull() | F.lower(f"`{c}`").isin("true", "false")), F.count(f"`{c}`")]
    row = text.agg(*aggs).first()
    out = []
    for i, c in enumerate(text.columns):
        is_int, is_double, is_bool, seen = row[4 * i : 4 * i + 4]
        dtype = "string"
        if seen:
            dtype = "boolean" if is_bool else "bigint" if is_int else "double" if is_double else "string"
        else:
            dtype = "double"
        col = F.col(f"`{c}`")
        out.append(col if dtype == "string" else F.trim(col).cast(dtype).alias(c))
    return text.select(*out)


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column, so that statistics skip it."""
    return df.select(
        *[
            nan_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def validate(df: DataFrame, target: str) -> DataFrame:
    """Raise on zero rows or an absent target column; return the frame unchanged."""
    if df.isEmpty():
        raise FileIsEmptyException("the dataset holds no rows")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the dataset")
    return df


def test_ratio(n: int | Column) -> float | Column:
    """Share of the test part: 0.2 above 1000 rows, else 0.1."""
    if isinstance(n, Column):
        return F.when(n > LARGE_TABLE_ROWS, F.lit(0.2)).otherwise(F.lit(0.1))
    return 0.2 if n > LARGE_TABLE_ROWS else 0.1


test_ratio.__test__ = False


def with_split(df: DataFrame, keys: Sequence[str], ratio: float | None = None, seed: int = SEED) -> DataFrame:
    """Add ``split`` ('train' or 'test') by the hash of the row key; no shuffle."""
    if ratio is None:
        ratio = test_ratio(df.count())
    cut = int(ratio * HASH_SPAN)
    return df.withColumn("split", F.when(key_hash(*keys, seed=seed) < cut, "test").otherwise("train"))


def with_stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], ratio: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add ``split`` so that exactly floor(ratio * n_class) rows of each class are 'test'.

    The cut of each class is an exact order statistic of the key hash, so no class is
    ever sorted in one task.
    """
    h = key_hash(*keys, seed=seed)
    classes, rest = split_classes(df, label)
    stats = order_statistics(
        df, {str(i): F.when(F.col(label) == F.lit(v), h) for i, v in enumerate(classes)},
        lambda _c, n: [int(ratio * n + 1e-9)],
    )
    test = F.lit(False)
    for i, v in enumerate(classes):
        for cut in stats[str(i)][1].values():
            test = test | ((F.col(label) == F.lit(v)) & (h <= F.lit(int(cut))))

    def named(part: DataFrame, is_test: Column) -> DataFrame:
        return part.withColumn("split", F.when(is_test, "test").otherwise("train"))

    if rest is None:
        return named(df, test)
    rank, n = _class_rank(label, h)
    return named(df.where(~rest), test).unionAll(named(df.where(rest), rank <= F.floor(F.lit(ratio) * n + 1e-9)))


#: classes whose cuts are literals; every other class holds at most 1 / (HOT_CLASSES + 1) of the rows
HOT_CLASSES = 256


def split_classes(df: DataFrame, label: str) -> tuple[list, Column | None]:
    """The heaviest class labels, sorted, and the condition of the rows of all others (None: there are none)."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).count()
    rows = sizes.orderBy(F.col("count").desc(), F.col(label)).limit(HOT_CLASSES + 1).collect()
    heavy = sorted(r[0] for r in rows[:HOT_CLASSES])
    return heavy, F.col(label).isNotNull() & ~F.col(label).isin(heavy) if len(rows) > HOT_CLASSES else None


def _class_rank(label: str, h: Column) -> tuple[Column, Column]:
    """Rank by key hash within the class and the class size, for classes too light to be a hot window."""
    w = Window.partitionBy(label)
    return F.rank().over(w.orderBy(h)), F.count(F.lit(1)).over(w)


def with_folds(
    df: DataFrame, k: int, keys: Sequence[str], label: str | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``fold`` 0..k-1 with sizes differing by at most one (per class when stratified, any number of classes)."""
    h = key_hash(*keys, seed=seed)
    rest = None
    if label is None:
        parts = {"all": h}
        member = {"all": F.lit(True)}
    else:
        classes, rest = split_classes(df, label)
        member = {str(i): F.col(label) == F.lit(v) for i, v in enumerate(classes)}
        parts = {c: F.when(m, h) for c, m in member.items()}
    stats = order_statistics(df, parts, lambda _c, n: sorted({n * i // k for i in range(1, k)} - {0}))
    fold = None
    for c, (n, at) in stats.items():
        cuts = [int(at[n * i // k]) if n * i // k else -1 for i in range(1, k)]
        code = sum((((h > F.lit(cut)).cast("int")) for cut in cuts), F.lit(0))
        fold = code if fold is None and label is None else (F.when(member[c], code) if fold is None else fold.when(member[c], code))
    fold = fold if fold is not None else F.lit(0)
    if rest is None:
        return df.withColumn("fold", fold)
    rank, n = _class_rank(label, h)
    light = sum(((rank > F.floor(n * i / k)).cast("int") for i in range(1, k)), F.lit(0))
    return df.where(~rest).withColumn("fold", fold).unionAll(df.where(rest).withColumn("fold", light))


@dataclass
class Bundle:
    """A labelled table with its row key and a ``split`` column."""

    data: DataFrame
    target: str
    keys: tuple[str, ...]

    @property
    def train(self) -> DataFrame:
        return self.data.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.data.where(F.col("split") == "test")

    @property
    def features(self) -> list[str]:
        return [c for c in self.data.columns if c not in (self.target, "split", *self.keys)]


def load_bundle(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], schema: str | None = None
) -> Bundle:
    """Read, validate and split a CSV in one call."""
    df = normalise_nan(validate(read_csv(spark, path, schema), target))
    return Bundle(with_split(df, keys), target, tuple(keys))
